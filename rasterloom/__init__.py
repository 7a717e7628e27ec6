"""Raster and remote-sensing analytics on Spark."""
