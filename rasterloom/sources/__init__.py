"""Readers and writers of pixel, scene and feature tables."""
