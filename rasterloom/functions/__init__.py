"""Column builders: null-safe arithmetic, quality masks, spectral indices, scalings, map projections."""
