"""DataFrame operators over scenes, pixels, features and grids."""
