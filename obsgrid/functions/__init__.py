"""obsgrid."""
