"""Column expressions (tags, numbers, geo) and Arrow kernels (shapes, vector_tiles, wire)."""
