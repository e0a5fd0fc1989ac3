"""Column expressions: record keys, object names, sizes."""
