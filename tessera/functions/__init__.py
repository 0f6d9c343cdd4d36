"""Column expressions: names, numbers, polygons and hash draws."""
