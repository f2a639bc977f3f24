"""Reading, mapping and writing tables."""
