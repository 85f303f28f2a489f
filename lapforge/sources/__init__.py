"""Reading raw data, looking at the catalog, and writing tables."""
