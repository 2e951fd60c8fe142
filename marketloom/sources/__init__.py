"""Reading, normalising, ingesting and writing."""
