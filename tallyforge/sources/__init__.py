"""Reading raw extracts and publishing tables."""
