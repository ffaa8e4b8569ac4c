"""Query catalog and end-to-end plans."""
