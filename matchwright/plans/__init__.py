"""Jobs: compositions of operators over all tours and seasons at once."""
