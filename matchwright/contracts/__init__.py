"""Column contracts of the three sources."""
