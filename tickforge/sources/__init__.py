"""Trade archives and stored ticks."""
