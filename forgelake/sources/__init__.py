"""Reading and writing raw events and tables."""
