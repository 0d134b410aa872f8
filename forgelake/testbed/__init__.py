"""The driver tables seen as forge events."""
