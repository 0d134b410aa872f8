"""Whole transformations: gold, analytics, marts, jobs."""
