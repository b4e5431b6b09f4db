"""Whole jobs and query surfaces composed from the operators: graph building, load jobs,
lookup/search and traversal."""
