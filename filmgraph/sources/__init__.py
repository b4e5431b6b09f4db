"""Readers and writers: dataset files, graph storage, and fixture inputs for tests."""
