"""Readers and writers: exported hits, bronze files, silver and gold tables."""
