"""Readers: paged JSON connections, tables, introspection documents, files."""
