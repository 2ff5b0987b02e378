"""Readers: queries, databases, files, binary dumps, generated tables."""
