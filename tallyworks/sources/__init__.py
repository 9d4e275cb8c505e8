"""Readers: files, message topics and the dictionary table."""
