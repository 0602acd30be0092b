"""Readers and writers: landing files, topics and the stored readings table."""
