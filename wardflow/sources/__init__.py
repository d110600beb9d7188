"""Readers and writers: files, lake tables and the warehouse."""
