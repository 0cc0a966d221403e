"""Readers and the archive sink."""
