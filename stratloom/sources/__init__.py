"""Readers and writers of the stage files."""
