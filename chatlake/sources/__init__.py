"""Readers, writers and the stored tables with their progress marks."""
