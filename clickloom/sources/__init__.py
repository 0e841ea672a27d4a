"""Readers and writers for the raw files, the layers and the catalogue."""
