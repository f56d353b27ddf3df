"""Readers, normalisers and the adapter onto the star-schema tables."""
