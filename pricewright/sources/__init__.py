"""Readers, writers, the model registry and the adapter for the star-schema test tables."""
