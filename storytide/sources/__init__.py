"""Readers and writers for lexicons, books, metadata, trajectories and models."""
