"""Readers, writers and the synthetic population."""
