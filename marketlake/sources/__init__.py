"""Readers, writers, landing and catalog."""
