"""Readers, landing writers and zone tables."""
