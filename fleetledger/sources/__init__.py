"""Readers, writers and adapters of the driver's tables."""
