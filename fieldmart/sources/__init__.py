"""Readers. Connection settings always come from the caller."""
