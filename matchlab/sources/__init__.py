"""Schemas, readers, writers and the keyed upsert."""
