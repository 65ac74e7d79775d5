"""Readers, row numbers, fingerprints and the synthetic export."""
