"""Readers and writers of raw tables, landed extracts, seeds and snapshots."""
