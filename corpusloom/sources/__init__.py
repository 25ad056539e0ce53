"""Readers and writers: labelled text folders, CSV tables, result tables, run metadata."""
