"""Operators for training-data corpora: token counts, secrets, quality, neighbours, pieces, URLs, languages, mixing, copies."""
