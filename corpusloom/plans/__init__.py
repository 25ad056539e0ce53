"""Whole queries and the end-to-end run, composed of the operators."""
