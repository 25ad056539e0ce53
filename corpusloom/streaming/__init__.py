"""The row-level stages applied to streaming tables."""
