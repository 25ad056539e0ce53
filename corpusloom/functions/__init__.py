"""Column functions: every one takes and returns Spark columns and needs no shuffle."""
