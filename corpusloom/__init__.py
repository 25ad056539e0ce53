"""Labelled-text analytics on Spark: checks, splits, cleaning, n-gram features, classifiers."""
