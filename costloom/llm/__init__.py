"""Operators for training-data pipelines: cleaning, near duplicates, scans, classifiers, tokens."""
