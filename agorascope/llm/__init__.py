"""Operators for training-data pipelines: dedup, decontamination, search, classifiers, mixing, extraction."""
