"""Whole jobs: prepare a snapshot, check drift, train and promote, score."""
