"""Whole jobs: prepare tables, train and evaluate both models, score a live stream."""
