"""Whole jobs: render corpora, build training data, evaluate models."""
