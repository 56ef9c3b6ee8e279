"""Operators for training-data preparation over document tables."""
