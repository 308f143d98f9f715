"""Operators for preparing training data: text, vectors and mixtures."""
