"""Operators for the preparation of training data: ten jobs over tables of texts and pages."""
