"""Operators for training data: language, formatting, duplicates, leaks, secrets, mixing."""
