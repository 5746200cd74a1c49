"""Operators for preparing language-model training data (each module holds one operator and its query)."""
