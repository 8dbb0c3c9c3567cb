"""Operators on text for language-model training data; nothing outside imports this package."""
