"""Operators and queries for large training corpora; nothing else in the library imports this folder."""
