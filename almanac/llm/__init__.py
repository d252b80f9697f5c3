"""Operators for cleaning, scoring and indexing training text; nothing else in the library imports them."""
