"""Relational operators of the event pipeline."""
