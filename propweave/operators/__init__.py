"""Relational operators over the property model."""
