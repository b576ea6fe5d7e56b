"""Operators over match, rating and squad tables."""
