"""Relational operators over image, mapping and result tables."""
