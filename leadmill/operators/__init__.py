"""Relational operators of a campaign."""
