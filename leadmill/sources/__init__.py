"""Readers and writers of a campaign's files."""
