"""Registered queries and command-line jobs."""

from . import exchange  # noqa: F401 (registers its queries)
