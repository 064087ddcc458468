"""Iterative screening campaigns and corpus preparation as Spark jobs."""
