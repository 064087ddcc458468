"""Column functions and molecule functions."""
