"""Result files as they arrive."""
