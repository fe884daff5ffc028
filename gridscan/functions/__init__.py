"""SQL functions."""
