"""saleslake.functions."""
