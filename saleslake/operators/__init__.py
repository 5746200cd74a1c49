"""saleslake.operators."""
