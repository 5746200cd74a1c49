"""saleslake.streaming."""
