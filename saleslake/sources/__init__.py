"""saleslake.sources."""
