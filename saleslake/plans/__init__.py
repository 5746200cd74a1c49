"""saleslake.plans."""
