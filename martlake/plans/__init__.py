"""martlake.plans."""
