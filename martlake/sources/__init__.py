"""martlake.sources."""
