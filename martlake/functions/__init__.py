"""martlake.functions."""
