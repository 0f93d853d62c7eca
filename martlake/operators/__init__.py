"""martlake.operators."""
