"""martlake.streaming."""
