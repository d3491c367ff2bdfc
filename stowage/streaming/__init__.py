"""The operators over unbounded event streams."""
