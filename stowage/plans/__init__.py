"""Whole passes: indexing a listing or a batch of events, and one scheduling cycle."""
