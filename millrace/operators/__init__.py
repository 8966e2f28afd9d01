"""Frame-level building blocks: ranking, windows, dedup, merge, quality tests, similarity."""
