"""Change-stream jobs: keyed enrichment, landing in the lake, cold archive."""
