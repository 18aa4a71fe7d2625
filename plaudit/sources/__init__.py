"""Readers: raw lines, lake tables, change feeds, JDBC tables, star-schema projection."""
