"""Published tables and the jobs that build them."""
