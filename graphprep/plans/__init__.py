"""User-level jobs, the sample graph over the test tables and the query catalogue."""
