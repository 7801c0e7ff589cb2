"""End-to-end jobs and the registered queries over the test tables."""
