"""Bridge views over the test tables and the registered query catalog."""
