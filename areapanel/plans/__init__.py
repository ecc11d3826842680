"""Jobs, served views, and the registered test-table queries."""
