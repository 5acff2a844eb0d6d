"""Tables: files, the mapping of the test data, and generated data."""
