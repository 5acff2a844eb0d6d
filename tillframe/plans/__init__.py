"""Reports made of several analyses, and the catalogue of queries."""
