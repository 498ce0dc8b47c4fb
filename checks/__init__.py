"""The registered queries, the frames they start from and their DuckDB equivalents."""
