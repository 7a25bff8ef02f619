"""The registered queries, their derived inputs and their DuckDB counterparts."""
