"""End-to-end layer jobs, the query registry and plan inspection helpers."""
