"""Readers, test-table bindings, stream source and sinks."""
