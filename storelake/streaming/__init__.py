"""Structured Streaming jobs: stateful order rules, fact and metric sinks."""
