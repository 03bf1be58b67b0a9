"""Structured Streaming forms: stateful sessions, queries with checkpoints,
run helpers."""
