"""Structured Streaming: the aggregate specs in append mode, idempotent
micro-batch sinks with quarantine and fallback, and query supervision."""
