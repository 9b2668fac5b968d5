"""Structured Streaming: ingest of messages and events, and live metrics."""
