"""Structured Streaming: incremental load of raw CSV drops into the raw table."""
