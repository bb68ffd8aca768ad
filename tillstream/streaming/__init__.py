"""Structured Streaming: deduplication, sinks, jobs and progress records."""
