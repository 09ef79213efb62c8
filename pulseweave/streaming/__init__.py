"""Structured Streaming: stateful processors, sinks and jobs."""
