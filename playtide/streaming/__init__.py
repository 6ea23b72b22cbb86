"""Structured Streaming forms of the event rules, their sources and sinks."""
