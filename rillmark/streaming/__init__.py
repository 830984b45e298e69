"""Structured Streaming twins: stateful processors, sinks, lateness, keyed snapshots."""
