"""Structured Streaming jobs: runner, sinks, stateful processors."""
