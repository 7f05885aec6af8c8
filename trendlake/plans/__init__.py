"""Jobs: sources, operators and sinks put together."""
