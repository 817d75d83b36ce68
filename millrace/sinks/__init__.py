"""sinks of the engine."""
