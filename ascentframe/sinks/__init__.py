"""sinks."""
