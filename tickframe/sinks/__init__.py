"""Output contracts and sinks."""
