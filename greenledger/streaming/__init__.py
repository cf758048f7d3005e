"""Event-time submissions as a stream."""
