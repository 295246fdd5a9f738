"""File and table sources and sinks."""
