"""Feed files, databases, message streams, version state."""
