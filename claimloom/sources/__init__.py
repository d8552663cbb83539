"""Landing sources and table sinks."""
