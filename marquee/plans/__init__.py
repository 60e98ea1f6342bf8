"""Jobs: compositions of sources, operators and sinks."""
