"""Record sources, the envelope, and sinks."""
