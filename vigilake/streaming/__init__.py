"""Running datasets as streams, stateful scoring, sinks."""
