"""Extract readers, the feed derived from the benchmark tables, written tables and sinks."""
