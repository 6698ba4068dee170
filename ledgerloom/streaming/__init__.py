"""The order feed as a stream."""
