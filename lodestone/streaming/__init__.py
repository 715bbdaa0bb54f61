"""Streams of dumps: batching, gap filling, late data and sinks."""
