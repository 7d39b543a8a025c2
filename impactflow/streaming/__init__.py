"""Structured Streaming: source, cleaning, watermark, deduplication, sinks."""
