"""Structured Streaming forms of the candle jobs."""
