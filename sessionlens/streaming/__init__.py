"""Structured Streaming forms of the engine's time-series operators."""
