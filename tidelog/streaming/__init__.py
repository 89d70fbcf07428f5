"""Structured Streaming forms: materialising runs and per-key state."""
