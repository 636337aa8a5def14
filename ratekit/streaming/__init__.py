"""Streaming use of fitted models (the reference itself has no streaming)."""
