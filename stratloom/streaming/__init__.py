"""Structured Streaming: job pick-up, status folding, idempotent merge."""
