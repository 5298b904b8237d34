"""Structured Streaming beyond the batch flow."""
