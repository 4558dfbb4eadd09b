"""Structured Streaming flows over the same operators the batch jobs use."""
