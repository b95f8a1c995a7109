"""Micro-batch vault loads with Structured Streaming."""
