"""Structured Streaming form of the window load."""
