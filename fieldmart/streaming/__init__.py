"""Streaming forms of the operators that the batch reports poll for."""
