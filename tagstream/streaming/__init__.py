"""Streaming jobs: message stream to cache, message stream to SQL table."""
