"""DataFrame operators; they work alike on batch and streaming input unless noted."""
