"""Message sources: Kafka, and a file log with the same columns."""
