"""Message sources (tables, file streams, Kafka) and archive readers."""
