"""DataFrame operators: topics, positions, chunking, integrity, metrics."""
