"""SequenceFile sink with staged publish."""
