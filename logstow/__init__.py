"""logstow: archive topic messages as offset-named SequenceFile chunks, on Spark."""

from logstow.config import ArchiveConfig, ConfigError
from logstow.model import PARTITION_KEY, ChunkRule

__all__ = ["ArchiveConfig", "ChunkRule", "ConfigError", "PARTITION_KEY"]
