"""Record keys, object keys and their parsing, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The archive's naming formats.
RECORD_KEY_FORMAT = "%s:%d:%d:%d"
OBJECT_PATH_FORMAT = "%s/%d_%d_%019d_%019d"
RECORD_KEY_PATTERN = r"^(.*):(\d+):(\d+):(\d+)$"
OBJECT_NAME_PATTERN = r"^(\d+)_(\d+)_(.*)$"
LONG_PATTERN = r"^[+-]?[0-9]+$"


def record_key(topic="topic", broker_id="broker_id", partition_id="partition_id", offset="offset"):
    """`topic:broker:partition:offset`, the key every archived record carries."""
    return F.format_string(
        RECORD_KEY_FORMAT, F.col(topic), F.col(broker_id), F.col(partition_id), F.col(offset)
    )


def payload_size(value="value") -> Column:
    """Payload bytes without any header. Strings count their UTF-8 bytes."""
    return F.octet_length(F.col(value)).cast("long")


def normalize_prefix(prefix: Column) -> Column:
    """Drop one trailing slash."""
    return F.regexp_replace(prefix, "/$", "")


def object_path() -> Column:
    """A chunk's place below the archive's prefix; padded to sort by offset."""
    return F.format_string(
        OBJECT_PATH_FORMAT,
        F.col("topic"),
        F.col("broker_id"),
        F.col("partition_id"),
        F.col("start_offset"),
        F.col("end_offset"),
    )


def object_key(prefix: Column | str) -> Column:
    """Full name of a chunk's object."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(prefix, F.lit("/"), object_path())


def object_name_fields(name: Column) -> dict[str, Column]:
    """Split `<broker>_<partition>_<start>_<end>`.

    Only the element after the start offset has to be a number; what follows
    it is ignored. `end_offset` is null where the name is not one of ours.
    """
    elements = F.split(F.regexp_extract(name, OBJECT_NAME_PATTERN, 3), "_")

    def as_long(column):
        return F.when(column.rlike(LONG_PATTERN), column.try_cast("long"))

    def extract_int(group):
        return F.regexp_extract(name, OBJECT_NAME_PATTERN, group).try_cast("int")

    return {
        "broker_id": extract_int(1),
        "partition_id": extract_int(2),
        "start_offset": as_long(F.get(elements, 0)),
        "end_offset": as_long(F.get(elements, 1)),
    }


def record_key_fields(key: Column) -> dict[str, Column]:
    """Split a record key; the topic may itself contain colons."""

    def part(group):
        return F.regexp_extract(key, RECORD_KEY_PATTERN, group)

    return {
        "topic": part(1),
        "broker_id": part(2).try_cast("int"),
        "partition_id": part(3).try_cast("int"),
        "offset": part(4).try_cast("long"),
    }
