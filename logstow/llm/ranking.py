"""Positions of rows in an order, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from logstow.llm.tables import written


def _number(columns: list[str], group: str):
    """Rows of a sorted partition with its number and their place in their group's run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(group)
            changes = np.concatenate(([True], keys[1:].to_numpy(False) != keys[:-1].to_numpy(False)))
            begins = np.flatnonzero(changes)
            place = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
            if keys[0].as_py() == last:
                place[: begins[1] if len(begins) > 1 else n] += seen
            last, seen = keys[n - 1].as_py(), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(np.full(n, part)), pa.array(place)],
                names=[*columns, "_part", "_place"],
            )

    return run


def ranked(df: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """The rows and, as longs, `position` in their group from 0, `group_size`, and
    `group_start`: how many rows lie in groups before theirs.

    Rows are dealt by ranges of (group, order), so a group of any size is spread over
    tasks; order should name a unique column last, by which rows that are otherwise
    equal can be parted. group must not be null. What meets in one place is one row
    per range, and one per range and group in it.
    """
    spark, by = df.sparkSession, [group, *order]
    numbers = [StructField(name, LongType()) for name in ("_part", "_place")]
    schema = StructType([*df.schema.fields, *numbers])
    placed = written(
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .mapInArrow(_number(df.columns, group), schema),
        f"{label}-ranges",
    )
    counts = written(
        placed.groupBy("_part", group).agg((F.max("_place") + 1).alias("_n")), f"{label}-counts"
    )
    totals = sorted(tuple(r) for r in counts.groupBy("_part").agg(F.sum("_n")).collect())
    begins = [0, *accumulate(n for _, n in totals)][: len(totals)]
    starts = spark.createDataFrame(
        [(part, begin) for (part, _), begin in zip(totals, begins, strict=True)],
        "_part long, _begin long",
    )
    before = Window.partitionBy("_part").orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy(group)
    spots = written(
        counts.join(starts, "_part")
        .withColumn("_at", F.col("_begin") + F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(
            "_part",
            group,
            "_at",
            F.min("_at").over(same).alias("group_start"),
            F.sum("_n").over(same).alias("group_size"),
        ),
        f"{label}-spots",
    )
    return placed.join(spots, ["_part", group]).select(
        *df.columns,
        (F.col("_at") - F.col("group_start") + F.col("_place")).alias("position"),
        "group_size",
        "group_start",
    )
