"""Comparing the rows of a group with one another in blocks of bounded size.

A group of any size is cut into chunks by a hash of the row. A task compares one chunk,
its home rows, with itself and with a stream of visitors from later chunks, so every pair
of rows meets once and no task holds more than one chunk. Long lines of visitors are cut
into slices that each get a copy of the home rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOME = 2048  # rows of a chunk, about
SLICE = 32  # chunks of visitors that one task streams


def into_blocks(rows: DataFrame, group: str, row: str, size: str, home: int | None = None) -> DataFrame:
    """Copies of ``rows`` with their places: block_i, block_s, side (0 home, 1 visitor), own.

    ``size`` is a column with the number of rows of the group, ``home`` about the rows of
    a chunk. A block is (group, block_i, block_s); home rows of a block are compared with
    each other where ``own`` holds.
    """
    chunks = F.ceil(F.col(size) / F.lit(home or HOME)).cast("int")
    last = F.floor((F.col("__chunks") - 1) / SLICE).cast("int")
    i = F.col("__chunk")
    own_slice = F.floor(i / SLICE).cast("int")
    place = lambda a, s, side, own: F.struct(
        a.cast("int").alias("block_i"), s.cast("int").alias("block_s"), F.lit(side).alias("side"), own.alias("own")
    )
    homes = F.transform(F.sequence(own_slice, last), lambda s: place(i, s, 0, s == own_slice))
    earlier = F.when(i == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), i - 1))
    visits = F.transform(earlier, lambda a: place(a, own_slice, 1, F.lit(False)))
    return (
        rows.withColumn("__chunks", chunks)
        .withColumn("__chunk", F.pmod(F.xxhash64(F.lit(7), row), F.col("__chunks")).cast("int"))
        .withColumn("__place", F.explode(F.concat(homes, visits)))
        .select(*rows.columns, "__place.*")
    )


def by_block(rows: DataFrame, *keys: str) -> DataFrame:
    """All rows of a block in one task, home rows first."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, "side")


def key_runs(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, int, int]]:
    """Runs of rows with equal keys: (key, first row, row after the last)."""
    n = batch.num_rows
    change = np.zeros(n + 1, bool)
    change[0] = change[n] = True
    for name in keys:
        column = batch.column(name).to_numpy(zero_copy_only=False)
        change[1:n] |= column[1:] != column[:-1]
    cuts = np.flatnonzero(change)
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield tuple(batch.column(name)[int(a)].as_py() for name in keys), int(a), int(b)


def block_events(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[str, pa.Table]]:
    """("home", all home rows of a block), then ("visit", some of its visitors) as they come.

    ``batches`` come sorted as ``by_block`` sorts them; the last key must be ``side``.
    Visitors of a block whose chunk turned out empty meet nobody and are passed over.
    """
    now, ready, waiting = None, None, []
    for batch in batches:
        for key, a, b in key_runs(batch, keys):
            part = pa.Table.from_batches([batch.slice(a, b - a)])
            block, side = key[:-1], key[-1]
            if waiting and (block != now or side):
                yield "home", pa.concat_tables(waiting).combine_chunks()
                ready, waiting = now, []
            now = block
            if not side:
                waiting.append(part)
            elif block == ready:
                yield "visit", part
    if waiting:
        yield "home", pa.concat_tables(waiting).combine_chunks()
