"""Running sums and maxima in an order, over range partitions: no window and no group holds the rows of a place, a run or a chromosome.

Rows go to partitions by range and are sorted there. Each partition runs through its own rows, starting anew with each group; what a group
that began in earlier partitions had there comes from one row a partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values of a running maximum stay under this in size.
LARGEST = 1 << 42


def _anew(batch: pa.RecordBatch, group: list[str], last: tuple | None) -> np.ndarray:
    """Where rows begin another group than the row before, which for the first row is the last one of the batch before."""
    new = np.zeros(batch.num_rows, bool)
    for g in group:
        codes = batch.column(g).dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    new[0] = last is None or last != tuple(batch.column(g)[0].as_py() for g in group)
    return new


def _run(group: list[str], values: list[str], how: str):
    """Appends for each value its sum up to and with the row, or its maximum over the group's earlier rows (null for none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        carry = dict.fromkeys(values)
        for b in batches:
            if not b.num_rows:
                continue
            new = _anew(b, group, last)
            part = np.cumsum(new)  # 0: rows of the group that the last batch ended with
            more = []
            for v in values:
                x = b.column(v).to_numpy(zero_copy_only=False).astype(np.int64)
                if how == "sum":
                    total = np.cumsum(x)
                    begins = np.concatenate([[0], np.flatnonzero(new)])
                    before = np.where(begins > 0, total[begins - 1], 0)
                    out = total - before[part] + np.where(part == 0, carry[v] or 0, 0)
                    carry[v] = int(out[-1])
                    more.append(pa.array(out))
                else:
                    # groups are kept apart by steps wider than any value
                    top = np.maximum.accumulate(x + part * (2 * LARGEST)) - part * (2 * LARGEST)
                    if carry[v] is not None:
                        top = np.where(part == 0, np.maximum(top, carry[v]), top)
                    first = None if new[0] else carry[v]
                    held = np.concatenate([[0 if first is None else first], top[:-1]])
                    none = new.copy()
                    carry[v] = int(top[-1])
                    more.append(pa.array(held, mask=none))
            last = tuple(b.column(g)[-1].as_py() for g in group)
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, *(f"_run_{v}" for v in values)])

    return run


def running(df: DataFrame, group: list[str], order: list[str | Column], values: list[str], how: str = "sum", partitions: int | None = None) -> DataFrame:
    """Adds for each of the values (whole numbers, not null) `<value>_upto`, its sum over the rows of the group up to and with the row, or with how
    `max` `<value>_before`, its maximum over the rows of the group before the row, null for the first. Rows that are alike in group and order stand in any order."""
    from varspan.sources.text import checkpointed

    by = [*group, *order]
    d = df.withColumns({v: F.col(v).cast("long") for v in values})
    d = d.repartitionByRange(partitions, *by) if partitions else d.repartitionByRange(*by)
    d = d.sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id())
    kinds = ", ".join([f"`{n}` {k}" for n, k in d.dtypes] + [f"`_run_{v}` bigint" for v in values])
    d = checkpointed(d.mapInArrow(_run(group, values, how), kinds))
    agg = F.sum if how == "sum" else F.max
    held = d.groupBy("_part", *group).agg(*[agg(v).alias(v) for v in values])
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a group's partitions
    base = held.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{k}") for k, g in enumerate(group)], *[agg(v).over(before).alias(f"_base_{v}") for v in values])
    base = base.where(" or ".join(f"_base_{v} is not null" for v in values))  # a partition's first group at most
    same = F.col("_part") == F.col("_p")
    for k, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    j = d.join(F.broadcast(base), same, "left")
    if how == "sum":
        new = {f"{v}_upto": F.col(f"_run_{v}") + F.coalesce(f"_base_{v}", F.lit(0)) for v in values}
    else:
        new = {f"{v}_before": F.greatest(f"_run_{v}", f"_base_{v}") for v in values}
    return j.withColumns(new).select(*df.columns, *new)
