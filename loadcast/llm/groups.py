"""Groups that are worked on in blocks: no task ever holds a whole hot group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_blocks(members: DataFrame, group: str, member: str, blocks: Column) -> DataFrame:
    """Split every group into `blocks` random parts and pair the parts: columns i, j (i <= j) name a pair, `part` the row's.

    A row of a group of n parts appears in n pairs; every two rows of a group meet in exactly one.
    """
    part = F.pmod(F.xxhash64(F.lit(3), group, member), F.col("_n")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    return (
        members.withColumn("_n", F.greatest(F.lit(1), blocks).cast("int"))
        .withColumn("part", part)
        .withColumn("_o", other)
        .withColumn("i", F.least("part", "_o"))
        .withColumn("j", F.greatest("part", "_o"))
        .drop("_n", "_o")
    )


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows with equal integer `keys`, from batches sorted by them; holds one group and one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, stop in zip(starts[:-1], starts[1:], strict=True):
            here = tuple(c[start] for c in columns)
            if held and here != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = here
    if held:
        yield pa.Table.from_batches(held)


class Parts:
    """Which of n items are known to be connected; the label of a part is its smallest position."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: int, others: np.ndarray) -> None:
        labels = np.unique(self.label[np.append(others, a)])
        self.label[np.isin(self.label, labels)] = labels[0]

    def join_pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            low = np.minimum(self.label[a], self.label[b])
            roots = np.arange(len(self.label))
            np.minimum.at(roots, la[apart], low)
            np.minimum.at(roots, lb[apart], low)
            while True:
                jump = roots[roots]
                if (jump == roots).all():
                    break
                roots = jump
            self.label = roots[self.label]
