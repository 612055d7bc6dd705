"""Conflict-constrained best-fit packing of documents into bins of ``capacity`` words.

Documents are dealt by a hash of their id to groups of about ``GROUP_ROWS``, and each group is packed
on its own, longest piece first. Rows that are equal in id, source, cluster and length are counted before
they are shuffled and then dealt one by one, so they spread over all groups too. A longer document is cut into full pieces, a bin each, and a rest.
Open bins are ordered by residual; each carries bitmaps of the sources and of the duplicate clusters
it holds. A piece goes to the tightest bin with room that does not hold its cluster, and holds its
source fewer than ``per_source`` times: the search takes the next larger residual until a bin agrees,
and opens a bin otherwise.

A hot source or cluster spreads over all groups; within one it costs one bit test for each bin.
Only ids, sources, cluster hashes and lengths are shuffled.

Defined cases: a document without words has a place in a bin but takes no room. Nulls of source are a
source, of cluster no cluster. Repeated rows are separate documents of one cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.shipping import ship
from lakelayers.scratch import stage

CAPACITY = 2048
PER_SOURCE = 2
GROUP_ROWS = 4096
COPIES = 10_000

PLACED = "doc_id long, piece int, start long, n_words long, group_id long, bin int, bin_words long"


class Bins:
    """Open bins by residual. ``sources`` has a bitmap for each repetition of a source allowed."""

    def __init__(self, capacity: int, per_source: int) -> None:
        self.capacity, self.per_source = capacity, per_source
        self.levels: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.filled = 0  # bit r: some bin has residual r
        self.residual: list[int] = []
        self.sources: list[list[int]] = []
        self.clusters: list[int] = []

    def put(self, size: int, source: int, cluster: int) -> int:
        """``source`` and ``cluster`` are bits; cluster 0 conflicts with nothing. Returns the bin."""
        above = self.filled >> size << size
        while above:
            residual = (above & -above).bit_length() - 1
            level = self.levels[residual]
            for place, number in enumerate(level):
                if not (self.clusters[number] & cluster or self.sources[number][-1] & source):
                    level[place] = level[-1]
                    level.pop()
                    if not level:
                        self.filled ^= 1 << residual
                    return self._hold(number, size, source, cluster)
            above &= above - 1
        self.residual.append(self.capacity)
        self.sources.append([0] * self.per_source)
        self.clusters.append(0)
        return self._hold(len(self.residual) - 1, size, source, cluster)

    def _hold(self, number: int, size: int, source: int, cluster: int) -> int:
        self.residual[number] -= size
        self.clusters[number] |= cluster
        planes = self.sources[number]
        planes[next(i for i, plane in enumerate(planes) if not plane & source)] |= source
        left = self.residual[number]
        self.levels[left].append(number)
        self.filled |= 1 << left
        return number


def pack_group(capacity: int, per_source: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        full = (rows["n_words"] // capacity).to_numpy()
        rest = (rows["n_words"] % capacity).to_numpy()
        last = (rest > 0) | (full == 0)
        row = np.repeat(np.arange(len(rows)), full + last)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(full + last) - full - last, full + last)
        size = np.where(piece < full[row], capacity, rest[row])
        source = pd.factorize(rows["source"], use_na_sentinel=False)[0]
        cluster, _ = pd.factorize(rows["cluster"])
        often = np.bincount(cluster[row][cluster[row] >= 0], minlength=1) > 1
        bit = np.where(often, np.cumsum(often) - 1, -1)
        ids = rows["doc_id"].fillna(-1).to_numpy() if rows["doc_id"].isna().any() else rows["doc_id"].to_numpy()
        order = np.lexsort((piece, rows["cluster"].to_numpy()[row], ids[row], -size))
        bins, number = Bins(capacity, per_source), np.zeros(len(row), np.int32)
        for i in order.tolist():
            r = row[i]
            shared = bit[cluster[r]] if cluster[r] >= 0 else -1
            number[i] = bins.put(int(size[i]), 1 << int(source[r]), 1 << int(shared) if shared >= 0 else 0)
        return pd.DataFrame({
            "doc_id": rows["doc_id"].to_numpy()[row], "piece": piece.astype(np.int32), "start": piece * capacity, "n_words": size,
            "group_id": rows["group_id"].to_numpy()[row], "bin": number, "bin_words": capacity - np.array(bins.residual)[number],
        })

    return run


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster_col: str | None = None,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row for each piece: doc_id, piece, start (its first word), n_words, group_id, bin (within
    the group), bin_words (words in that bin). Without ``cluster_col`` equal texts are a cluster."""
    ship(df.sparkSession)
    cluster = F.col(cluster_col).cast("long") if cluster_col else F.xxhash64(text_col)
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"),
        F.col(source_col).cast("string").alias("source"),
        cluster.alias("cluster"),
    )
    columns = rows.columns
    counted = stage(rows.groupBy(*columns).agg(F.count("*").alias("copies")), "packing-lengths")
    groups = 1 + (counted.agg(F.sum("copies")).first()[0] or 0) // group_rows
    few = counted.filter(F.col("copies") <= COPIES).selectExpr(*columns, "explode(sequence(1L, copies)) copy")
    many = counted.filter(F.col("copies") > COPIES).selectExpr("*", f"explode(sequence(0L, (copies - 1) div {COPIES})) portion")
    many = many.repartition(*columns, "portion").selectExpr(
        *columns, f"explode(sequence(portion * {COPIES} + 1, least(copies, (portion + 1) * {COPIES}))) copy"
    )
    dealt = few.unionByName(many).withColumn("group_id", F.pmod(F.xxhash64("doc_id", "cluster", "copy"), F.lit(groups)))
    return dealt.drop("copy").groupBy("group_id").applyInPandas(pack_group(capacity, per_source), PLACED)
