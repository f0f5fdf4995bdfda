"""Helpers that several operators share: word hashing over Arrow batches, size-checked semi-joins, written tables."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varspan.sources.text import shared_folder

#: Most ids that a semi- or anti-join sends to every executor (about 32 MB as a hash table); more are shuffled.
BROADCAST_IDS = 1_000_000
#: Edges that components() joins up in one step of a task; so many or fewer are one step in all.
EDGES = 1 << 18
#: Bytes of batches from which a task gives its memory back; a full collection takes longer than the work on fewer.
TIDY_BYTES = 1 << 18
#: Bytes of text that one numpy step works on; a longer document is one step.
CHUNK_BYTES = 1 << 18

_SPACES = frozenset(b" \t\n\r\x0b\x0c")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_columns_of(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns, under internal names: columns of other or clashing names never meet them."""
    return df.select(*[df[name].alias(alias) for alias, name in wanted.items()])


def written(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def restrict(big: DataFrame, ids: DataFrame, on: str | list[str], how: str = "left_semi") -> DataFrame:
    """Semi- or anti-join with a table of ids: broadcast if a count shows it to be small, shuffled otherwise."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return big.join(F.broadcast(ids) if few else ids.hint("shuffle_hash"), on, how)


def labelled_sample(df: DataFrame, most: int, *by: str) -> DataFrame:
    """Up to `most` rows, for fitting: all, or of more those whose hash of the given columns falls in a share that a count sets, a tenth under
    the bound so that it cuts next to nothing. No row goes through a sort or a single task."""
    n = df.count()
    if n <= most:
        return df
    share = F.lit(int(0.9 * most / n * 2**62))
    return df.where(F.shiftrightunsigned(F.xxhash64(*by), 2) < share).limit(most)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random number for each byte; A-Z have those of a-z.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]

#: Bytes of words: all but white space; digits, letters and bytes from 0x80.
NON_SPACE = np.array([b not in _SPACES for b in range(256)])
ALNUM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])

_powers: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        up, down = np.full(max(n, CHUNK_BYTES + 4096), _ODD), np.full(max(n, CHUNK_BYTES + 4096), _INVERSE)
        up[0] = down[0] = 1
        _powers = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(buf: np.ndarray, fold: bool) -> np.ndarray:
    """Sums of byte numbers times powers; span_hash() takes the hash of any span from them."""
    up, _ = powers(len(buf))
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _BYTE)[buf] * up, out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes in [start, end), alike wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


class Words:
    """Words of several documents: hash of each, and of each document the first and the end index of its words."""

    def __init__(self, docs: list[bytes], letters: np.ndarray):
        buf = np.frombuffer(b" ".join([*docs, b""]) or b" ", np.uint8)
        inside = letters[buf]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        edge = np.concatenate([[0], edge]) if inside[0] else edge  # the last byte is a space: every word ends
        start, end = edge[::2], edge[1::2]
        self.hash = span_hash(prefix_hash(buf, True), start, end)
        bounds = np.cumsum([0, *[len(d) + 1 for d in docs]])
        at = np.searchsorted(start, bounds)
        self.first, self.last = at[:-1], at[1:]


def chunks(docs: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of documents of about `most` bytes together, with the index of the first."""
    i = 0
    while i < len(docs):
        j, size = i, 0
        while j < len(docs) and (j == i or size + len(docs[j]) <= most):
            size += len(docs[j])
            j += 1
        yield i, docs[i:j]
        i = j


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as bytes; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def tidied(run):
    """A function over batches that gives its memory back when a task ends: Spark keeps Python workers, and what one operator has
    freed but not returned would stand beside the next operator's arrays. A task that has seen next to nothing leaves it to later ones."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0

        def told(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal seen
            for b in found:
                seen += b.nbytes
                yield b

        for b in run(told(batches)):
            seen += b.nbytes
            yield b
        if seen < TIDY_BYTES:
            return
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
            trim(0)

    return wrapped


def text_chunks(batch: pa.RecordBatch, name: str, most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """chunks() of a text column of a batch; a few hundred rows are turned into bytes at a time."""
    for s in range(0, batch.num_rows, 256):
        for i, docs in chunks(utf8(batch.slice(s, 256), name), most):
            yield s + i, docs


def _stars(roots: bool = False):
    """A task's edges (u, v), EDGES at a time, as stars: each node and the smallest one that it reaches over them. roots: the smallest ones too."""

    def star(kept: list[pa.RecordBatch]) -> pa.RecordBatch:
        nodes, at = np.unique(np.concatenate([b.column(c).to_numpy() for c in "uv" for b in kept]), return_inverse=True)
        u, v = np.split(at, 2)
        low, last = np.arange(len(nodes)), None
        while last is None or (low != last).any():
            last, least = low, np.minimum(low[u], low[v])
            low = low.copy()
            for k in (u, v, last[u], last[v]):  # a node, and the one that it hangs on
                np.minimum.at(low, k, least)
            low = low[low]
        own = np.flatnonzero(roots | (low != np.arange(len(nodes))))
        return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[low[own]])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for b in batches:
            for i in range(0, b.num_rows, EDGES):
                kept.append(b.slice(i, EDGES))
                size += kept[-1].num_rows
                if size >= EDGES:
                    yield star(kept)
                    kept, size = [], 0
        if size:
            yield star(kept)

    return tidied(run)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over edges (a, b), longs, by alternating large and small stars.

    Each round is two grouped minima and joins; a node with very many edges is a skewed join key, which adaptive execution splits.
    Before and after, each task joins up what is connected by its own edges alone. Once EDGES or fewer are left, by a count, they are one
    step of one task and take no round, however many partitions shuffles have. Rounds end when all edges are stars: no node hangs on two, and none on a node that hangs on another."""
    joined = lambda e: e.distinct().mapInArrow(_stars(), "u long, v long")
    settled = lambda e: written(e.repartition(1).mapInArrow(_stars(True), "u long, v long")).toDF("node", "component")
    own = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars = own.mapInArrow(_stars(), "u long, v long")
    if own.count() <= EDGES:
        return settled(stars)
    now = written(joined(stars))
    while now.count() > EDGES:
        ends = now.select(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("root")).unionByName(now.select(F.col("v").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("root")))
        odd = ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("root").alias("root")).where("leaf > 1 or (leaf > 0 and root > 0)")
        if not odd.agg(F.count("*")).first()[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v")
        now = written(joined(small))
    return settled(now)
