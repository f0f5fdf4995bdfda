r"""Operator 8, n-gram Jaccard join: a size-aware heavy-light self-join on sets of 5-word shingles, and its components.

Documents of equal sets are one class; all later steps see one document of each class. Sets up to a boundary size are
joined by enumerating fixed-size subsets: with c the least overlap that a set of size m needs, both sets of a pair hold a
common c-subset. Larger sets are joined by scanning inverted lists of their prefix tokens, rarest shingles first. Any order is
exact, so the order goes by counts of all shingles of all documents in a table of fixed size, where several share a cell:
lists stay short at every frequency. The boundary is the size with the least counted cost: subsets to enumerate below it
against list entries to scan above it.

Pairs are verified on the whole texts, once sizes and parity bitmaps (which bound the sets' difference from below) don't
rule them out. Only links between parts that aren't connected yet matter for components, so pivot rounds verify one pivot for
each list and member, in proportion to the list's length: first the pivot that a member shares most lists with, then a pivot
drawn by each list. The last round verifies what is left: pairs of a list in different components, and of sizes that allow a
link. So no link is lost and dense groups of near copies cost a line, not a square. Components come from alternating large and
small stars.

Words are runs of non-white-space with A-Z lower-cased; with fewer than five the whole sequence is one shingle.
Defined results: null, empty and blank texts have empty sets, size 0, and are their own component; a row with a null doc_id
links as others do, and its component is the smallest doc_id that is not null; rows that repeat a doc_id and a text are one class; other columns are kept out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import combinations, islice
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varspan.llm.common import BROADCAST_IDS, NON_SPACE, Words, components, mix, restrict, text_chunks, tidied, utf8, with_columns_of, written

SHINGLE, PERCENT = 5, 80
#: Largest set that subsets may be enumerated for, and the largest partner of such a set.
SMALL, SMALL_PARTNER = 24, 30
#: Bits of a cell's number in the table of counts, and of its place in a block of cells.
CELL, BLOCK = 23, 12
#: Shingles that are counted in one step.
STEP = 1 << 19
#: Pivot rounds before all remaining pairs are verified.
PIVOT_ROUNDS = 3
_K = np.uint64(0xD6E8FEB86659FD93)

#: Bits of a set's parity bitmap: a power of two not below its size, within these.
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 20

SETS = "doc_id long, n long, cid long, key binary, tokens array<long>, bits array<long>"


def parity(s: np.ndarray) -> np.ndarray:
    """Bitmap of the parity of a set's shingles by the low bits of their hashes: two bitmaps differ in no more bits than the sets in
    shingles. One of twice the length folds to the shorter by xor of its halves."""
    bits = min(max(LEAST_BITS, 1 << max(0, len(s) - 1).bit_length()), MOST_BITS)
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def shingle_sets(docs: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    w, out = Words(docs, NON_SPACE), []
    h = w.hash
    s = h[: max(0, len(h) - SHINGLE + 1)].copy()
    for k in range(1, SHINGLE):
        s = s * _K + h[k : k + len(s)]
    s = mix(s)
    for a, b in zip(w.first.tolist(), w.last.tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(s[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(np.array([int.from_bytes(hashlib.blake2b(h[a:b].tobytes(), digest_size=8).digest(), "little")], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(n: int) -> int:
    """Tokens of a set of size n of which a linked set has one at least."""
    return n - -(-PERCENT * n // 100) + 1


def index_prefix_length(n: int) -> int:
    """The same for the smaller set of a pair: its partner is no smaller."""
    return n - subset_size(n) + 1


def subset_size(n: int) -> int:
    """Least overlap of a set of size n with a linked set of size n or more."""
    return -(-2 * PERCENT * n // (100 + PERCENT))


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELL)).astype(np.int64)


@tidied
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts of shingles, block by block of cells."""
    counts, kept, size = np.zeros(1 << CELL, np.uint32), [], 0

    def add() -> None:
        cell, n = np.unique(np.concatenate(kept), return_counts=True)
        counts[cell] += n.astype(np.uint32)

    for b in batches:
        for _, docs in text_chunks(b, "text"):
            for s in shingle_sets(docs):
                kept.append(_cells(s))
                size += len(s)
            if size > STEP:
                add()
                kept, size = [], 0
    if kept:
        add()
    # cells hold few shingles of one task each: a byte a cell, which deflates to a bit or two, and the few large counts apart
    low, large = np.minimum(counts, 255).astype(np.uint8).reshape(-1, 1 << BLOCK), np.flatnonzero(counts > 255)
    for k in np.flatnonzero(low.any(axis=1)).tolist():
        own = large[np.searchsorted(large, k << BLOCK) : np.searchsorted(large, (k + 1) << BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(low[k].tobytes(), 1)], pa.binary()), pa.array([own.astype(np.int64).tobytes() + counts[own].astype(np.int64).tobytes()], pa.binary())], ["block", "cells", "large"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of the cells of each block in this partition: eighths of the binary logarithm of the summed counts."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for block, cells, large in zip(*(b.column(c).to_pylist() for c in ("block", "cells", "large")), strict=True):
            n, (at, many) = np.frombuffer(zlib.decompress(cells), np.uint8).astype(np.float64), np.frombuffer(large, np.int64).reshape(2, -1)
            n[at & ((1 << BLOCK) - 1)] = many
            total[block] = total[block] + n if block in total else n
    for block, n in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.minimum(np.log2(n + 1) * 8, 255).astype(np.uint8).tobytes()], pa.binary())], ["block", "ranks"])


def ranks(docs: DataFrame) -> np.ndarray:
    """The rank of each cell by the number of shingles in it, over all documents: a table of 2 ** CELL bytes at any size of the input."""
    parts = docs.select("text").mapInArrow(_counted, "block int, cells binary, large binary")
    out = np.zeros(1 << CELL, np.uint8)
    for r in parts.repartition("block").mapInArrow(_summed, "block int, ranks binary").collect():  # a row a block
        out[r.block << BLOCK : (r.block + 1) << BLOCK] = np.frombuffer(r.ranks, np.uint8)
    return out


def _sets(rank):
    """rank: the table of ranks, broadcast."""

    def ordered(s: np.ndarray) -> np.ndarray:
        return s[np.argsort(rank.value[_cells(s)], kind="stable")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, docs in text_chunks(b, "text"):
                sets = shingle_sets(docs)
                key = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                tokens = [ordered(s)[: prefix_length(len(s)) if len(s) > SMALL_PARTNER else None].view(np.int64) for s in sets]
                ends = np.cumsum([0, *map(len, tokens)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*tokens, np.zeros(0, np.int64)])))
                cid = pa.array([int.from_bytes(k[:8], "little", signed=True) if k else None for k in key], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, len(docs)), pa.array([len(s) for s in sets], pa.int64()), cid, pa.array(key, pa.binary()), lists, pa.array([parity(s) for s in sets], pa.list_(pa.int64()))], ["doc_id", "n", "cid", "key", "tokens", "bits"])

    return tidied(run)


def boundary(sets: DataFrame) -> int:
    """Size up to which enumerating subsets costs no more rows than scanning lists; a row for each small size comes to the driver."""
    small = sets.where(F.col("n").between(1, SMALL_PARTNER))
    entry = small.select("n", F.posexplode(F.slice("tokens", F.lit(1), (F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1).cast("int"))).alias("k", "t"))
    length = entry.groupBy("t").agg(F.count("*").alias("size"))
    counts = entry.join(length, "t").groupBy("n").agg(F.sum("size").alias("scan"), F.count_if(F.col("k") == 0).alias("number")).collect()
    scan, number = ({r.n: r[c] for r in counts} for c in ("scan", "number"))

    def cost(limit: int) -> int:
        subsets = sum(number.get(n, 0) * sum(comb(n, subset_size(m)) for m in range(-(-PERCENT * n // 100), min(n, limit) + 1)) for n in range(1, limit * 100 // PERCENT + 1))
        return subsets + sum(scan.get(n, 0) for n in range(limit + 1, SMALL_PARTNER + 1))

    return min(range(SMALL + 1), key=cost)


def _subsets(limit: int):
    def signature(m: int, c: tuple) -> int:
        return int.from_bytes(hashlib.blake2b(np.array([m, *sorted(c)], np.int64).tobytes(), digest_size=8).digest(), "little", signed=True)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int]]:
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                for r in b.slice(i, 1000).to_pylist():
                    n = r["n"]
                    for m in range(max(1, -(-PERCENT * n // 100)), min(n, limit) + 1):
                        for c in combinations(r["tokens"], subset_size(m)):
                            yield signature(m, c), r["cid"], n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = rows(batches)
        while some := list(islice(every, 50_000)):  # however many subsets a set has
            yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in zip(*some, strict=True)], pa.array([True] * len(some))], ["sig", "cid", "n", "lead"])

    return run


def signatures(sets: DataFrame, limit: int) -> DataFrame:
    """(sig, cid, n, lead): subsets of small sets and prefix tokens of large ones; lead: also a token of the shorter prefix."""
    large = sets.where(F.col("n") > limit)
    size = lambda share: (F.col("n") - F.ceil(share) + 1).cast("int")
    tokens = large.select("cid", "n", size(F.col("n") * PERCENT * 2 / (100 + PERCENT)).alias("short"), F.posexplode(F.slice("tokens", F.lit(1), size(F.col("n") * PERCENT / 100))).alias("k", "sig"))
    tokens = tokens.select("sig", "cid", "n", (F.col("k") < F.col("short")).alias("lead"))
    if not limit:
        return tokens
    small = sets.where(F.col("n") <= limit * 100 // PERCENT).select("cid", "n", "tokens")
    return tokens.unionByName(small.mapInArrow(_subsets(limit), "sig long, cid long, n long, lead boolean"))


@tidied
def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: dict[int, np.ndarray] = {}
    for b in batches:
        for i in range(0, b.num_rows, 200):
            part = b.slice(i, 200)
            a, c = part.column("a").to_pylist(), part.column("b").to_pylist()
            ta, tb = utf8(part, "text_a"), utf8(part, "text_b")
            new = {k: t for k, t in zip(a, ta, strict=True) if k not in kept}
            here = set(a)
            kept = {k: v for k, v in kept.items() if k in here} | dict(zip(new, shingle_sets(list(new.values())), strict=True))
            ok = []
            for k, s in zip(a, shingle_sets(tb), strict=True):
                both = len(np.intersect1d(kept[k], s, assume_unique=True))
                ok.append(100 * both >= PERCENT * (len(kept[k]) + len(s) - both))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(ok)], ["a", "b", "linked"])


def promising(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) that sizes and parity bitmaps don't rule out. Both tests are exact: a linked pair always passes."""
    x, y = (sketches.select(F.col("cid").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab")
    j = pairs.select("a", "b").join(x, "a").join(y, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT)
    m = F.least(F.size("bits_a"), F.size("bits_b"))
    xor = lambda v, w: v.bitwiseXOR(w)
    # linked sets differ in size by a quarter at most, so their bitmaps are of one length or one is of twice the other's
    fold = lambda c: F.when(F.size(c) > m, F.zip_with(F.slice(c, F.lit(1), m), F.slice(c, m + 1, m), xor)).otherwise(F.col(c))
    differ = F.aggregate(F.zip_with(fold("bits_a"), fold("bits_b"), lambda v, w: F.bit_count(xor(v, w))), F.lit(0), lambda n, v: n + v)
    return j.where(differ * (100 + PERCENT) <= (F.col("na") + F.col("nb")) * (100 - PERCENT)).select("a", "b")


def verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, linked) of class pairs, on whole texts. Only texts of classes in some pair leave the scan."""
    pairs = written(pairs)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    # rows without an id are all read where a class has no other; each text then stands once
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias("doc")
    reps = written(classes.select("cid", "rep").join(ids, "cid").select(named("rep")).distinct())
    texts = restrict(docs.select(named("doc_id"), "text"), reps, "doc").mapInArrow(_named, "cid long, text string")
    if not reps.where("doc = ''").isEmpty():
        texts = texts.dropDuplicates(["cid"])
    x, y = (texts.select(F.col("cid").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    return written(pairs.join(x, "a").join(y, "b").select("a", "b", "text_a", "text_b").mapInArrow(_linked, "a long, b long, linked boolean"))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, class_id, component_id of every row."""
    docs = with_columns_of(docs, doc_id=id_col, text=text_col)
    sets = written(docs.mapInArrow(_sets(docs.sparkSession.sparkContext.broadcast(ranks(docs))), SETS))
    classes = written(sets.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("cid").alias("cid"), F.first("n").alias("n")))
    row = F.xxhash64("doc_id", "key").alias("row")  # a row too many does no harm
    unique = restrict(sets.where("n > 0").select("*", row), classes.select(F.xxhash64("rep", "key").alias("row")), "row").drop("row")
    lists = signatures(unique, boundary(unique))
    same = Window.partitionBy("sig")
    shared = written(lists.withColumns({"pivot": F.min("cid").over(same), "top": F.max("cid").over(same)}).where("pivot <> top").drop("top"))
    wanted = written(shared.select("cid").distinct())
    sketches = written(restrict(unique.select("cid", "n", "bits"), wanted, "cid"))

    # pivot rounds; lists of one component are closed for good
    done, groups, left = None, None, shared.withColumn("group", F.col("cid"))
    for k in range(PIVOT_ROUNDS):
        if k:
            drawn = F.min_by(F.struct("cid", "group"), F.xxhash64("cid", "sig", F.lit(k))).over(same)
            left = left.withColumn("drawn", drawn).select("sig", "cid", "n", "lead", "group", F.col("drawn.cid").alias("pivot"), F.col("drawn.group").alias("pivot_group"))
            best = left.where("group <> pivot_group").select("cid", "pivot").distinct()
        else:
            best = left.where("cid <> pivot").groupBy("cid", "pivot").count().groupBy("cid").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("pivot"))
        pairs = best.select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b")).distinct()
        pairs = pairs if done is None else pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
        found = verify(promising(pairs, sketches), docs, classes)
        done = found if done is None else done.unionByName(found)
        if k and found.where("linked").isEmpty():
            break
        links = found.where("linked").select("a", "b")
        groups = components(links if groups is None else _and(groups, links))
        left = written(_open(left, groups))
    more = verify(promising(_rest(left).join(done.select("a", "b"), ["a", "b"], "left_anti"), sketches), docs, classes)
    groups = components(_and(groups, more.where("linked").select("a", "b")))

    of_class = classes.join(groups.withColumnRenamed("node", "cid"), "cid", "left").withColumn("group", F.coalesce("component", "cid"))
    least = of_class.groupBy("group").agg(F.min("rep").alias("component_id"))  # null where no row has an id
    named = of_class.join(least, "group").select("key", F.col("rep").alias("class_id"), "component_id")
    out = sets.select("doc_id", F.col("n").alias("n_shingles"), "key").join(named, "key", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"))


@tidied
def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, docs in text_chunks(b, "text"):
            sets = shingle_sets(docs)
            cid = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=16).digest()[:8], "little", signed=True) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), b.column("text").slice(i, len(docs))], ["cid", "text"])


def _and(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what groups and links do."""
    return groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)


def _open(left: DataFrame, groups: DataFrame) -> DataFrame:
    """List entries of lists whose members are in different components so far."""
    g = groups.select(F.col("node").alias("cid"), F.col("component"))
    few = g.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    g = left.join(F.broadcast(g) if few else g, "cid", "left").select("sig", "cid", "n", "lead", F.coalesce("component", "cid").alias("group"))
    same = Window.partitionBy("sig")
    return g.withColumns({"lo": F.min("group").over(same), "hi": F.max("group").over(same)}).where("lo <> hi").drop("lo", "hi")


def _rest(left: DataFrame) -> DataFrame:
    """Pairs (a, b) of a list that are in different components and of sizes that allow a link.

    Lists are joined by classes of sizes, each a quarter wide: of a linked pair the smaller set, which has the token in its shorter
    prefix, is in the larger one's class or the next below."""
    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT)))
    x = left.where("lead").select("sig", F.col("cid").alias("a"), F.col("n").alias("na"), F.col("group").alias("ga"), F.explode(F.array(size, size + 1)).alias("class"))
    y = left.select("sig", F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("lead").alias("lb"), F.col("group").alias("gb"), size.alias("class"))
    larger = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & F.col("lb") & (F.col("a") < F.col("b")))
    rest = x.join(y, ["sig", "class"]).where(larger & (F.col("ga") != F.col("gb")) & (F.col("na") * 100 >= F.col("nb") * PERCENT))
    return rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, with all columns, without those whose component has a smaller doc_id; rows that repeat a doc_id stay together, and rows without one stay."""
    linked = link(docs, id_col, text_col)
    gone = linked.groupBy("doc_id").agg(F.min("component_id").alias("least")).where("least < doc_id").select(F.col("doc_id").alias(id_col))
    return restrict(docs, written(gone), id_col, "left_anti")


def query(docs: DataFrame) -> DataFrame:
    return link(docs)
