r"""Operator 2, suffix-array dedup: bytes covered by a 100-byte string that also starts earlier are removed.

Bucket-pointer refinement finds equal 100-byte prefixes of suffixes without moving suffixes. A bucket's identifier is a 64-bit
hash; the identifier of 2k bytes at i is made from those of k bytes at i and at i + k, and each step reuses the one before:
32-byte grams give the initial buckets, 64 and 100 bytes the refined ones.

1. Whole documents that are exact copies of an earlier one are told by a grouped minimum and go no further.
2. Of the 69 grams in each 100-byte window the one with the least identifier is the window's bucket (equal windows choose
   alike). Consecutive windows with one choice are a run. Buckets that come once hold no repeat and aren't refined.
3. In each bucket, runs of equal text are compared: all but the first are repeats whole. First runs in buckets with different
   texts are refined recursively: into groups of 12 neighbouring windows, whose bucket is the text that all 12 have in
   common, and these into single windows with their 100-byte identifiers.

Each level reads the documents again and derives its rows anew (no text is shuffled); a bounded bit table of the buckets or
rows that the level before left open tells which, and where that would be too large a join does.
All comparing is by grouped minima, with map-side combining, and joins of rows with their minima; those of texts with very many
rows are broadcast, so a passage that a third of the documents share is no single group and no single key. Equal identifiers are taken for equal texts (64 bits within a 64-bit bucket).

Defined results: null and empty texts have 0 bytes and the digest of nothing; rows that repeat a doc_id with the same text are
one document and don't make each other repeated; those with different texts are documents of their own, in the order of
their keys (64-bit digests of the text); rows without doc_id stand before all others, in the order of their keys, each a
document of its own, and of those with one text one alone is kept; other columns are kept out; a very long text is worked
through in segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varspan.llm.common import _BYTE, BROADCAST_IDS, mix, powers, restrict, span_hash, text_chunks, utf8, written

LENGTH, GRAM = 100, 32
#: Bytes that one step works on, so that its arrays stay in the processor's cache.
STEP = 1 << 17
#: Neighbouring windows in a group.
GROUP = 12
#: Texts with more rows than one in HOT_TEXTS of all, and than a few, are told to all rows; there are no more than HOT_TEXTS.
HOT_ROWS, HOT_TEXTS = 10, 10_000
#: Bits of a filter for each key, and at most; beyond, keys are joined.
FILTER_X, FILTER_BITS = 32, 1 << 29
_M = mix(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)
_LOW = np.uint64(0xFFFFFF)
RUNS = "bucket long, text long, i long, k long, at long, again boolean, key long"
#: The `i` of rows without doc_id; their `k` is below 0, that of rows with a repeated doc_id above, and of all others 0.
LEAST = -(1 << 63)


def grams(buf: np.ndarray) -> dict[int, np.ndarray]:
    """Bucket identifiers of 4 and 32 bytes from each position, by doubling."""
    ids, out = _BYTE[buf], {}
    for k in range(5):
        step = 1 << k
        ids = ids[:-step] * _M[k] + ids[step:] if len(ids) > step else ids[:0]
        if step in (2, 16):
            out[2 * step] = ids
    return out


def whole_windows(buf: np.ndarray) -> np.ndarray:
    """Bucket identifiers of LENGTH bytes from each position: 32 and 32, then 32, then 4."""
    g, n = grams(buf), len(buf) - LENGTH + 1
    x = (g[32][:n] * _M[5] + g[32][32 : 32 + n]) * _M[6] + g[32][64 : 64 + n]
    return mix(x * _M[7] + g[4][96 : 96 + n])


def _breaks(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1]) if len(columns[0]) else np.zeros(0, np.int64)


class Segment:
    """Runs of windows in a buffer of documents that end at `ends`: start, size, bucket and the place of the chosen gram."""

    def __init__(self, buf: np.ndarray, ends: np.ndarray):
        self.buf, n = buf, len(buf) - LENGTH + 1
        self.start = self.size = self.place = np.zeros(0, np.int64)
        self.bucket = np.zeros(0, np.uint64)
        self._sums = None
        if n <= 0:
            return
        score = mix(grams(buf)[GRAM])
        m = (score & ~_LOW) | np.arange(len(score), dtype=np.uint64)
        for step in (1, 2, 4, 8, 16, 32, LENGTH - GRAM + 1 - 64):
            m = np.minimum(m[:-step], m[step:])
        valid = np.ones(n, bool)
        across = (ends[:-1, None] - np.arange(1, LENGTH)).ravel()
        valid[across[(across >= 0) & (across < n)]] = False
        at = np.flatnonzero(valid)
        choice = (m[at] & _LOW).astype(np.int64)
        first = _breaks(choice, at - np.arange(len(at)))
        self.start, self.place, self.size = at[first], choice[first], np.diff(np.append(first, len(at)))
        self.bucket = mix(score[self.place])  # chosen gram identifiers are small ones: spread them again

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self._sums is None:
            up, _ = powers(len(self.buf))
            self._sums = np.zeros(len(self.buf) + 1, np.uint64)
            np.cumsum(_BYTE[self.buf] * up, out=self._sums[1:])
        return span_hash(self._sums, start, end)

    def text(self) -> np.ndarray:
        return self.hash(self.start, self.start + self.size + LENGTH - 1)

    def pick(self, ok: np.ndarray) -> None:
        self.start, self.size, self.place, self.bucket = self.start[ok], self.size[ok], self.place[ok], self.bucket[ok]

    def once(self, doc: np.ndarray) -> None:
        """Of rows that a document repeats, the first alone: the others are repeats, whatever is in them."""
        order = np.lexsort((self.start, t := self.text(), self.bucket, doc))
        self.pick(np.sort(order[_breaks(doc[order], self.bucket[order], t[order])]))

    def _spread(self) -> tuple[np.ndarray, np.ndarray]:
        run = np.repeat(np.arange(len(self.size)), self.size)
        return run, np.repeat(self.start - np.cumsum(self.size) + self.size, self.size) + np.arange(self.size.sum())

    def to_groups(self, key: np.ndarray) -> np.ndarray:
        """Runs to groups of GROUP neighbouring windows, placed by the chosen gram; a group's bucket is the text that all have in common.
        Returns the key of each group's run."""
        run, pos = self._spread()
        block = (self.place[run] - pos) // GROUP
        first = _breaks(run, block)
        place, block = self.place[run[first]], block[first]
        self.start, self.size, self.place = pos[first], np.diff(np.append(first, len(pos))), place
        last = place - GROUP * block  # the last window's start in a full group
        self.bucket = mix(self.hash(last, last - GROUP + 1 + LENGTH) + block.astype(np.uint64) * _M[0])
        return key[run[first]]

    def to_windows(self) -> np.ndarray:
        """Groups to single windows; returns their identifiers."""
        run, pos = self._spread()
        self.start, self.size, self.place, self.bucket = pos, np.ones(len(pos), np.int64), self.place[run], self.bucket[run]
        return whole_windows(self.buf)[pos] if len(pos) else np.zeros(0, np.uint64)


def segments(docs: list[bytes]) -> Iterator[tuple[Segment, np.ndarray, int]]:
    """Segments of several documents, or of one long one, with the documents' starts and what to add to a start."""
    buf, ends = np.frombuffer(b"".join(docs), np.uint8), np.cumsum([len(d) for d in docs])
    if len(docs) == 1:
        for s in range(0, max(1, len(buf) - LENGTH + 1), STEP):
            yield Segment(buf[s : s + STEP + LENGTH - 1], ends[:1]), ends, s
    else:
        yield Segment(buf, ends), ends, 0


def _key(bucket: np.ndarray, text: np.ndarray, i: np.ndarray) -> np.ndarray:
    x = i.view(np.uint64)
    return bucket ^ (text >> np.uint64(1)) ^ (x << np.uint64(41)) ^ (x << np.uint64(29))


def _held(bits, key: np.ndarray) -> np.ndarray:
    word = bits.value
    x = key >> np.uint64(64 - (len(word) * 64).bit_length() + 1)
    return (word[(x >> np.uint64(6)).astype(np.int64)] >> (x & np.uint64(63)) & np.uint64(1)).astype(bool)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for _, docs in text_chunks(b, "text", STEP):
            for s, _, _ in segments(docs):
                yield pa.RecordBatch.from_arrays([pa.array(s.bucket.view(np.int64))], ["bucket"])


def _rows(tables: list):
    """Rows of a level: runs whose bucket is in the first table; of the runs in the second the groups; of the groups in the third the windows.
    Where a table is None all pass, and `key` is for a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, row_key = b.column("i").to_numpy(), b.column("k").to_numpy()
            for k, docs in text_chunks(b, "text", STEP):
                parts = []
                for s, ends, shift in segments(docs):
                    of = lambda at: np.searchsorted(ends, at + shift, "right")  # noqa: E731, B023
                    key = s.bucket
                    if tables[0] is not None:
                        s.pick(_held(tables[0], key))
                        key = s.bucket
                    if len(tables) > 1 and len(s.start):
                        key = _key(s.bucket, s.text(), ids[k + of(s.start)])
                        if tables[1] is not None:
                            s.pick(_held(tables[1], key))
                        s.once(of(s.start))
                        key = s.to_groups(_key(s.bucket, s.text(), ids[k + of(s.start)]))
                    if len(tables) > 2 and len(s.start):
                        if tables[2] is not None:
                            s.pick(_held(tables[2], _key(s.bucket, s.text(), ids[k + of(s.start)])))
                        s.once(of(s.start))
                        key = np.repeat(_key(s.bucket, s.text(), ids[k + of(s.start)]), s.size)
                        text = s.to_windows()
                    else:
                        text = s.text() if len(s.start) else np.zeros(0, np.uint64)
                    doc = of(s.start)
                    start = s.start + shift - np.concatenate([[0], ends])[doc]
                    key = key if len(key) == len(start) else np.zeros(len(start), np.uint64)
                    parts.append((s.bucket, text, doc, start * 128 + s.size, key))
                bucket, text, doc, at, key = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.lexsort((at, text, bucket, doc))
                again = np.ones(len(doc), bool)
                again[order[_breaks(doc[order], bucket[order], text[order])]] = False
                yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(text.view(np.int64)), pa.array(ids[k + doc]), pa.array(row_key[k + doc]), pa.array(at), pa.array(again), pa.array(key.view(np.int64))], ["bucket", "text", "i", "k", "at", "again", "key"])

    return run


def bit_table(keys: DataFrame):
    """A broadcast bit table of the keys, or None where it would be too large. It lets a few others pass, which do no harm."""
    n = keys.count()
    k = max(12, (max(1, n) * FILTER_X - 1).bit_length())
    if 1 << k > FILTER_BITS:
        return None
    x = F.shiftrightunsigned("key", 64 - k)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - k}) & 63 as int))")
    got = keys.groupBy(F.shiftright(x, 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << (k - 6), np.uint64)
    table[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(table)


def spans_of(at: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows of some runs, within n bytes."""
    at = np.sort(at)
    out: list[tuple[int, int]] = []
    for a in at.tolist():
        lo, hi = a >> 7, min((a >> 7) + (a & 127) - 1 + LENGTH, n)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        elif lo < hi:
            out.append((lo, hi))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        for i in range(0, b.num_rows, 512):
            part = b.slice(i, 512)
            rows: tuple[list, ...] = ([], [], [])
            for text, at, whole in zip(utf8(part, "text"), part.column("at").to_pylist(), part.column("whole").to_pylist(), strict=True):
                n = len(text)
                spans = [(0, n)] if whole and n >= LENGTH else spans_of(np.array(at or [], np.int64), n)
                cuts = [0, *(x for s in spans for x in s), n]
                rows[0].append(n)
                rows[1].append([{"start": a, "end": z} for a, z in spans])
                rows[2].append(b"".join(text[a:z] for a, z in zip(cuts[::2], cuts[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows[0], pa.int64()), pa.array(rows[1], kind), pa.array(rows[2], pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


def hot_texts(first: DataFrame) -> DataFrame:
    """Texts that have more than a share of all rows: a group in proportion to the input is hot at every size of it."""
    total = first.agg(F.sum("n")).first()[0] or 0
    return first.where(F.col("n") > max(HOT_ROWS, total // HOT_TEXTS))


def _level(docs: DataFrame, tables: list, keys: DataFrame, keyed: bool) -> tuple[DataFrame, DataFrame]:
    """One refinement: (i, k, at) of the rows that repeat an earlier one of their bucket, and the keys of first rows in buckets with
    different texts. All sides grow with the input, so none is ever broadcast, however small the input."""
    rows = docs.mapInArrow(_rows(tables), RUNS)
    rows = written((rows if tables[-1] is not None else rows.join(keys, "key", "left_semi")).drop("key"))
    first = written(rows.groupBy("bucket", "text").agg(F.min("i").alias("first"), F.count("*").alias("n")))
    # texts of very many rows are few, by the bound: they go to the rows, and no key of the shuffled join is hot
    hot = F.broadcast(hot_texts(first).drop("n"))
    often, others = rows.join(hot, ["bucket", "text"]), rows.join(hot, ["bucket", "text"], "left_anti")
    others = others.join(first.where("n > 1").drop("n").hint("merge"), ["bucket", "text"])
    found = often.unionByName(others).where(F.col("again") | (F.col("i") > F.col("first"))).select("i", "k", "at")
    if keyed:  # rows of one doc_id that have different texts: the one of least key stands first
        same = rows.where("k <> 0")
        least = same.groupBy("bucket", "text", "i").agg(F.min("k").alias("least"), F.max("k").alias("most")).where("least < most").drop("most")
        found = found.unionByName(same.join(least.hint("merge"), ["bucket", "text", "i"]).where("k > least").select("i", "k", "at"))
    mixed = first.groupBy("bucket").agg(F.count("*").alias("texts")).where("texts > 1").select("bucket")
    key = F.col("bucket").bitwiseXOR(F.shiftrightunsigned("text", 1)).bitwiseXOR(F.shiftleft("first", 41)).bitwiseXOR(F.shiftleft("first", 29))
    return found, first.join(mixed.hint("merge"), "bucket", "left_semi").select(key.alias("key"))


def repeats(docs: DataFrame, keyed: bool = True) -> DataFrame:
    """(i, k, at) of all runs of windows that also start earlier: at is 128 * start + number of windows. docs has i, k and text;
    keyed tells whether a k may be other than 0."""
    keys = written(docs.mapInArrow(_buckets, "bucket long").groupBy("bucket").count().where("count > 1").select(F.col("bucket").alias("key")))
    tables, out = [], None
    for last in (False, False, True):
        tables.append(bit_table(keys))
        found, keys = _level(docs, tables, keys, keyed)
        out = found if out is None else out.unionByName(found)
        if not last:
            keys = written(keys)
    return out


def with_keys(docs: DataFrame) -> tuple[DataFrame, bool, bool]:
    """docs with the key `k` of each row, whether any is other than 0, and whether there are rows without doc_id.

    Only doc_ids that come with different texts need keys, so that k costs nothing elsewhere; where they are too many to be
    sent to all executors, every row has one."""
    digest = F.xxhash64("text").bitwiseAND(F.lit((1 << 63) - 1))
    own = F.greatest(F.lit(1).cast("long"), digest)
    ids = docs.select("i", digest.alias("d"), F.col("doc_id").isNull().alias("no_id"))
    clash = written(ids.groupBy("i").agg(F.min("d").alias("a"), F.max("d").alias("z"), F.max("no_id").alias("no_id")).where(f"no_id or a < z or i = {LEAST}").select("i", "no_id"))
    nulls = clash.where("no_id").count() > 0
    clash = clash.select("i", F.lit(True).alias("clash"))
    few = clash.limit(BROADCAST_IDS + 1).count()
    if few == 0:
        return docs.withColumn("k", F.lit(0).cast("long")), False, False
    if few <= BROADCAST_IDS:
        own = F.when(F.col("clash"), own).otherwise(F.lit(0).cast("long"))
        docs = docs.join(F.broadcast(clash), "i", "left")
    k = F.when(F.col("doc_id").isNull(), F.xxhash64("text").bitwiseOR(F.lit(LEAST))).otherwise(own)
    return docs.select("doc_id", "i", k.alias("k"), "text"), True, nulls


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, the removed spans (byte offsets) and the bytes that are left."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs, keyed, nulls = with_keys(docs)
    named = written(docs.select("i", "k", F.md5("text").alias("key"), F.octet_length("text").alias("n")))
    originals = named.groupBy("key", "n").agg(F.min("i").alias("first"))
    copies = named.join(originals, ["key", "n"]).where("i > first").select("i", "k")
    copies = written(copies.distinct())  # equal texts under one doc_id have one key
    found = repeats(restrict(docs.select("i", "k", "text"), copies, ["i", "k"], "left_anti").where(F.octet_length("text") >= LENGTH), keyed)
    spans = written(found.groupBy("i", "k").agg(F.collect_set("at").alias("at")))  # as many as the text is long
    marks = spans.withColumn("whole", F.lit(False)).unionByName(copies.select("i", "k", F.array().cast("array<long>").alias("at"), F.lit(True).alias("whole")))
    marks = marks.groupBy("i", "k").agg(F.flatten(F.collect_list("at")).alias("at"), F.max("whole").alias("whole"))  # two rows at most
    # the marks grow with the input, so both sides are shuffled, however small the input
    joined = (docs.where("doc_id is not null") if nulls else docs).join(marks.hint("merge"), ["i", "k"], "left").select("doc_id", "text", "at", "whole")
    if nulls:
        # numbered once, in a written table: of rows without doc_id that have one text the first stands, the others are copies
        rows = written(docs.where("doc_id is null").withColumn("r", F.monotonically_increasing_id()))
        rows = rows.join(rows.groupBy("k").agg(F.min("r").alias("stands")).hint("merge"), "k").join(marks.hint("merge"), ["i", "k"], "left")
        joined = joined.unionByName(rows.select("doc_id", "text", "at", F.when(F.col("r") > F.col("stands"), True).otherwise(F.col("whole")).alias("whole")))
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def query(docs: DataFrame) -> DataFrame:
    c = cut(docs)
    return c.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
