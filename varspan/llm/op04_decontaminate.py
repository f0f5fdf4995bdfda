"""Operator 4, benchmark decontamination: suffix arrays of the training words, searched for every test suffix.

A shard is a run of documents of bounded size inside a Spark task. Its suffix array holds the word positions whose first
words (up to four) begin some benchmark suffix, sorted by their next ten words; all other positions can't match. Every
suffix of every benchmark item is binary-searched in it. A match of a whole window (ten words, or the item's words where it
has fewer) is a hit; consecutive hits on one diagonal join to the longest verbatim match, kept with its place.
Benchmark items go to the tasks in blocks of bounded size: one block at a time is held and broadcast, and read with one pass over
the documents. Of several blocks each pass writes what it found by the texts' digests, and these are joined at the end.

Defined results: null and empty texts have no words and no hits; null benchmark texts are no items; a null item id is the
empty string; repeated rows give repeated rows; repeated item ids count once; a window that an item holds several times
counts by its first place; other columns are kept out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varspan.llm.common import ALNUM, Words, mix, restrict, text_chunks, tidied, with_columns_of, written

WINDOW, HEAD, BITS = 10, 4, 22
#: Bytes of benchmark text in one block.
BLOCK_BYTES = 16 << 20

SPAN = "struct<start:long,length:long,item_id:string,item_start:long>"
HITS = f"doc_id long, text string, n_words long, spans array<{SPAN}>"


def _heads(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words from each position."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        out = mix(out + h[k : k + len(out)])
    return out


def _rows(m: np.ndarray) -> np.ndarray:
    """Rows of words as one big-endian key each, so that sorting is by word after word."""
    return np.ascontiguousarray(m.astype(">u8")).view(f"S{8 * m.shape[1]}").ravel() if len(m) else np.zeros(0, f"S{8 * m.shape[1]}")


class Tests:
    """The suffixes of a block of benchmark items: their windows, by window length."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        w = Words([t for _, t in items], ALNUM)
        self.ids, self.by_length = [i for i, _ in items], {}
        for k, (a, b) in enumerate(zip(w.first, w.last, strict=True)):
            if n := min(window, int(b - a)):
                keys, items_, starts = self.by_length.setdefault(n, ([], [], []))
                own = np.lib.stride_tricks.sliding_window_view(w.hash[a:b], n)
                first = np.sort(np.unique(_rows(own), return_index=True)[1])  # else equal words in both multiply
                keys.append(own[first])
                items_.append(np.full(len(first), k))
                starts.append(first)
        for n, (keys, items_, starts) in self.by_length.items():
            keys = np.concatenate(keys)
            head, bits = min(HEAD, n), np.zeros(1 << BITS, bool)
            bits[(_heads_of(keys, head) >> np.uint64(64 - BITS)).astype(np.int64)] = True
            self.by_length[n] = (keys, np.concatenate(items_), np.concatenate(starts), head, bits)


def _heads_of(keys: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(len(keys), np.uint64)
    for k in range(n):
        out = mix(out + keys[:, k])
    return out


def search(w: Words, tests: Tests) -> list[list[dict]]:
    """For each document the maximal verbatim matches with the items."""
    found: list[list[dict]] = [[] for _ in w.first]
    for n, (keys, items, starts, head, bits) in tests.by_length.items():
        if len(w.hash) < n:
            continue
        h = _heads(w.hash, head)[: len(w.hash) - n + 1]
        at = np.flatnonzero(bits[(h >> np.uint64(64 - BITS)).astype(np.int64)])
        doc = np.searchsorted(w.last, at, "right")  # the document that a position's word is in
        ok = at + n <= w.last[doc]
        at, doc = at[ok], doc[ok]
        if not len(at):
            continue
        suffixes = _rows(np.stack([w.hash[at + k] for k in range(n)], axis=1))
        order = np.argsort(suffixes, kind="stable")
        array, wanted = suffixes[order], _rows(keys)
        lo, hi = np.searchsorted(array, wanted, "left"), np.searchsorted(array, wanted, "right")
        test = np.repeat(np.arange(len(wanted)), hi - lo)
        place = order[np.concatenate([np.arange(a, b) for a, b in zip(lo, hi, strict=True) if b > a])] if len(test) else np.zeros(0, np.int64)
        pos, d = at[place] - w.first[doc[place]], doc[place]
        item, start = items[test], starts[test]
        line = np.lexsort((pos, pos - start, item, d))
        d, item, pos, start = d[line], item[line], pos[line], start[line]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (item[1:] != item[:-1]) | (pos[1:] - start[1:] != pos[:-1] - start[:-1]) | (pos[1:] != pos[:-1] + 1)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(d)))
        for f, m in zip(first.tolist(), size.tolist(), strict=True):
            found[d[f]].append({"start": int(pos[f]), "length": m + n - 1, "item_id": tests.ids[item[f]], "item_start": int(start[f])})
    return found


def _search(tests, whole: bool):
    """tests: a broadcast block. Rows with their matches; unless whole, only those with some, by the text's digest."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("item_id", pa.string()), ("item_start", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, docs in text_chunks(b, "text"):
                w, part = Words(docs, ALNUM), b.slice(i, len(docs))
                spans = search(w, tests.value)
                if whole:
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), pa.array(w.last - w.first, pa.int64()), pa.array(spans, kind)], ["doc_id", "text", "n_words", "spans"])
                else:
                    hit = [k for k, x in enumerate(spans) if x]
                    yield pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(docs[k]).digest() for k in hit], pa.binary()), pa.array([spans[k] for k in hit], kind)], ["digest", "spans"])

    return tidied(run)


def blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str, bytes]]]:
    """Items with text, each id and text once, a block of bounded size at a time."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).alias("t")).where("t is not null").distinct()
    block, size = [], 0
    for r in rows.toLocalIterator():
        block.append((r.i, r.t.encode()))
        size += len(block[-1][1])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _passes(docs: DataFrame, benchmark: DataFrame, window: int, item_col: str, item_text_col: str) -> tuple[object, DataFrame | None]:
    """The only block, broadcast, and None; or of several blocks the matches (digest, spans) of each pass, written."""
    every, spark, found, last = blocks(benchmark, item_col, item_text_col), docs.sparkSession, None, None
    for block in every:
        if last is not None:
            hits = written(docs.mapInArrow(_search(last, False), f"digest binary, spans array<{SPAN}>"))
            found = hits if found is None else found.unionByName(hits)
            last.destroy()
        last = spark.sparkContext.broadcast(Tests(block, window))
    if found is None:
        return last or spark.sparkContext.broadcast(Tests([], window)), None
    hits = written(docs.mapInArrow(_search(last, False), f"digest binary, spans array<{SPAN}>"))
    # equal texts have equal matches: of each block one row a text
    return None, found.unionByName(hits).distinct().groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, text, n_words and all maximal verbatim matches (start and length in words, item and place in it)."""
    docs = with_columns_of(docs, doc_id=id_col, text=text_col)
    only, found = _passes(docs, benchmark, window, item_col, item_text_col)
    if found is None:
        return docs.mapInArrow(_search(only, True), HITS)
    rows = docs.mapInArrow(_search(docs.sparkSession.sparkContext.broadcast(Tests([], window)), True), HITS).drop("spans")
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))).join(found, "digest", "left")
    return rows.select("doc_id", "text", "n_words", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def _clean(tests, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, docs in text_chunks(b, text_col):
                hit = search(Words(docs, ALNUM), tests.value)
                yield b.slice(i, len(docs)).filter(pa.array([not x for x in hit], pa.bool_()))

    return tidied(run)


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs, with all columns, without the rows that hold a window of an item."""
    only, found = _passes(docs.select(F.col(text_col).alias("text")), benchmark, window, item_col, item_text_col)
    if found is None:
        return docs.mapInArrow(_clean(only, text_col), docs.schema)
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    rows = docs.select(F.struct("*").alias("doc"), digest.alias("digest"))
    return restrict(rows, found.select("digest"), "digest", "left_anti").select("doc.*")


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = {k: [] for k in ("n_hit", "n_items", "items_sha256", "longest_match")}
        for spans in b.column("spans").to_pylist():
            end = hit = 0
            for s, n in sorted((x["start"], x["length"]) for x in spans):
                hit += max(0, s + n - max(s, end))
                end = max(end, s + n)
            items = sorted({x["item_id"] for x in spans})
            for k, v in (("n_hit", hit), ("n_items", len(items)), ("items_sha256", hashlib.sha256(",".join(items).encode()).hexdigest()), ("longest_match", max((x["length"] for x in spans), default=0))):
                rows[k].append(v)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_words"), *[pa.array(v, pa.string() if k == "items_sha256" else pa.int64()) for k, v in rows.items()]], ["doc_id", "n_words", *rows])


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find(docs, benchmark).drop("text").mapInArrow(_summary, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, longest_match long")
    return found.withColumn("contaminated", F.col("n_hit") > 0)
