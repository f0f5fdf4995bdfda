"""Operator 9, packing: concatenate and cut, with offsets from two-pass prefix sums over partition token totals.

Pass one tokenizes each document once, appends id 0, and writes the ids with the number of ids that stand before the
document in its partition. The written partitions' totals (one row each) are summed up in order; a partition's base plus
the number before the document is its global offset. Pass two cuts [offset, offset + ids) at multiples of the window.
What was written fixes partitions and order, so a lost executor changes nothing. Only the last window is padded.

Defined results: null and empty texts are the closing id alone; repeated rows are packed as often as they come, with
equal doc_id; null doc_id stays null; other columns are kept out; empty tables give no piece.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varspan.llm.common import tidied, with_columns_of, written

WINDOW, CLOSING_ID = 1024, 0
#: Bytes of text that one step encodes, and the characters of strings whose ids a Python worker keeps before it starts afresh.
STEP, KEPT = 1 << 21, 1 << 20
#: Missing words that are encoded as one string.
JOINED = 500
#: Pieces that have neither white space nor separators at an end, and those of Latin letters alone with stops after them.
_PLAIN = r"(?s)^[^\s\pZ\pC](.*[^\s\pZ\pC])?$"
_LETTERS = r"^(?P<word>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+)(?P<stops>[.,;:!?]+)$"
#: Before such a space no token spans: a word takes the one space before it along.
_CUT = re.compile(r"(?<=[!-~]) (?=[!-~])")

TOKENS = "part int, before long, doc_id long, doc_tokens long, ids binary"


class Encoder:
    """Ids of a byte-level BPE of the tokenizers library.

    A text is split at spaces. Where a single space stands between characters that aren't white space, a token begins with it, so
    the word after it has the same ids wherever it stands: each distinct word of a step is looked up once, without the stops after
    it, missing ones are encoded many at a time, and the ids are gathered by arrays. Other runs of pieces are encoded as they
    stand."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task for each core
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # ids of tokens that begin with a space
        self.opens[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.start, self.size, self.held = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def _plain(self, pieces: pa.Array) -> np.ndarray:
        """Which pieces are neither empty, nor have white space at an end, nor a special token inside."""
        ok = pc.match_substring_regex(pieces, _PLAIN)
        for t in self.special:
            ok = pc.and_not(ok, pc.match_substring(pieces, t))
        return ok.to_numpy(zero_copy_only=False)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, strings: list[str], words: bool) -> None:
        """Adds the ids of new strings; words are plain pieces with the space before them."""
        for i in range(0, len(strings), 20 * JOINED):
            new = strings[i : i + 20 * JOINED]  # a bounded number of tokens at a time
            got = self._encode(["".join(new[k : k + JOINED]) for k in range(0, len(new), JOINED)] if words else new)
            ids = np.fromiter(chain.from_iterable(got), np.uint32)
            size = np.diff(np.append(np.flatnonzero(self.opens[ids]), len(ids))) if words else np.array([len(g) for g in got], np.int64)
            assert len(size) == len(new), "a word without a token of its own"
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
            self.size, self.ids = np.concatenate([self.size, size]), np.concatenate([self.ids, ids])
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            self.held += sum(map(len, new))

    def _numbers(self, strings: list[str], words: bool) -> np.ndarray:
        if new := [x for x in dict.fromkeys(strings) if x not in self.number]:
            self._learn(new, words)
        return np.fromiter(map(self.number.__getitem__, strings), np.int64, len(strings))

    def _pick(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered strings, one after the other, and how many each has."""
        n = self.size[number]
        end = np.cumsum(n)
        return self.ids[np.repeat(self.start[number] - end + n, n) + np.arange(end[-1] if len(n) else 0)], n

    def _words(self, pieces: pa.Array) -> np.ndarray:
        """Numbers of plain pieces with the space before them, each in two parts: the word and the stops after it."""
        parts, of = pc.extract_regex(pieces, _LETTERS), lambda x: x.to_numpy(zero_copy_only=False).tolist()
        cut = parts.is_valid()
        word = pc.if_else(cut, pc.struct_field(parts, [0]), pieces)
        stops = pc.if_else(cut, pc.struct_field(parts, [1]), "")
        return np.stack([self._numbers(of(pc.binary_join_element_wise("", word, " ")), True), self._numbers(of(stops), False)], axis=1)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        if self.held > KEPT:
            self._forget()
        split = pc.split_pattern(texts, " ")
        first = split.offsets.to_numpy()[:-1].astype(np.int64) - split.offsets[0].as_py()
        flat = split.flatten()
        coded = flat.dictionary_encode()
        at, pieces = coded.indices.to_numpy(), coded.dictionary
        plain = self._plain(pieces)[at]
        begins, heads = np.ones(len(at), bool), np.zeros(len(at), bool)
        begins[1:] = plain[1:] & plain[:-1]
        begins[first] = heads[first] = True
        units = np.flatnonzero(begins)
        ends = np.append(units[1:], len(at))
        word = ~heads[units] & (ends - units == 1)
        size = ends - units
        loose = flat.filter(pa.array(np.repeat(~word, size))).to_numpy(zero_copy_only=False).tolist()
        last = np.cumsum(size[~word])
        runs = zip((last - size[~word]).tolist(), last.tolist(), heads[units[~word]].tolist(), strict=True)
        other = self._numbers([("" if head else " ") + " ".join(loose[a:z]) for a, z, head in runs], False)
        known = np.zeros(len(pieces), bool)
        known[at[units[word]]] = True
        wanted = np.flatnonzero(known)
        ids, n = self._pick(np.concatenate([self._words(pieces.take(pa.array(wanted))).ravel(), other]))
        size = np.concatenate([n[: 2 * len(wanted)].reshape(-1, 2).sum(axis=1), n[2 * len(wanted) :]])
        start = np.cumsum(size) - size  # of each wanted piece, then of each other unit, in ids
        row = np.empty(len(units), np.int64)
        row[word] = (np.cumsum(known) - 1)[at[units[word]]]
        row[~word] = len(wanted) + np.arange(len(other))
        n = size[row]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = ids[np.repeat(start[row] - total[:-1], n) + np.arange(total[-1])]
        return ids, np.diff(total[np.append(np.searchsorted(units, first), len(units))])


def _segments(text: str) -> Iterator[str]:
    """A very long text, cut where no token spans."""
    i = 0
    while len(text) - i > STEP and (m := _CUT.search(text, i + STEP)):
        yield text[i : m.start()]
        i = m.start()
    yield text[i:]


def encoded(texts: pa.Array, encode: Encoder) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids of some rows with the closing id after each, number of each row's ids)."""
    size, i = pc.fill_null(pc.binary_length(texts), 0).to_numpy(), 0
    while i < len(size):
        n = max(1, int(np.searchsorted(np.cumsum(size[i : i + 4096]), STEP, "right")))
        rows = pc.fill_null(texts.slice(i, n), "")
        if size[i] > STEP:
            ids = np.concatenate([encode(pa.array([x], pa.string()))[0] for x in _segments(rows[0].as_py())])
            count = np.array([len(ids)])
        else:
            ids, count = encode(rows)
        yield i, np.insert(ids, np.cumsum(count), CLOSING_ID), count + 1
        i += n


_encoders: dict[str, Encoder] = {}


def _tokenize(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, Encoder(tokenizer))
        part, before = TaskContext.get().partitionId(), 0
        for b in batches:
            for i, ids, n in encoded(b.column("text"), encode):
                end = np.cumsum(n)
                lists = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(0, 4 * end).astype("<i4")), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), part, np.int32)), pa.array(before + end - n), b.column("doc_id").slice(i, len(n)), pa.array(n), lists], ["part", "before", "doc_id", "doc_tokens", "ids"])
                before += int(end[-1])

    return tidied(run)


def tokenize(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pass one, written: each document's ids and the number of ids before it in its partition."""
    return written(with_columns_of(docs, doc_id=id_col, text=text_col).mapInArrow(_tokenize(tokenizer), TOKENS))


def pack(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pass two: pieces of the windows with their ids; boundary records say where documents start and end in a window."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    base = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    at = tokens.join(F.broadcast(base), "part").withColumn("offset", F.col("base") + F.col("before"))  # one row for each partition
    w, end = F.lit(window), F.col("offset") + F.col("doc_tokens")

    def piece(seq):
        lo, hi = F.greatest(seq * w, F.col("offset")), F.least((seq + 1) * w, end)
        start, n = lo - F.col("offset"), hi - lo
        return F.struct(
            start.alias("start"), n.alias("length"), F.substring("ids", (start * 4 + 1).cast("int"), (n * 4).cast("int")).alias("ids"),
            seq.alias("sequence_id"), (lo - seq * w).alias("offset"), (start == 0).alias("starts_document"), (hi == end).alias("ends_document"),
        )

    pieces = F.transform(F.sequence(F.floor(F.col("offset") / w), F.floor((end - 1) / w)), piece)
    return at.select("doc_id", "doc_tokens", F.inline(pieces))


def query(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    p = pack(tokenize(docs, tokenizer))
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "starts_document", "ends_document")
