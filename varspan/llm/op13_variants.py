r"""Operator 13, grouping of spelling variants: words one edit apart are found by search schemes over a bidirectional FM-index of the
vocabulary, and rare words get the frequent word near them as their form.

Vocabulary: maximal runs of letters, A-Z lower-cased, counted over all documents; words of LEAST_LENGTH code points and LEAST_COUNT occurrences
at least. Search: two words one edit apart agree in the first half of the query, or in the rest. So a query's first half is matched exactly, from
the delimiter on, and then extended to the right over the other half with one error (scheme one); the same over reversed words is
scheme two. The index of a shard is the suffix order of its words, delimited (`|abc|abd|`), and of the reversed text: an interval
of ranks in the one and its twin in the other are kept in step, so a pattern grows to either side.

At scale: words are ranked by range sort; SHARD ranks are a shard, indexed by one task. Words with one first half have ranks side by side,
so grouped minima and maxima tell the shards that a query needs (mostly one), and words that share their half with none
need no search. Queries of a shard beyond QUERIES go to further copies of it. The search of a query doesn't depend on how many words share its
half, and no pair of words is ever made but the near ones. Roots are found by doubling: counts grow fivefold with each form, so rounds are few.

Defined results: null and empty texts have no runs; a null doc_id is the empty text in the hash; copies and repeated rows count each; runs of any
length are words; without words the result is empty; ties of form go to the first in code-point order; other columns are kept out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varspan.llm.common import ascii_lower, with_columns_of, written
from varspan.sources.text import ranked

RUNS = r"[A-Za-zÀ-ÿ]"
#: One run in so many loses a letter.
SPOILED = 199
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: Words in an index, queries that one index serves.
SHARD, QUERIES = 1 << 15, 1 << 16
#: Rows of an index between two counts of symbols.
STEP = 8


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all documents. Shorter runs can't give a word, so they are never rows."""
    d = with_columns_of(docs, doc_id=id_col, text=text_col)
    runs = d.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(f"{RUNS}{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    runs = runs.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % SPOILED == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling; the text's end counts as less than all."""
    n = len(text)
    rank = text.astype(np.int64)
    k = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - k, 0)] = rank[k:] + 1
        key = rank * (max(int(rank.max()), n) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        if new[order[-1]] == n - 1:
            return order
        rank, k = new, 2 * k


class Ranks:
    """Counts of each symbol before a row of a Burrows-Wheeler column."""

    def __init__(self, text: np.ndarray, order: np.ndarray, symbols: int):
        n = len(text)
        self.column = np.full(-(-(n + 1) // STEP) * STEP + STEP, symbols, np.int64)  # beyond the text: no symbol
        # row 0 is the empty suffix; the row of the whole text is preceded by none
        rows = np.concatenate([[n], order])
        self.column[: n + 1] = np.where(rows > 0, text[rows - 1], symbols)
        per = np.zeros((len(self.column) // STEP + 1, symbols + 1), np.int32)
        np.add.at(per, (np.arange(len(self.column)) // STEP + 1, self.column), 1)
        self.before = np.cumsum(per, axis=0, dtype=np.int32)

    def all(self, row: np.ndarray) -> np.ndarray:
        """For each row the counts of all symbols before it."""
        out = self.before[row // STEP].copy()
        base, rest, i = row // STEP * STEP, row % STEP, np.arange(len(row))
        for k in range(STEP - 1):
            more = rest > k
            out[i[more], self.column[base[more] + k]] += 1
        return out[:, :-1]

    def one(self, row: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        out = self.before[row // STEP, symbol].astype(np.int64)
        base, rest = row // STEP * STEP, row % STEP
        for k in range(STEP - 1):
            out += (rest > k) & (self.column[base + k] == symbol)
        return out


class Index:
    """A bidirectional index of words over a text of symbols: 0 is the delimiter. A state is (lo, low, size): the interval's start among suffixes of
    the text, that of its mirror image among suffixes of the reversed text, and the size of both."""

    def __init__(self, words: list[str]):
        points = np.frombuffer("|".join(["", *words, ""]).encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(points[points != ord("|")])
        self.symbols = len(self.alphabet) + 1
        text = self.coded(points)
        self.order = suffix_order(text)
        self.left = Ranks(text, self.order, self.symbols)
        self.right = Ranks(text[::-1], suffix_order(text[::-1]), self.symbols)
        count = np.bincount(text, minlength=self.symbols)
        self.starts = np.cumsum(count) - count + 1
        self.word_at = np.flatnonzero(text == 0)[:-1]  # the delimiter before each word

    def coded(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; all that no word has are the number of symbols."""
        at = np.searchsorted(self.alphabet, points)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == points
        return np.where(points == ord("|"), 0, np.where(known, at + 1, self.symbols))

    def every(self, ranks: Ranks, own: np.ndarray, twin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States for each symbol put on the side of `ranks`: (own, twin, size), a column for each symbol."""
        lo, hi = ranks.all(own), ranks.all(own + size)
        n = (hi - lo).astype(np.int64)
        ended = size - n.sum(axis=1)  # what the text's edge precedes comes before all symbols
        return self.starts + lo, twin[:, None] + ended[:, None] + np.cumsum(n, axis=1) - n, n

    def put(self, ranks: Ranks, own: np.ndarray, twin: np.ndarray, size: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States after one given symbol each; unknown symbols leave none."""
        known = symbol < self.symbols
        s, i = np.where(known, symbol, 0), np.arange(len(symbol))
        a, b, n = self.every(ranks, own, twin, size)
        return a[i, s], b[i, s], np.where(known, n[i, s], 0)

    def near(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers of all pairs whose words are one edit apart, with the edit after the query's first half (len // 2)."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        by_length: dict[int, list[int]] = {}
        for k, q in enumerate(queries):
            by_length.setdefault(len(q), []).append(k)
        for length, ids in by_length.items():
            step = max(1, (1 << 20) // (length * self.symbols))
            for s in range(0, len(ids), step):
                part = ids[s : s + step]
                codes = self.coded(np.frombuffer("".join(queries[k] for k in part).encode("utf-32-le"), np.uint32)).reshape(len(part), length)
                q, w = self._search(codes)
                found.append((np.asarray(part)[q], w))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair = np.unique(np.stack([np.concatenate([f[k] for f in found]) for k in (0, 1)]), axis=1)
        return pair[0], pair[1]

    def _search(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, length = codes.shape
        q = np.arange(n)
        lo, low, size = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, len(self.order) + 1)
        # the first half exactly, from its last symbol to the delimiter before it
        for k in (*range(length // 2 - 1, -1, -1), None):
            lo, low, size = self.put(self.left, lo, low, size, np.zeros(len(q), np.int64) if k is None else codes[q, k])
            alive = size > 0
            q, lo, low, size = q[alive], lo[alive], low[alive], size[alive]
        one = [np.zeros(0, np.int64)] * 4  # states with an error
        cat = lambda *parts: [np.concatenate([p[k] for p in parts]) for k in range(4)]
        most = 1024
        for k in range(length // 2, length + 1):  # the delimiter comes last
            symbol = lambda i: codes[i, k] if k < length else np.zeros(len(i), np.int64)  # noqa: E731, B023
            # every symbol to the right of what has no error so far
            b, a, m = self.every(self.right, low, lo, size)
            want = symbol(q)
            i, c = np.nonzero(m[:, 1:])
            c += 1  # the delimiter is no letter
            put = [q[i], a[i, c], b[i, c], m[i, c]]
            one = cat(one, put)  # one symbol more than the query: the next is still to come
            b1, a1, m1 = self.put(self.right, one[2], one[1], one[3], symbol(one[0]))
            alive = m1 > 0
            one = [one[0][alive], a1[alive], b1[alive], m1[alive]]
            if k < length:
                other = c != want[i]
                one = cat(one, [x[other] for x in put], [q, lo, low, size])  # another symbol, or none
                if len(one[0]) > most:  # ways of one query to one interval are one
                    keep = np.unique(np.stack(one), axis=1, return_index=True)[1]
                    one = [x[keep] for x in one]
                    most = 2 * len(one[0]) + 1024
            held = want < self.symbols
            j = np.flatnonzero(held)
            lo, low, size, q = a[j, want[j]], b[j, want[j]], m[j, want[j]], q[j]
            alive = size > 0
            q, lo, low, size = q[alive], lo[alive], low[alive], size[alive]
        # `|word|` stands once: its row gives the place of its first delimiter
        return one[0], np.searchsorted(self.word_at, self.order[one[1] - 1])


def _searched(words: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    if not len(words) or not len(queries):
        return pd.DataFrame({"word": [], "near": []}, dtype=str)
    held, asked = sorted(words["word"]), list(queries["word"])
    q, w = Index(held).near(asked)
    return pd.DataFrame({"word": np.asarray(asked, object)[q], "near": np.asarray(held, object)[w]})


def _scheme(words: DataFrame) -> DataFrame:
    """(word, near) of words that agree in the first half of `word`, each with one edit after it."""
    place = written(ranked(words.select("word"), "word"))
    half = lambda n: F.substring("word", F.lit(1), F.floor(n / 2).cast("int"))
    size = F.length("word")
    # a word may be found by queries a letter shorter or longer
    halves = place.select("rank", F.explode(F.array_distinct(F.array(half(size - 1), half(size), half(size + 1)))).alias("half"))
    spans = halves.groupBy("half").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi")).where("hi > lo")
    asked = place.withColumn("half", half(size)).join(spans, "half").select("word", F.explode(F.sequence(F.floor(F.col("lo") / SHARD), F.floor(F.col("hi") / SHARD))).alias("shard"))
    asked = written(asked)
    loads = asked.groupBy("shard").agg(F.ceil(F.count("*") / QUERIES).alias("copies"))  # a row a shard
    asked = asked.join(F.broadcast(loads), "shard").withColumn("copy", F.pmod(F.xxhash64("word"), F.col("copies"))).select("shard", "copy", "word")
    held = place.withColumn("shard", F.floor(F.col("rank") / SHARD)).join(F.broadcast(loads), "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), "word")
    keys = ("shard", "copy")
    return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_searched, "word string, near string")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): every ordered pair of distinct words exactly one edit apart. words: word, each once."""
    back = _scheme(words.select(F.reverse("word").alias("word"))).select(F.reverse("word").alias("word"), F.reverse("near").alias("near"))
    return _scheme(words).unionByName(back).distinct()


def group(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n)."""
    words = written(words)
    pairs = near_words(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("b"))
    d = words.join(best, "word", "left").withColumn("good", F.coalesce(-F.col("b.m") >= TIMES * F.col("n"), F.lit(False)))
    d = written(d.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("good"), F.col("b.w")).alias("form"), F.when(F.col("good"), -F.col("b.m")).alias("form_n")))
    jump = d.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = jump.select(F.col("word").alias("root"), F.col("root").alias("far"))
        j = written(jump.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        jump = j.select("word", "root")
        if not j.where("moved").limit(1).count():
            break
    return d.join(jump, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(docs: DataFrame) -> DataFrame:
    return group(vocabulary(docs))
