r"""Operator 6, quality classifier: hierarchical empirical Bayes over document, path and host.

A naive Bayes classifier of binned text features is counted from all labelled documents: the evidence of a document is its log
likelihood ratio. The features are the share of symbols, capitals, words that repeat the word before, repeated lines, and the
words themselves: words are hashed to `BUCKETS`, whose counts in good and bad documents (a grouped aggregation over up to
`WORD_SAMPLE` labelled documents, taken by a hash) give each a log ratio, and the mean over a document is its fifth
feature. Under the global prior the evidence gives a first probability; grouped sums of these make a mean for each host (`source`) and each path (host and
`lang`). A host's mean is shrunk toward the global mean, a path's toward its host's, by strengths that the method of moments
takes from the spread between groups, so sparse sites fall back to the prior. The path's mean without the document itself is
the prior of its final posterior; it is kept at 0.5 or more.

Defined results: null and empty texts have all features 0 and are judged like others; a null host or path is a group of
its own; labels that are null, or whose document is absent, don't count; without labels of both kinds all evidence is 0 and
everything is kept; repeated rows are judged each; other columns pass through filter_quality() and are kept out of judge().
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspan.llm.common import labelled_sample, written

# Upper edges of the bins of each feature.
EDGES = (0.0, 0.004, 0.01, 0.03, 0.06, 0.12, 0.3)
WORD_EDGES = (-1.0, -0.4, -0.15, 0.0, 0.15, 0.4, 1.0)
FEATURES = ("symbols", "capitals", "repeats", "lines", "words")
#: Buckets of hashed words, and labelled documents that they are counted from, at most.
BUCKETS, WORD_SAMPLE = 4096, 20_000
#: Most paths whose priors are sent to every executor (about 20 MB); more are joined by a shuffle.
BROADCAST_PATHS = 100_000
#: Added to each count of a bin and class.
SMOOTH = 0.5


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def _repeats(parts: Column) -> Column:
    """Share of elements equal to the one before; the array is computed once."""
    same = F.transform(F.array(parts), lambda p: _share(F.size(F.filter(p, lambda w, i: F.coalesce(w == F.get(p, i - 1), F.lit(False)))), F.size(p)))
    return F.element_at(same, 1)


def _copies(parts: Column) -> Column:
    return F.element_at(F.transform(F.array(parts), lambda p: _share(F.size(p) - F.size(F.array_distinct(p)), F.size(p))), 1)


def _bin(x: Column, edges: tuple[float, ...] = EDGES) -> Column:
    return F.element_at(F.transform(F.array(x), lambda v: sum(((v > e).cast("int") for e in edges), F.lit(0))), 1)


def _buckets(text: Column) -> Column:
    """Buckets of a text's words."""
    return F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def word_ratios(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> list[float]:
    """The log ratio of each bucket of words; a row for each bucket and class comes to the driver. All 0 without both classes."""
    l = labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("q")).where("q is not null and i is not null").groupBy("i").agg((F.max("q") > 0).alias("q"))
    sample = F.broadcast(labelled_sample(l, WORD_SAMPLE, "i"))  # bounded
    words = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t")).join(sample, F.col("d") == F.col("i")).select("q", F.explode(_buckets(F.col("t"))).alias("b"))
    counts = {(r.b, r.q): r["count"] for r in words.groupBy("b", "q").count().collect()}
    total = [sum(n for (_, q), n in counts.items() if q == k) for k in (False, True)]
    if not all(total):
        return [0.0] * BUCKETS
    # rare buckets are shrunk toward 0 by as many words as the classes' shares would give
    share = lambda b, q: (counts.get((b, q), 0) + total[q] / sum(total)) / (total[q] + BUCKETS * total[q] / sum(total))
    return [math.log(share(b, True) / share(b, False)) for b in range(BUCKETS)]


def bins(text: Column, ratios: list[float]) -> Column:
    """array<int>: the bin of each feature; ratios are those of word_ratios()."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    table = F.array(*[F.lit(x) for x in ratios])
    own = F.element_at(F.transform(F.array(_buckets(t)), lambda b: F.aggregate(b, F.lit(0.0), lambda a, k: a + F.get(table, k)) / F.size(b)), 1)
    symbols = _share(F.regexp_count(t, F.lit(r"[!|#$%&*~^<>{}\\]")), n)
    capitals = _share(F.regexp_count(t, F.lit("[A-Z]")), n)
    return F.array(_bin(symbols), _bin(capitals), _bin(_repeats(F.split(t, r"\s+"))), _bin(_copies(F.split(t, "\n"))), _bin(own, WORD_EDGES))


@dataclass(frozen=True)
class Model:
    """Log likelihood ratios by feature and bin, and the share of good documents among the labelled."""

    ratios: tuple[tuple[float, ...], ...]
    prior: float

    def evidence(self, b: Column) -> Column:
        of = lambda k: F.get(F.array(*[F.lit(x) for x in self.ratios[k]]), F.get(b, k))
        return sum((of(k) for k in range(1, len(FEATURES))), of(0))


def fit(features: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Counts from all labelled documents; a row for each feature, bin and class comes to the driver."""
    l = labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("q")).where("q is not null and i is not null").groupBy("i").agg(F.max("q").alias("q"))
    joined = features.join(l.hint("merge"), features.doc_id == l.i)  # labels grow with the documents
    rows = joined.select("q", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin", "q").count().collect()
    counts = {(r.feature, r.bin, int(r.q > 0)): r["count"] for r in rows}
    n = [sum(v for (f, _, q), v in counts.items() if f == 0 and q == k) for k in (0, 1)]
    width = len(EDGES) + 1
    if not all(n):
        return Model(((0.0,) * width,) * len(FEATURES), 0.5)
    p = lambda f, b, q: (counts.get((f, b, q), 0) + SMOOTH) / (n[q] + SMOOTH * width)
    return Model(tuple(tuple(math.log(p(f, b, 1) / p(f, b, 0)) for b in range(width)) for f in range(len(FEATURES))), (n[1] + 1) / (sum(n) + 2))


def _strength(groups: DataFrame, mean: str) -> float:
    """Prior strength by the method of moments: spread of group means about the given mean, beyond binomial noise. One row."""
    v = F.col(mean) * (1 - F.col(mean))
    r = groups.where("n >= 2").agg(F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col(mean), 2)).alias("between"), F.sum(v).alias("noise"), F.sum(F.col("n") * v).alias("binomial"), F.sum("n").alias("n")).first()
    if not r.n:
        return 10.0
    spread = max(0.0, (r.between - r.noise) / r.n)
    return min(1000.0, max(1.0, r.binomial / r.n / spread - 1)) if spread > 0 else 1000.0


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def path_priors(evidence: DataFrame, model: Model) -> tuple[DataFrame, float]:
    """(host, path, n, s, host_mean) of each path and the strength of a host's mean over its paths; evidence has host, path, p."""
    paths = evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = total.s / total.n if total.n else model.prior
    k = _strength(hosts.withColumn("mean", F.lit(mean)), "mean")
    hosts = hosts.select(F.col("host").alias("h"), ((F.col("s") + k * mean) / (F.col("n") + k)).alias("host_mean"))
    joined = written(paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h"))
    return joined, _strength(joined, "host_mean")


def _judged(rows: DataFrame, priors: DataFrame, strength: float) -> DataFrame:
    """rows (with host, path, evidence, p) and their posterior: the path's mean, without the row itself, as the prior."""
    t = priors.select(F.col("host").alias("h"), F.col("path").alias("g"), "n", "s", "host_mean")
    on = F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("g"))
    few = t.limit(BROADCAST_PATHS + 1).count() <= BROADCAST_PATHS
    j = rows.join(F.broadcast(t) if few else t, on, "left")
    j = j.withColumn("path_mean", (F.col("s") - F.col("p") + strength * F.col("host_mean")) / (F.col("n") - 1 + strength))
    return j.withColumn("posterior", _sigmoid(F.col("evidence") + _logit(F.col("path_mean")))).withColumn("keep", F.col("posterior") >= 0.5)


def _evidence(rows: DataFrame, model: Model) -> DataFrame:
    return rows.withColumn("evidence", model.evidence(F.col("bins"))).withColumn("p", _sigmoid(F.col("evidence") + math.log(model.prior / (1 - model.prior))))


def _featured(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, host_col: str, path_col: str, label_col: str, *kept: Column) -> DataFrame:
    """doc_id, host, path and bins of each row, and the kept columns, written: texts are read for features once."""
    ratios = word_ratios(docs, labels, id_col, text_col, label_col)
    return written(docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(path_col).alias("path"), bins(F.col(text_col), ratios).alias("bins"), *kept))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """doc_id, evidence, host_mean, path_mean, posterior, keep."""
    features = _featured(docs, labels, id_col, text_col, host_col, path_col, label_col)
    model = fit(features, labels, id_col, label_col)
    rows = _evidence(features, model)
    return _judged(rows, *path_priors(rows, model)).select("doc_id", "evidence", "host_mean", "path_mean", "posterior", "keep")


def filter_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """The rows of docs, with all their columns, that judge() keeps; each row is judged by itself, no text is shuffled by id."""
    features = _featured(docs, labels, id_col, text_col, host_col, path_col, label_col, F.struct("*").alias("doc"))
    model = fit(features.drop("doc"), labels, id_col, label_col)
    rows = _evidence(features, model)
    return _judged(rows, *path_priors(rows.drop("doc"), model)).where("keep").select("doc.*")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, labels)
