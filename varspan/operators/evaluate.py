"""Evaluation of call sets against truth: outcomes, summaries, histograms, ROC tables, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspan.functions.variant import EVAL_EDGES, allele_lengths, bin_of, bins, gt_parse, hap_lengths, score, sv_length
from varspan.operators.convert import filter_nonref, filter_pass
from varspan.operators.order import running

#: Runs (caller and sample, say) that one evaluation takes.
MOST_RUNS = 10_000
METRICS = ("genotype_recall", "misgenotype_call", "recall", "mis_call", "call", "fail_call", "all")


def from_records(records: DataFrame, score_field: str | None = None, passed: bool = True) -> DataFrame:
    """VCF records as one side of an evaluation: PASS (unless passed is false), a non-reference genotype of the last sample, lengths by ID, REF and ALT, and the
    score by a field (FORMAT.<key> or INFO.<key>). Gives ord, chrom, pos, ref_len, g0, g1, h0, h1, sv_len, score."""
    last = F.element_at("samples", -1)
    r = (filter_pass(records) if passed else records).withColumn("gt", gt_parse(F.col("format"), last)["gt"])
    r = filter_nonref(r).withColumn("l", allele_lengths(F.col("id"), F.col("ref"), F.col("alts")))
    r = r.withColumn("hap", hap_lengths(F.col("l"), F.col("gt")))
    value = score(F.col("info"), F.col("format"), last, score_field) if score_field else F.lit(0.0)
    at = lambda c, k: F.get(c, F.least(F.lit(k), F.size(c) - 1))  # noqa: E731  one allele counts twice
    return r.select(
        "ord", "chrom", "pos", F.col("l.ref_len").alias("ref_len"), *[at("gt", k).alias(f"g{k}") for k in (0, 1)], *[at("hap", k).alias(f"h{k}") for k in (0, 1)],
        sv_length(F.col("l.ref_len"), F.col("hap"), F.col("gt")).alias("sv_len"), value.alias("score"),
    )


def use_once(matches: DataFrame, run: tuple[str, ...] = ()) -> DataFrame:
    """Of the calls that match one truth row the first alone."""
    rest = [c for c in matches.columns if c not in (*run, "site_id", "call_id")]
    first = F.min(F.struct("call_id", *rest)).alias("m")
    return matches.groupBy(*run, "site_id").agg(first).select(*run, "site_id", "m.*").select(*matches.columns)


def outcomes(calls: DataFrame, matches: DataFrame, truth_lengths: DataFrame, run: tuple[str, ...] = ()) -> DataFrame:
    """One row a call: outcome genotype, misgenotype or miscall, its length and that of the truth row.

    calls: run, call_id, score, sv_len; matches: run, call_id, site_id, n_hap, each truth row once; truth_lengths: site_id, true_len."""
    m = matches.join(truth_lengths, "site_id")
    kind = F.when(F.col("n_hap") >= 2, "genotype").when(F.col("n_hap") == 1, "misgenotype").otherwise("miscall")
    return calls.select(*run, "call_id", "score", "sv_len").join(m, [*run, "call_id"], "left").withColumn("outcome", kind)


def fail_calls(truth: DataFrame, runs: DataFrame, matches: DataFrame, run: tuple[str, ...]) -> DataFrame:
    """Truth rows that no call of a run matched: every row without a match goes with each run, as the result has it. runs holds each
    run once; up to MOST_RUNS go along in one array."""
    every = runs.select(F.struct(*run).alias("r")).agg(F.collect_list("r").alias("rs")).select(F.when(F.size("rs") <= MOST_RUNS, F.col("rs")).otherwise(F.raise_error(F.lit(f"more than {MOST_RUNS} runs"))).alias("rs"))
    rows = truth.join(F.broadcast(every)).select(*truth.columns, F.explode("rs").alias("r")).select(*truth.columns, "r.*")  # one row
    return rows.join(matches.select(*run, "site_id"), [*run, "site_id"], "left_anti")


def _metrics(counts: dict[str, Column]) -> list[Column]:
    g, m, x, a = (counts[k] for k in ("g", "m", "x", "a"))
    values = (g, m, g + m, x, g + m + x, a - g - m, a)
    return [v.alias(k) for k, v in zip(METRICS, values, strict=True)]


def _lengths(out: DataFrame, run: tuple[str, ...]) -> DataFrame:
    """(run, len, g, m, x): calls of each length and outcome; matched ones by the truth's length, miscalls by the call's. Bins and parts
    are told of these few rows."""
    n = lambda kind: F.sum((F.col("outcome") == kind).cast("long"))
    length = F.when(F.col("outcome") == "miscall", F.col("sv_len")).otherwise(F.col("true_len"))
    return out.withColumn("len", length).groupBy(*run, "len").agg(n("genotype").alias("g"), n("misgenotype").alias("m"), n("miscall").alias("x"))


def _counts() -> list[Column]:
    return [F.sum(k).alias(k) for k in "gmx"]


def summary(out: DataFrame, truth: DataFrame, run: tuple[str, ...] = ()) -> DataFrame:
    """The seven counts for all variants, and for those longer than 49 bases. Each run is measured against all of truth."""

    def part(length: str) -> Column:
        return F.explode(F.when(F.abs(length) > 49, F.array(F.lit("all"), F.lit("sv"))).otherwise(F.array(F.lit("all"))))

    total = truth.select(part("true_len").alias("part")).groupBy("part").agg(F.count("*").alias("a"))
    g = _lengths(out, run).withColumn("part", part("len")).groupBy(*run, "part").agg(*_counts())
    # a part without calls is still a part: both are laid out for each run
    both = g.groupBy(*run).agg(*[F.coalesce(F.sum(F.when(F.col("part") == p, F.col(k))), F.lit(0)).alias(f"{p}_{k}") for p in ("all", "sv") for k in "gmx"])
    rows = both.select(*run, F.explode(F.array(*[F.struct(F.lit(p).alias("part"), *[F.col(f"{p}_{k}").alias(k) for k in "gmx"]) for p in ("all", "sv")])).alias("r")).select(*run, "r.*")
    return rows.join(F.broadcast(total), "part", "left").na.fill(0, ["a"]).select(*run, "part", *_metrics({k: F.col(k) for k in "gmxa"}))  # two rows


def histogram(out: DataFrame, truth: DataFrame, run: tuple[str, ...] = ()) -> DataFrame:
    """The seven counts in each of the 25 length bins for each run; empty bins have zeros."""
    of = lambda length: F.coalesce(bin_of(F.col(length), EVAL_EDGES), F.lit(-1))
    total = truth.groupBy("true_len").agg(F.count("*").alias("a")).withColumn("bin", of("true_len")).groupBy("bin").agg(F.sum("a").alias("a"))
    g = _lengths(out, run).withColumn("bin", of("len")).groupBy(*run, "bin").agg(*_counts())
    by_run = g.groupBy(*run).agg(F.map_from_entries(F.collect_list(F.struct("bin", F.struct("g", "m", "x")))).alias("held"))  # 26 entries
    dim = F.array(*[F.struct(F.lit(k).alias("bin"), F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi")) for k, lo, hi in bins(EVAL_EDGES)])
    rows = by_run.select(*run, "held", F.explode(dim).alias("b")).select(*run, "b.*", F.element_at("held", F.col("b.bin")).alias("c")).select(*run, "bin", "lo", "hi", "c.*")
    return rows.join(F.broadcast(total), "bin", "left").na.fill(0, list("gmxa")).select(*run, "bin", "lo", "hi", *_metrics({k: F.col(k) for k in "gmxa"}))  # 25 rows


def _ratio(a: Column, b: Column, digits: int = 3) -> Column:
    return F.coalesce(F.round(F.try_divide(a.cast("double"), b.cast("double")), digits), F.lit(0.0))


def rollup(hist: DataFrame, run: tuple[str, ...] = (), per: str = "call") -> DataFrame:
    """Bins summed to overlapping categories with recall, precision, genotype recall and genotype precision (per call or per recall)."""
    lo, hi = F.col("lo"), F.col("hi")
    inside = lambda a, b: (lo >= a) & (hi <= b)
    names = (
        F.when(hi < -49, F.array(F.lit("del"), F.lit("sv")))
        .when(inside(-19, -1) | inside(1, 19), F.array(F.lit("smallIndel"), F.lit("indel")))
        .when(inside(-49, -20) | inside(20, 49), F.array(F.lit("lagerIndel"), F.lit("indel")))
        .when(inside(0, 0), F.array(F.lit("snp")))
        .otherwise(F.array(F.lit("ins"), F.lit("sv")))
    )
    rows = hist.withColumn("category", F.explode(F.concat(names, F.array(F.lit("all")))))
    s = rows.groupBy(*run, "category").agg(*[F.sum(k).alias(f"n_{k}") for k in ("all", "genotype_recall", "recall", "call")])
    n = {k: F.col(f"n_{k}") for k in ("all", "genotype_recall", "recall", "call")}
    return s.select(*run, "category", _ratio(n["recall"], n["all"]).alias("recall"), _ratio(n["recall"], n["call"]).alias("precision"), _ratio(n["genotype_recall"], n["all"]).alias("genotype"), _ratio(n["genotype_recall"], n[per]).alias("genotype_precision"))


def pivot(hist: DataFrame, run: str, values: list[str], metric: str = "recall") -> DataFrame:
    """A metric of several runs side by side for each bin."""
    return hist.groupBy("bin").pivot(run, values).agg(F.first(metric))


def _classes(length: Column) -> Column:
    own = F.when(length == 0, "snp").when(F.abs(length) < 50, "indel").when(length <= -50, "del").otherwise("ins")
    return F.explode(F.array(F.lit("all"), own))


def roc(out: DataFrame, truth: DataFrame, run: tuple[str, ...] = (), by: str = "genotype") -> DataFrame:
    """Per class and descending score: cumulative TP, FP, TN (0), FN, recall, precision, F. by: genotype, or recall for any match. Sums run over range
    partitions, so that a run whose calls all have scores of their own is no single group."""
    tp = F.col("outcome") == "genotype" if by == "genotype" else F.col("outcome") != "miscall"
    scored = out.withColumn("class", _classes(F.col("sv_len"))).groupBy(*run, "class", "score").agg(F.sum(tp.cast("long")).alias("t"), F.count("*").alias("n"))
    total = truth.select(_classes(F.col("true_len")).alias("class")).groupBy("class").agg(F.count("*").alias("total"))
    c = running(scored, [*run, "class"], [F.desc("score")], ["t", "n"]).withColumnsRenamed({"t_upto": "tp", "n_upto": "calls"})
    c = c.join(F.broadcast(total), "class", "left").withColumn("total", F.coalesce("total", F.lit(0)))  # five rows
    r, p = F.try_divide(F.col("tp").cast("double"), F.col("total").cast("double")), F.try_divide(F.col("tp").cast("double"), F.col("calls").cast("double"))
    c = c.withColumns({"r": F.coalesce(r, F.lit(0.0)), "p": F.coalesce(p, F.lit(0.0))})
    f = F.coalesce(F.try_divide(2 * F.col("r") * F.col("p"), F.col("r") + F.col("p")), F.lit(0.0))
    return c.select(*run, "class", "score", "tp", (F.col("calls") - F.col("tp")).alias("fp"), F.lit(0).cast("long").alias("tn"), (F.col("total") - F.col("tp")).alias("fn"), F.round("r", 6).alias("recall"), F.round("p", 6).alias("precision"), F.round(f, 6).alias("f_score"))
