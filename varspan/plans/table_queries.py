"""Queries on call sets, truth, panel and reads, each with its DuckDB oracle where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varspan.functions import variant as V
from varspan.functions.variant import EVAL_EDGES
from varspan.operators import convert as C
from varspan.operators import ensemble as N
from varspan.operators import evaluate as E
from varspan.operators import intervals as I
from varspan.operators import sites as S
from varspan.plans.record_queries import _dim, sites
from varspan.plans.views import oracle, view
from varspan.sources import text as T
from varspan.sources.text import checkpointed as written

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
RUN = ("caller", "sample_id")
CALLERS = ("BayesTyper", "GraphAligner", "GraphTyper2", "PanGenie", "Paragraph", "VG-Giraffe", "VG-MAP")


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


# --- inputs of the operators, and the same as SQL

_C = """c AS (SELECT call_id, caller, sample_id, source_site, chrom, pos, ref_len, alt_len, a1 AS g0, a2 AS g1, depth, score,
  CASE WHEN a1 = 0 THEN ref_len ELSE alt_len END AS h0, CASE WHEN a2 = 0 THEN ref_len ELSE alt_len END AS h1,
  CASE WHEN a2 <> 0 OR a1 <> 0 THEN alt_len - ref_len ELSE 0 END AS sv_len FROM v_calls WHERE flt = 'PASS' AND a1 + a2 > 0)"""
_T = """t AS (SELECT site_id, chrom, pos, ref_len, alt_len, a1 AS g0, a2 AS g1, CASE WHEN a1 = 0 THEN ref_len ELSE alt_len END AS h0,
  CASE WHEN a2 = 0 THEN ref_len ELSE alt_len END AS h1, alt_len - ref_len AS true_len FROM v_truth)"""


def calls(spark, d) -> DataFrame:
    c = view(spark, d, "v_calls").withColumns({"filter": F.col("flt"), "gt": F.array("a1", "a2")})
    c = C.filter_nonref(C.filter_pass(c))
    lens = F.struct(F.col("ref_len").alias("ref_len"), F.array("alt_len").alias("lens"))
    hap = V.hap_lengths(lens, F.col("gt"))
    return c.withColumns({"g0": F.col("a1"), "g1": F.col("a2"), "h0": F.get(hap, F.lit(0)), "h1": F.get(hap, F.lit(1)), "sv_len": V.sv_length(F.col("ref_len"), hap, F.col("gt"))})


def truth(spark, d) -> DataFrame:
    t = view(spark, d, "v_truth").withColumn("gt", F.array("a1", "a2"))
    hap = V.hap_lengths(F.struct(F.col("ref_len").alias("ref_len"), F.array("alt_len").alias("lens")), F.col("gt"))
    return t.withColumns({"g0": F.col("a1"), "g1": F.col("a2"), "h0": F.get(hap, F.lit(0)), "h1": F.get(hap, F.lit(1)), "true_len": F.col("alt_len") - F.col("ref_len")})


def panel(spark, d) -> DataFrame:
    miss = lambda a: F.when(F.col(a) >= 0, F.col(a)).cast("int")
    return view(spark, d, "v_panel").withColumn("gt", F.array(miss("a1"), miss("a2")))


def _fits(p: str, r: str, q: str, tp: str, tr: str, tq: str) -> str:
    near = lambda w: f"abs({p} - {tp}) <= {w} AND abs({p} + {r} - {tp} - {tr}) <= {w}"
    rr, qq = f"abs({r} - {tr}) * 1.0 / {tr} <= 0.25", f"abs({q} - {tq}) * 1.0 / {tq} <= 0.25"
    return f"""CASE WHEN {r} >= 50 AND {q} < 50 THEN {near(200)} AND {rr} WHEN {r} < 50 AND {q} >= 50 THEN {near(200)} AND {qq}
  WHEN {r} >= 50 AND {q} >= 50 THEN {near(200)} AND {rr} AND {qq} WHEN {r} = 1 AND {q} = 1 THEN {near(1)} AND {rr} AND {qq}
  WHEN {r} >= 3 AND {q} <= 2 THEN {near(10)} AND {rr} WHEN {r} <= 2 AND {q} >= 3 THEN {near(10)} AND {qq} ELSE {near(1)} AND {rr} AND {qq} END"""


# --- filters and columns on tables


@query("filter_pass", oracle("v_calls", "SELECT call_id, caller FROM v_calls WHERE flt = 'PASS'"))
def filter_pass(spark, d):
    return C.filter_pass(view(spark, d, "v_calls"), "flt").select("call_id", "caller")


@query("filter_nonref", oracle("v_panel", "SELECT site_id, sample_id FROM v_panel WHERE a1 > 0 OR a2 > 0"))
def filter_nonref(spark, d):
    return C.filter_nonref(panel(spark, d).withColumn("gt", F.transform("gt", lambda g: F.coalesce(g, F.lit(0))))).select("site_id", "sample_id")


_MAF = """ms AS (SELECT site_id, count(*) AS n, sum(CASE WHEN a1 < 0 THEN 1 ELSE 0 END) AS miss FROM v_panel GROUP BY site_id),
ma AS (SELECT site_id, row_number() OVER (PARTITION BY site_id ORDER BY c DESC, a) AS k, c FROM (
  SELECT site_id, a, count(*) AS c FROM (SELECT site_id, a1 AS a FROM v_panel UNION ALL SELECT site_id, a2 FROM v_panel) WHERE a >= 0 GROUP BY site_id, a)),
mf AS (SELECT ms.site_id, coalesce(ma.c, 0) * 1.0 / (2 * ms.n) AS maf, ms.miss * 1.0 / ms.n AS missing_rate, ms.n - ms.miss AS called FROM ms LEFT JOIN ma ON ma.site_id = ms.site_id AND ma.k = 2)"""


@query("maf_missing", oracle("v_panel v_sites", f", {_MAF} SELECT mf.site_id, CAST(round(maf, 9) AS DOUBLE) AS maf, CAST(round(missing_rate, 9) AS DOUBLE) AS missing_rate FROM mf JOIN v_sites s ON s.site_id = mf.site_id WHERE s.ref_len = 1 AND s.alt_len + s.n_alts - 1 = 1"))
def maf_missing(spark, d):
    snps = S.variant_type_site(sites(spark, d)).where("type = 'SNP'").select("site_id")
    return S.maf_missing(panel(spark, d).join(snps, "site_id", "left_semi")).select("site_id", F.round("maf", 9).alias("maf"), F.round("missing_rate", 9).alias("missing_rate"))


@query("filter_maf", oracle("v_panel v_sites", f", {_MAF} SELECT s.site_id FROM v_sites s JOIN mf ON mf.site_id = s.site_id WHERE s.ref_len <> 1 OR s.alt_len + s.n_alts - 1 <> 1 OR (maf >= 0.3 AND missing_rate <= 0.1 AND called > 1)"))
def filter_maf(spark, d):
    return S.filter_maf(S.variant_type_site(sites(spark, d)), S.maf_missing(panel(spark, d)), maf=0.3).select("site_id")


# --- joins


_MATCHED = f""", {_C},
a AS (SELECT site_id, chrom, pos, ref_len, k AS allele, CASE k WHEN 0 THEN ref_len WHEN 1 THEN alt_len ELSE alt_len + 1 END AS q FROM v_sites, (SELECT unnest([0, 1, 2]) AS k) WHERE k <= n_alts),
p AS (SELECT c.call_id, c.g0, c.g1, a.site_id, a.pos AS s_pos, a.allele,
  ({_fits('c.pos', 'c.ref_len', 'c.h0', 'a.pos', 'a.ref_len', 'a.q')}) AND ((c.g0 = 0) = (a.allele = 0)) AS f0,
  ({_fits('c.pos', 'c.ref_len', 'c.h1', 'a.pos', 'a.ref_len', 'a.q')}) AND ((c.g1 = 0) = (a.allele = 0)) AS f1
  FROM c JOIN a ON a.chrom = c.chrom AND abs(a.pos - c.pos) <= CASE WHEN c.ref_len <= 49 AND c.h0 <= 49 THEN 10 ELSE 200 END),
m0 AS (SELECT call_id, site_id, allele FROM (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY s_pos, site_id, allele) AS k FROM p WHERE f0) WHERE k = 1),
any1 AS (SELECT call_id, site_id, allele FROM (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY s_pos, site_id, allele) AS k FROM p WHERE f1) WHERE k = 1),
same1 AS (SELECT p.call_id, p.site_id, min(p.allele) AS allele FROM p JOIN m0 ON m0.call_id = p.call_id AND m0.site_id = p.site_id WHERE p.f1 GROUP BY p.call_id, p.site_id),
mt AS (SELECT call_id, CAST(0 AS BIGINT) AS hap, site_id, CAST(allele AS BIGINT) AS allele FROM m0
UNION ALL SELECT c.call_id, 1, CASE WHEN m0.call_id IS NULL THEN any1.site_id ELSE m0.site_id END,
  CASE WHEN m0.call_id IS NULL THEN any1.allele WHEN c.g0 = c.g1 THEN m0.allele ELSE same1.allele END
FROM c LEFT JOIN m0 ON m0.call_id = c.call_id LEFT JOIN any1 ON any1.call_id = c.call_id LEFT JOIN same1 ON same1.call_id = c.call_id
WHERE CASE WHEN m0.call_id IS NULL THEN any1.allele WHEN c.g0 = c.g1 THEN m0.allele ELSE same1.allele END IS NOT NULL)"""
_SLOTS = """lw AS (SELECT * FROM (SELECT mt.site_id, c.sample_id, c.caller, mt.hap, mt.allele, mt.call_id, c.depth,
  row_number() OVER (PARTITION BY mt.site_id, c.sample_id, c.caller, mt.hap ORDER BY c.pos DESC, c.call_id DESC) AS k FROM mt JOIN c ON c.call_id = mt.call_id) WHERE k = 1)"""


@query("match_sites", oracle("v_calls v_sites", f"{_MATCHED} SELECT * FROM mt"))
def match_sites(spark, d):
    return I.match_sites(written(calls(spark, d)), _lens(spark, d)).select("call_id", F.col("hap").cast("long").alias("hap"), "site_id", F.col("allele").cast("long").alias("allele"))


def _lens(spark, d) -> DataFrame:
    return sites(spark, d).withColumn("lens", F.concat(F.array("ref_len"), "alt_lens"))


SLOT = ("sample_id", "caller")


def _taken(spark, d) -> DataFrame:
    kept = calls(spark, d).select("call_id", *SLOT, "chrom", "pos", "ref_len", "h0", "h1", "g0", "g1", "depth")
    return N.taken(I.match_calls(written(kept), _lens(spark, d), carry=(*SLOT, "pos", "depth")), SLOT, I.PLACE)


@query("last_writer", oracle("v_calls v_sites", f"{_MATCHED}, {_SLOTS} SELECT site_id, sample_id, caller, hap, allele, call_id, CAST(depth AS DOUBLE) AS depth FROM lw"))
def last_writer(spark, d):
    s = N.slots(_taken(spark, d), SLOT)
    return s.withColumns({k: F.col(k).cast("long") for k in ("hap", "allele")})


_HAPS = """hp AS (SELECT c.*, t.site_id, t.true_len,
  coalesce(({f00}) AND ((c.g0 = 0) = (t.g0 = 0)), false) AS f00, coalesce(({f01}) AND ((c.g0 = 0) = (t.g1 = 0)), false) AS f01,
  coalesce(({f10}) AND ((c.g1 = 0) = (t.g0 = 0)), false) AS f10, coalesce(({f11}) AND ((c.g1 = 0) = (t.g1 = 0)), false) AS f11
  FROM c JOIN t ON t.chrom = c.chrom AND t.pos = c.pos),
mx AS (SELECT *, CASE WHEN f00 THEN 1 + CAST(f11 AS INT) WHEN f01 THEN 1 + CAST(f10 AS INT) WHEN f10 OR f11 THEN 1 ELSE 0 END AS n_hap FROM hp),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY caller, sample_id, site_id ORDER BY call_id) AS k FROM mx WHERE n_hap > 0) WHERE k = 1)""".format(
    **{f"f{i}{k}": _fits("c.pos", "c.ref_len", f"c.h{i}", "t.pos", "t.ref_len", f"t.h{k}") for i in (0, 1) for k in (0, 1)}
)
_OUT = f"""{_C}, {_T}, {_HAPS},
o AS (SELECT c.*, once.site_id, once.true_len, CASE WHEN once.n_hap = 2 THEN 'genotype' WHEN once.n_hap = 1 THEN 'misgenotype' ELSE 'miscall' END AS outcome
  FROM c LEFT JOIN once ON once.call_id = c.call_id),
runs AS (SELECT DISTINCT caller, sample_id FROM c),
ln AS (SELECT caller, sample_id, outcome AS kind, CASE WHEN outcome = 'miscall' THEN sv_len ELSE true_len END AS len FROM o
  UNION ALL SELECT caller, sample_id, 'all', true_len FROM runs CROSS JOIN t)"""
_SUMS = """CAST(sum(CASE WHEN kind = 'genotype' THEN 1 ELSE 0 END) AS BIGINT) AS g, CAST(sum(CASE WHEN kind = 'misgenotype' THEN 1 ELSE 0 END) AS BIGINT) AS m,
  CAST(sum(CASE WHEN kind = 'miscall' THEN 1 ELSE 0 END) AS BIGINT) AS x, CAST(sum(CASE WHEN kind = 'all' THEN 1 ELSE 0 END) AS BIGINT) AS a"""
_SEVEN = 'g AS genotype_recall, m AS misgenotype_call, g + m AS recall, x AS mis_call, g + m + x AS call, a - g - m AS fail_call, a AS "all"'


def _exact(spark, d) -> DataFrame:
    return I.match_exact(calls(spark, d), truth(spark, d), RUN)


def _outcomes(spark, d) -> DataFrame:
    c, t = written(calls(spark, d)), truth(spark, d)  # calls are read twice
    return E.outcomes(c, E.use_once(I.match_exact(c, t, RUN), RUN), t.select("site_id", "true_len"), RUN)


@query("match_exact", oracle("v_calls v_truth", f", {_C}, {_T}, {_HAPS} SELECT caller, sample_id, call_id, site_id, CAST(n_hap AS BIGINT) AS n_hap FROM mx WHERE n_hap > 0"))
def match_exact(spark, d):
    return _exact(spark, d).withColumn("n_hap", F.col("n_hap").cast("long"))


#: Calls in order, each taking its first row that isn't used yet, one call of each run and chromosome a step.
_SEQUENTIAL = _HAPS.partition(",\nonce AS")[0].replace(
    "t.chrom = c.chrom AND t.pos = c.pos", "t.chrom = c.chrom AND abs(t.pos - c.pos) <= CASE WHEN c.ref_len <= 49 AND c.h0 <= 49 THEN 10 ELSE 200 END"
).replace("t.site_id, t.true_len,", "t.site_id, t.pos AS t_pos, t.true_len,") + """,
cd AS (SELECT *, row_number() OVER (PARTITION BY caller, sample_id, chrom ORDER BY call_id) AS k FROM (SELECT caller, sample_id, chrom, call_id,
  list({'s': site_id, 'n': n_hap} ORDER BY CASE WHEN f00 OR f01 THEN 0 ELSE 1 END, t_pos, site_id) AS opts FROM mx WHERE n_hap > 0 GROUP BY caller, sample_id, chrom, call_id)),
sq AS (WITH RECURSIVE w AS (
    SELECT caller, sample_id, chrom, k, call_id, opts[1] AS pick, [opts[1].s] AS used FROM cd WHERE k = 1
    UNION ALL SELECT caller, sample_id, chrom, k, call_id, pick, CASE WHEN pick IS NULL THEN used ELSE list_append(used, pick.s) END FROM (
      SELECT cd.caller, cd.sample_id, cd.chrom, cd.k, cd.call_id, w.used, list_filter(cd.opts, lambda x: NOT list_contains(w.used, x.s))[1] AS pick
      FROM w JOIN cd ON cd.caller = w.caller AND cd.sample_id = w.sample_id AND cd.chrom = w.chrom AND cd.k = w.k + 1))
  SELECT * FROM w)"""


@query("match_truth", oracle("v_calls v_truth", f", {_C}, {_T}, {_SEQUENTIAL} SELECT caller, sample_id, call_id, pick.s AS site_id, CAST(pick.n AS BIGINT) AS n_hap FROM sq WHERE pick IS NOT NULL"))
def match_truth(spark, d):
    return I.match_truth(written(calls(spark, d)), truth(spark, d), RUN).withColumn("n_hap", F.col("n_hap").cast("long"))


@query("use_once", oracle("v_calls v_truth", f", {_C}, {_T}, {_HAPS} SELECT caller, sample_id, call_id, site_id, CAST(n_hap AS BIGINT) AS n_hap FROM once"))
def use_once(spark, d):
    return E.use_once(_exact(spark, d), RUN).withColumn("n_hap", F.col("n_hap").cast("long"))


@query("fail_calls", oracle("v_calls v_truth", f", {_OUT} SELECT caller, sample_id, t.site_id, t.true_len FROM runs CROSS JOIN t WHERE NOT EXISTS (SELECT 1 FROM once WHERE once.caller = runs.caller AND once.sample_id = runs.sample_id AND once.site_id = t.site_id)"))
def fail_calls(spark, d):
    runs = calls(spark, d).select(*RUN).distinct()
    return E.fail_calls(truth(spark, d).select("site_id", "true_len"), runs, E.use_once(_exact(spark, d), RUN), RUN).select(*RUN, "site_id", "true_len")


@query("call_sets", oracle("v_calls v_truth", f", {_OUT} SELECT caller, sample_id, call_id, outcome FROM o"))
def call_sets(spark, d):
    return _outcomes(spark, d).select(*RUN, "call_id", "outcome")


@query("eval_summary", oracle("v_calls v_truth", f""", {_OUT}
SELECT caller, sample_id, part, {_SEVEN} FROM (SELECT caller, sample_id, part, {_SUMS} FROM (SELECT *, 'all' AS part FROM ln UNION ALL SELECT *, 'sv' FROM ln WHERE abs(len) > 49) GROUP BY caller, sample_id, part)"""))  # fmt: skip
def eval_summary(spark, d):
    return E.summary(_outcomes(spark, d), truth(spark, d), RUN)


_HIST = f"""{_OUT}, hi AS (SELECT r.caller, r.sample_id, CAST(b.bin AS BIGINT) AS bin, CAST(b.lo AS BIGINT) AS lo, CAST(b.hi AS BIGINT) AS hi, {_SUMS}
  FROM runs r CROSS JOIN {_dim(EVAL_EDGES)} LEFT JOIN ln ON ln.caller = r.caller AND ln.sample_id = r.sample_id AND ln.len BETWEEN b.lo AND b.hi GROUP BY ALL)"""


@query("eval_hist", oracle("v_calls v_truth", f", {_HIST} SELECT caller, sample_id, bin, lo, hi, {_SEVEN} FROM hi"))
def eval_hist(spark, d):
    return E.histogram(_outcomes(spark, d), truth(spark, d), RUN).withColumn("bin", F.col("bin").cast("long"))


@query("category_rollup", oracle("v_calls v_truth", f""", {_HIST},
k AS (SELECT hi.*, unnest(CASE WHEN hi < -49 THEN ['del', 'sv', 'all'] WHEN (lo >= -19 AND hi <= -1) OR (lo >= 1 AND hi <= 19) THEN ['smallIndel', 'indel', 'all']
  WHEN (lo >= -49 AND hi <= -20) OR (lo >= 20 AND hi <= 49) THEN ['lagerIndel', 'indel', 'all'] WHEN lo = 0 AND hi = 0 THEN ['snp', 'all'] ELSE ['ins', 'sv', 'all'] END) AS category FROM hi),
s AS (SELECT caller, sample_id, category, sum(g)::DOUBLE AS g, sum(g + m)::DOUBLE AS r, sum(g + m + x)::DOUBLE AS c, sum(a)::DOUBLE AS a FROM k GROUP BY ALL)
SELECT caller, sample_id, category, coalesce(round(r / nullif(a, 0), 3), 0.0) AS recall, coalesce(round(r / nullif(c, 0), 3), 0.0) AS precision,
  coalesce(round(g / nullif(a, 0), 3), 0.0) AS genotype, coalesce(round(g / nullif(c, 0), 3), 0.0) AS genotype_precision FROM s"""))  # fmt: skip
def category_rollup(spark, d):
    return E.rollup(E.histogram(_outcomes(spark, d), truth(spark, d), RUN), RUN)


@query("report_pivot", oracle("v_calls v_truth", f", {_HIST} SELECT bin, " + ", ".join(f"CAST(sum(CASE WHEN caller = '{c}' THEN g + m END) AS BIGINT) AS \"{c}\"" for c in CALLERS) + " FROM hi GROUP BY bin"))
def report_pivot(spark, d):
    h = E.histogram(_outcomes(spark, d), truth(spark, d), RUN).groupBy("caller", F.col("bin").cast("long").alias("bin")).agg(F.sum("recall").alias("recall"))
    return E.pivot(h, "caller", list(CALLERS))


@query("roc_table", oracle("v_calls v_truth", f""", {_OUT},
oc AS (SELECT *, unnest(CASE WHEN sv_len = 0 THEN ['all', 'snp'] WHEN abs(sv_len) < 50 THEN ['all', 'indel'] WHEN sv_len <= -50 THEN ['all', 'del'] ELSE ['all', 'ins'] END) AS class FROM o),
tc AS (SELECT class, count(*) AS total FROM (SELECT unnest(CASE WHEN true_len = 0 THEN ['all', 'snp'] WHEN abs(true_len) < 50 THEN ['all', 'indel'] WHEN true_len <= -50 THEN ['all', 'del'] ELSE ['all', 'ins'] END) AS class FROM t) GROUP BY class),
g AS (SELECT caller, sample_id, class, score, sum(CASE WHEN outcome = 'genotype' THEN 1 ELSE 0 END) AS tp1, count(*) AS n1 FROM oc GROUP BY ALL),
u AS (SELECT g.caller, g.sample_id, g.class, g.score, CAST(sum(tp1) OVER w AS BIGINT) AS tp, CAST(sum(n1) OVER w AS BIGINT) AS calls, coalesce(tc.total, 0) AS total FROM g LEFT JOIN tc ON tc.class = g.class
  WINDOW w AS (PARTITION BY g.caller, g.sample_id, g.class ORDER BY g.score DESC ROWS UNBOUNDED PRECEDING)),
v AS (SELECT *, coalesce(tp::DOUBLE / nullif(total, 0), 0.0) AS r, coalesce(tp::DOUBLE / nullif(calls, 0), 0.0) AS p FROM u)
SELECT caller, sample_id, class, score, tp, calls - tp AS fp, CAST(0 AS BIGINT) AS tn, total - tp AS fn, round(r, 6) AS recall, round(p, 6) AS precision, round(coalesce(2 * r * p / nullif(r + p, 0), 0.0), 6) AS f_score FROM v"""))  # fmt: skip
def roc_table(spark, d):
    return E.roc(_outcomes(spark, d), truth(spark, d), RUN)


@query("evaluate_vcf", ORACLES["roc_table"])
def evaluate_vcf(spark, d):
    """The whole evaluation from lines: records, PASS and genotype filters, lengths, matching, outcomes, ROC by FORMAT.GQ."""
    lines, kept = view(spark, d, "v_call_lines"), view(spark, d, "v_call_lines").select("ord", *RUN)
    r = E.from_records(T.records(lines), "FORMAT.GQ").join(kept, "ord")
    t = E.from_records(T.records(view(spark, d, "v_truth_lines")))
    c = written(r.withColumnsRenamed({"ord": "call_id"}))  # lines are parsed once
    t = t.select(F.col("ord").alias("site_id"), "chrom", "pos", "ref_len", "g0", "g1", "h0", "h1", F.col("sv_len").alias("true_len"))
    t = written(t)
    m = E.use_once(I.match_exact(c, t, RUN), RUN)
    return E.roc(E.outcomes(c, m, t.select("site_id", "true_len"), RUN), t, RUN).withColumn("score", F.col("score").cast("long"))


@query("chrom_known", oracle("v_calls", "SELECT call_id FROM v_calls WHERE call_id % 11 <> 0"))
def chrom_known(spark, d):
    c = view(spark, d, "v_calls").withColumn("chrom", F.when(F.col("call_id") % 11 == 0, "chrX").otherwise(F.col("chrom")))
    return C.chrom_known(c, view(spark, d, "v_contigs")).select("call_id")


@query("nearby_small", oracle("v_sites", """,
sv AS (SELECT site_id AS id, chrom, pos AS s, pos + ref_len - 1 AS e FROM v_sites WHERE ref_len >= 50 OR alt_len >= 50),
sm AS (SELECT chrom, pos AS s, pos + ref_len - 1 AS e FROM v_sites WHERE ref_len < 50 AND alt_len < 50),
n AS (SELECT sv.id, CAST(sum(CASE WHEN sm.e BETWEEN sv.s - 500 AND sv.s THEN 1 ELSE 0 END + CASE WHEN sm.s BETWEEN sv.e AND sv.e + 500 THEN 1 ELSE 0 END) AS BIGINT) AS n
  FROM sv JOIN sm ON sm.chrom = sv.chrom GROUP BY sv.id)
SELECT sv.id, coalesce(n.n, 0) AS n, CASE WHEN coalesce(n.n, 0) IN (0, 1, 2, 4, 6, 8) THEN CAST(coalesce(n.n, 0) AS VARCHAR) ELSE 'more' END AS bin FROM sv LEFT JOIN n ON n.id = sv.id"""))  # fmt: skip
def nearby_small(spark, d):
    s = view(spark, d, "v_sites").select(F.col("site_id").alias("id"), "chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("ref_len") - 1).alias("end"), "ref_len", "alt_len")
    small = "ref_len < 50 and alt_len < 50"
    n = I.nearby_small(s.where(f"not ({small})").drop("ref_len", "alt_len"), s.where(small), 500)
    return n.withColumn("bin", I.nearby_bin(F.col("n")))


@query("split_number", oracle("v_lines v_sites", """,
sv AS (SELECT site_id AS id, chrom, pos AS s, pos + ref_len - 1 AS e FROM v_sites WHERE ref_len >= 50 OR alt_len >= 50), sm AS (SELECT chrom, pos AS s, pos + ref_len - 1 AS e FROM v_sites WHERE ref_len < 50 AND alt_len < 50),
n AS (SELECT sv.id, CAST(sum(CASE WHEN sm.e BETWEEN sv.s - 500 AND sv.s THEN 1 ELSE 0 END + CASE WHEN sm.s BETWEEN sv.e AND sv.e + 500 THEN 1 ELSE 0 END) AS BIGINT) AS n FROM sv JOIN sm ON sm.chrom = sv.chrom GROUP BY sv.id)
SELECT CASE WHEN coalesce(n.n, 0) IN (0, 1, 2, 4, 6, 8) THEN CAST(coalesce(n.n, 0) AS VARCHAR) ELSE 'more' END AS neighbours, l.line FROM sv LEFT JOIN n ON n.id = sv.id JOIN v_lines l ON l.ord = sv.id"""))  # fmt: skip
def split_number(spark, d):
    """SVs of a VCF to one folder for each number of small variants nearby, these taken from a base VCF."""
    base = view(spark, d, "v_sites").select("chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("ref_len") - 1).alias("end"), "ref_len", "alt_len").where("ref_len < 50 and alt_len < 50")
    sv = view(spark, d, "v_sites").where("ref_len >= 50 or alt_len >= 50").select(F.col("site_id").alias("id"), "chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("ref_len") - 1).alias("end"))
    n = I.nearby_small(sv, base, 500).select("id", I.nearby_bin(F.col("n")).alias("neighbours"))
    path = T.shared_folder(spark)
    T.write_split(view(spark, d, "v_lines").join(n, F.col("ord") == F.col("id")), path, "neighbours")
    return spark.read.schema("value string, neighbours string").text(path).select("neighbours", F.col("value").alias("line"))


# --- the ensemble

_CUBE = f"""{_MATCHED}, {_SLOTS}, st AS (SELECT caller, avg(depth) AS mean, var_pop(depth) AS variance, stddev_pop(depth) AS sd FROM v_calls GROUP BY caller),
cb AS (SELECT site_id, sample_id, caller, coalesce(max(CASE WHEN hap = 0 THEN allele END), 0) AS x, coalesce(max(CASE WHEN hap = 1 THEN allele END), 0) AS y, CAST(sum(depth) AS DOUBLE) AS depth FROM lw GROUP BY site_id, sample_id, caller),
cube AS (SELECT cb.site_id, cb.sample_id, cb.caller, concat(CAST(x AS VARCHAR), '|', CAST(y AS VARCHAR)) AS gt, cb.depth, st.mean, (cb.depth - st.mean) / nullif(st.sd, 0) AS z,
  CASE WHEN y <> 0 THEN s.alt_len + y - 1 - s.ref_len WHEN x <> 0 THEN s.alt_len + x - 1 - s.ref_len ELSE 0 END AS sv_len
  FROM cb JOIN st ON st.caller = cb.caller JOIN v_sites s ON s.site_id = cb.site_id)"""
_VOTE = """{name} AS (SELECT site_id, sample_id, n, f, len, CASE WHEN mode = 'specific' THEN CASE WHEN f < 2 THEN near ELSE best END WHEN n < 2 THEN NULL
    WHEN abs(len) <= 49 THEN CASE WHEN f < 2 THEN NULL ELSE best END ELSE CASE WHEN f < 2 THEN near ELSE best END END AS chosen
  FROM (SELECT site_id, sample_id, '{mode}' AS mode, count(*) AS n, max(same) AS f, min(CASE WHEN same = top THEN caller END) AS best,
      max(CASE WHEN rk = 1 THEN caller END) AS near, arg_max(sv_len, caller) AS len
    FROM (SELECT *, max(same) OVER (PARTITION BY site_id, sample_id) AS top FROM (
      SELECT *, count(*) OVER (PARTITION BY site_id, sample_id, gt) AS same, row_number() OVER (PARTITION BY site_id, sample_id ORDER BY abs(z) NULLS LAST, caller) AS rk FROM {source}))
    GROUP BY site_id, sample_id))"""
_VOTED = _CUBE + ", " + _VOTE.format(name="vt", mode="all", source="cube")
_PAN = "pg AS (SELECT site_id, sample_id, CASE WHEN a1 < 0 THEN '0|0' ELSE concat(CAST(a1 AS VARCHAR), '|', CAST(a2 AS VARCHAR)) END AS gt FROM v_panel)"
_SIM = f"""{_VOTED}, {_PAN}, vg AS (SELECT vt.site_id, vt.sample_id, cube.gt FROM vt JOIN cube ON cube.site_id = vt.site_id AND cube.sample_id = vt.sample_id AND cube.caller = vt.chosen),
sm AS (SELECT sample_id, panel_sample, n FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, panel_sample) AS k FROM (
  SELECT vg.sample_id, pg.sample_id AS panel_sample, count(*) AS n FROM vg JOIN pg ON pg.site_id = vg.site_id AND pg.gt = vg.gt WHERE pg.gt <> '0|0' GROUP BY vg.sample_id, pg.sample_id)) WHERE k = 1)"""


def _cube(spark, d) -> DataFrame:
    return N.with_z(N.cube(_taken(spark, d), _lens(spark, d), SLOT), N.caller_depth(view(spark, d, "v_calls")))


def _panel_text(spark, d) -> DataFrame:
    text = F.when(F.exists("gt", lambda g: g.isNull()), "0|0").otherwise(F.array_join("gt", "|"))
    return panel(spark, d).select("site_id", F.col("sample_id").alias("panel_sample"), text.alias("gt"))


KEY = ("site_id", "sample_id")


@query("caller_depth", oracle("v_calls", "SELECT caller, round(avg(depth), 6) AS mean, round(var_pop(depth), 6) AS variance, round(stddev_pop(depth), 6) AS sd FROM v_calls GROUP BY caller"))
def caller_depth(spark, d):
    return N.caller_depth(view(spark, d, "v_calls")).select("caller", *[F.round(c, 6).alias(c) for c in ("mean", "variance", "sd")])


@query("depth_rank", oracle("v_calls v_sites", f"{_CUBE} SELECT site_id, sample_id, caller, row_number() OVER (PARTITION BY site_id, sample_id ORDER BY abs(z) NULLS LAST, caller) AS rank FROM cube"))
def depth_rank(spark, d):
    return N.depth_rank(_cube(spark, d), KEY).select(*KEY, "caller", F.col("rank").cast("long").alias("rank"))


@query("vote", oracle("v_calls v_sites", f"{_VOTED} SELECT vt.site_id, vt.sample_id, n, f, len, chosen, cube.gt FROM vt LEFT JOIN cube ON cube.site_id = vt.site_id AND cube.sample_id = vt.sample_id AND cube.caller = vt.chosen"))
def vote(spark, d):
    return N.vote(_cube(spark, d), KEY, len(CALLERS))


@query("merge_sites", oracle("v_calls v_lines", f"""{_VOTED} SELECT vt.site_id, vt.sample_id, concat_ws(chr(9), array_to_string(string_split(l.line, chr(9))[1:8], chr(9)), 'GT:SO:DP:ADP:NDP',
  concat_ws(':', replace(cube.gt, '|', '/'), cube.caller, substr(printf('%.6f', cube.z), 1, 5), substr(printf('%.6f', cube.mean), 1, 5), substr(printf('%.6f', cube.depth), 1, 5))) AS line
FROM vt JOIN cube ON cube.site_id = vt.site_id AND cube.sample_id = vt.sample_id AND cube.caller = vt.chosen JOIN v_lines l ON l.ord = vt.site_id"""))  # fmt: skip
def merge_sites(spark, d):
    """The whole merge: calls matched to sites, slots, vote, records."""
    c = written(_cube(spark, d))
    fixed = F.concat_ws("\t", F.slice(F.split("line", "\t"), 1, 8))
    base = view(spark, d, "v_lines").select(F.col("ord").alias("site_id"), fixed.alias("fixed"))
    return N.merged_lines(N.vote(c, KEY, len(CALLERS)), c, N.caller_depth(view(spark, d, "v_calls")), base, KEY)


@query("similar_sample", oracle("v_calls v_sites v_panel", f"{_SIM} SELECT sm.sample_id, panel_sample, n, round(n::DOUBLE / t.total, 6) AS share FROM sm JOIN (SELECT sample_id, count(*) AS total FROM vg GROUP BY sample_id) t ON t.sample_id = sm.sample_id"))
def similar_sample(spark, d):
    return N.similar_sample(N.vote(_cube(spark, d), KEY, len(CALLERS)), _panel_text(spark, d))


@query("high_conf", oracle("v_calls v_sites v_panel", f"{_SIM}, hs AS (SELECT cube.* FROM cube JOIN sm ON sm.sample_id = cube.sample_id JOIN pg ON pg.sample_id = sm.panel_sample AND pg.site_id = cube.site_id WHERE pg.gt <> '0|0'), " + _VOTE.format(name="hv", mode="specific", source="hs") + " SELECT site_id, sample_id, f, chosen FROM hv"))
def high_conf(spark, d):
    c, p = written(_cube(spark, d)), _panel_text(spark, d)
    similar = N.similar_sample(N.vote(c, KEY, len(CALLERS)), p)
    return N.high_conf(c, p, similar, KEY, len(CALLERS)).select(*KEY, "f", "chosen")


# --- ordered passes, windows, sorting


@query("check_sorted", oracle("v_sites", """SELECT site_id AS ord, chrom, pos, before FROM (SELECT *, lag(chrom) OVER (ORDER BY site_id) AS c, lag(pos) OVER (ORDER BY site_id) AS before
FROM (SELECT site_id, concat('chr', CAST(site_id // 50 AS VARCHAR)) AS chrom, pos FROM v_sites)) WHERE c = chrom AND pos < before"""))  # fmt: skip
def check_sorted(spark, d):
    s = view(spark, d, "v_sites").select(F.col("site_id").alias("ord"), F.concat(F.lit("chr"), F.floor(F.col("site_id") / 50).cast("string")).alias("chrom"), "pos")
    return S.check_sorted(s)


@query("nonoverlap_greedy", oracle("v_sites", """, r AS (SELECT site_id, chrom, pos, pos + ref_len - 1 AS e, row_number() OVER (PARTITION BY chrom ORDER BY pos, pos + ref_len - 1, site_id) AS k FROM v_sites),
w AS (WITH RECURSIVE x AS (SELECT site_id, chrom, pos, e, k, e AS last, true AS kept FROM r WHERE k = 1
  UNION ALL SELECT r.site_id, r.chrom, r.pos, r.e, r.k, CASE WHEN r.pos > x.last THEN r.e ELSE x.last END, r.pos > x.last FROM x JOIN r ON r.chrom = x.chrom AND r.k = x.k + 1)
  SELECT * FROM x)
SELECT site_id AS id, chrom, pos, e AS "end" FROM w WHERE kept"""))  # fmt: skip
def nonoverlap_greedy(spark, d):
    return S.nonoverlap_greedy(view(spark, d, "v_sites").select(F.col("site_id").alias("id"), "chrom", "pos", (F.col("pos") + F.col("ref_len") - 1).alias("end")))


@query("window_density", oracle("v_sites v_contigs", """, wn AS (SELECT chrom, unnest(generate_series(0, len - 1, 2500)) AS start FROM v_contigs)
SELECT wn.chrom, CAST(wn.start AS BIGINT) AS start, count(s.site_id) AS n, CAST(coalesce(sum(s.alt_len), 0) AS BIGINT) AS total, coalesce(string_agg(DISTINCT s.shape, ',' ORDER BY s.shape), '') AS types
FROM wn LEFT JOIN v_sites s ON s.chrom = wn.chrom AND s.pos >= wn.start AND s.pos < wn.start + 10000 GROUP BY wn.chrom, wn.start"""))  # fmt: skip
def window_density(spark, d):
    s = view(spark, d, "v_sites").select("chrom", "pos", F.col("alt_len").alias("length"), F.col("shape").alias("type"))
    return S.window_density(s, view(spark, d, "v_contigs").select("chrom", "len"), 10_000, 2_500, ("SNP", "sINS", "sDEL", "INS", "BIG"))


@query("window_groups", oracle("v_sites v_panel v_contigs", """, wn AS (SELECT chrom, unnest(generate_series(0, len - 1, 2500)) AS start FROM v_contigs),
g AS (SELECT p.chrom, p.pos, concat('n', CAST(u.s_nationkey AS VARCHAR)) AS grp FROM v_panel p JOIN supplier u ON u.s_suppkey = p.sample_id WHERE p.a1 > 0 OR p.a2 > 0),
c AS (SELECT wn.chrom, wn.start, grp, count(*) AS n FROM wn JOIN g ON g.chrom = wn.chrom AND g.pos >= wn.start AND g.pos < wn.start + 10000 GROUP BY wn.chrom, wn.start, grp),
k AS (SELECT chrom, start, sum(n) AS n, string_agg(concat(grp, ':', CAST(n AS VARCHAR)), ',' ORDER BY concat(grp, ':', CAST(n AS VARCHAR))) AS groups FROM c GROUP BY chrom, start)
SELECT wn.chrom, CAST(wn.start AS BIGINT) AS start, CAST(coalesce(k.n, 0) AS BIGINT) AS n, coalesce(groups, '') AS groups FROM wn LEFT JOIN k ON k.chrom = wn.chrom AND k.start = wn.start"""))  # fmt: skip
def window_groups(spark, d):
    groups = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("sample"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("grp"))
    return S.window_groups(panel(spark, d).withColumnRenamed("sample_id", "sample"), groups, view(spark, d, "v_contigs").select("chrom", "len"), 10_000, 2_500)


@query("sort_variants", oracle("v_sites", "SELECT site_id, chrom, pos FROM v_sites ORDER BY chrom, pos"))
def sort_variants(spark, d):
    return S.sort_variants(view(spark, d, "v_sites").select("site_id", "chrom", "pos"))


# --- reads

_FACTS = """fa AS (SELECT sample_name, CAST(sum(length(seq)) AS BIGINT) AS bases, count(*) AS reads FROM v_reads GROUP BY sample_name),
gn AS (SELECT CAST(sum(len) AS BIGINT) AS genome FROM v_contigs),
fx AS (SELECT fa.*, CAST(floor(bases / reads) AS BIGINT) AS read_length, gn.genome FROM fa CROSS JOIN gn)"""


def facts(spark, d) -> DataFrame:
    """Bases, reads, mean length and genome size of each sample of reads."""
    f = S.seq_count(view(spark, d, "v_reads"), ("sample_name",)).withColumnRenamed("mean_length", "read_length")
    genome = view(spark, d, "v_contigs").agg(F.sum("len").alias("genome"))
    return f.crossJoin(F.broadcast(genome))  # one row


@query("seq_count", oracle("v_reads", "SELECT sample_name, CAST(2 * sum(length(seq)) AS BIGINT) AS bases, 2 * count(*) AS reads, CAST(floor(sum(length(seq)) / count(*)) AS BIGINT) AS mean_length FROM v_reads GROUP BY sample_name"))
def seq_count(spark, d):
    return S.seq_count(view(spark, d, "v_reads").withColumn("mate", F.reverse("seq")), ("sample_name",), ("seq", "mate"))


@query("cohort_min", oracle("v_reads v_contigs", f", {_FACTS} SELECT round(min(bases::DOUBLE / genome), 9) AS depth, min(read_length) AS read_length FROM fx"))
def cohort_min(spark, d):
    f = facts(spark, d).withColumn("depth", F.round(F.col("bases") / F.col("genome"), 9))
    return S.cohort_min(f)


@query("depth_plan", oracle("v_reads v_contigs", f", {_FACTS} SELECT sample_name, round(least(bases::DOUBLE / genome, 0.1), 9) AS depth, round(genome * 0.1::DOUBLE / bases, 3) AS fraction, round(genome * 0.1::DOUBLE / bases, 3) < 1 AS sampled FROM fx"))
def depth_plan(spark, d):
    return C.depth_plan(facts(spark, d), 0.1).select("sample_name", F.round("depth", 9).alias("depth"), "fraction", "sampled")


@query("tool_select", oracle("v_reads v_contigs", f""", {_FACTS} SELECT sample_name, concat('Paragraph,BayesTyper,', CASE WHEN genome > 200 * 1024 * 1024 THEN 'VG-Giraffe' ELSE 'VG-MAP' END, ',',
CASE WHEN read_length > 130 AND bases::DOUBLE / genome > 0.2 THEN 'GraphTyper2' ELSE 'PanGenie' END) AS callers FROM fx"""))  # fmt: skip
def tool_select(spark, d):
    f = facts(spark, d)
    return f.select("sample_name", F.array_join(C.tool_select(F.col("read_length"), F.col("bases") / F.col("genome") * 25, F.col("genome")), ",").alias("callers"))


@query("batch_assign", "SELECT name, CAST(floor((row_number() OVER (ORDER BY name) - 1) / 5) AS BIGINT) AS batch FROM (SELECT concat('sample', CAST(s_suppkey AS VARCHAR)) AS name FROM supplier)")
def batch_assign(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet").select(F.concat(F.lit("sample"), F.col("s_suppkey").cast("string")).alias("name"))
    return S.batch_assign(s, 5)


def _hash(seed: int, idx: str = "idx") -> str:
    return f"CAST(concat('0x', substr(md5(concat(CAST({idx} AS VARCHAR), ':{seed}')), 1, 8)) AS BIGINT)"


@query("sample_frac", oracle("v_reads", f"SELECT idx, name FROM v_reads WHERE {_hash(11)} < {int(0.3 * 2**32)}"))
def sample_frac(spark, d):
    return S.sample_frac(view(spark, d, "v_reads"), 0.3).select("idx", "name")


@query("sample_n", oracle("v_reads", f"SELECT idx, name FROM v_reads ORDER BY {_hash(11)}, idx LIMIT 100"))
def sample_n(spark, d):
    return S.sample_n(view(spark, d, "v_reads"), 100).select("idx", "name")


@query("sample_exact", oracle("v_reads", f"SELECT idx, name FROM (SELECT *, row_number() OVER (ORDER BY {_hash(11)}, idx) AS k, count(*) OVER () AS n FROM v_reads) WHERE k <= floor(n * 0.37)"))
def sample_exact(spark, d):
    return S.sample_exact(view(spark, d, "v_reads"), 0.37).select("idx", "name")


@query("downsample", oracle("v_reads v_contigs", f", {_FACTS} SELECT r.idx, r.name FROM v_reads r JOIN fx ON fx.sample_name = r.sample_name WHERE round(genome * 0.1::DOUBLE / bases, 3) >= 1 OR {_hash(11, 'r.idx')} < floor(round(genome * 0.1::DOUBLE / bases, 3) * 4294967296)"))
def downsample(spark, d):
    return S.downsample(view(spark, d, "v_reads"), C.depth_plan(facts(spark, d), 0.1), "sample_name").select("idx", "name")


@query("union_units", oracle("v_sites", "SELECT site_id, chrom, pos FROM v_sites"))
def union_units(spark, d):
    s = view(spark, d, "v_sites").select("site_id", "chrom", "pos")
    return S.union_units([s.where(F.col("site_id") % 3 == k) for k in range(3)])


@query("union_mates", oracle("v_reads", "SELECT name, CAST(length(seq) AS BIGINT) AS len FROM v_reads UNION ALL SELECT concat(name, '/2'), CAST(length(seq) AS BIGINT) FROM v_reads"))
def union_mates(spark, d):
    r = view(spark, d, "v_reads").select("name", F.length("seq").cast("long").alias("len"))
    return S.union_units([r, r.withColumn("name", F.concat("name", F.lit("/2")))], ordered=False)
