"""Queries that run whole commands from files to files, each with its DuckDB oracle on what is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varspan.operators import flows
from varspan.operators.intervals import CHUNK, ref_lookup
from varspan.plans.record_queries import _SYMBOLIC, FIXED, sql_view
from varspan.plans.table_queries import _C, _HAPS, _T, _VOTED, CALLERS
from varspan.plans.views import VIEWS, contig_pieces, oracle, view
from varspan.sources import text as T

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return add


def _vcf(spark, lines: DataFrame, names: str) -> str:
    """Lines (ord, line) as a VCF file, gzip, sorted, with a header of the given samples."""
    p = F.split("line", "\t")
    head = spark.createDataFrame([(0, 0, "##fileformat=VCFv4.2"), (1, 0, "##contig=<ID=old,length=1>"), (2, 0, "\t".join([FIXED, names]))], "n int, ord long, line string")
    path = T.shared_folder(spark) + ".gz"
    T.write_vcf(head, lines.select("ord", "line", F.get(p, F.lit(0)).alias("chrom"), F.get(p, F.lit(1)).cast("long").alias("pos")), path)
    return path


def _fasta(spark, d) -> str:
    """The contigs as FASTA files, lines of 60 bases, one contig after another from pieces: no row holds a contig."""
    path = T.shared_folder(spark)
    pieces = contig_pieces(spark, d, 60 * 128).repartition("chrom").sortWithinPartitions("chrom", "piece")
    lines = F.regexp_replace(F.decode("bases", "UTF-8"), r"(.{60})(?=.)", "$1\n")
    pieces.select(F.when(F.col("piece") == 0, F.concat(F.lit(">"), F.col("chrom"), F.lit("\n"), lines)).otherwise(lines).alias("value")).write.text(path)
    return path


def _lines(spark, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"))


#: Lines of two samples, one position in seven with a second record, some on no contig, some with an ALT that no sample has.
_FOLLOWS = """
  SELECT a.*, substr(g.seq, CAST(a.pos + length(a.ref) AS INT), 1) AS follows FROM v_alleles a JOIN v_contigs g ON g.chrom = a.chrom WHERE a.site_id % 7 = 0 AND a.site_id % 13 <> 0 AND substr(a.ref, 1, 1) = substr(a.alt, 1, 1)"""
_TWO = f"""SELECT site_id AS ord, site_id, chrom, pos, ref, alt, CASE WHEN site_id % 13 = 0 THEN 'chrX' ELSE chrom END AS named, CASE WHEN site_id % 3 = 0 THEN '0/0' ELSE '0/1' END AS s1,
  CASE WHEN site_id % 4 = 0 THEN './.' ELSE '1/1' END AS s2, 0 AS second FROM v_alleles
UNION ALL SELECT site_id + 10000000000, site_id, chrom, pos, concat(ref, follows), concat(alt, 'GG'), chrom, '1/0', '0/1', 1 FROM ({_FOLLOWS}) x"""
_TWO_LINES = f"""SELECT ord, concat_ws(chr(9), named, CAST(pos AS VARCHAR(20)), concat('v', CAST(ord AS VARCHAR(20))), ref, alt, '.', 'PASS',
  concat('END=', CAST(pos + length(ref) - 1 AS VARCHAR(20))), 'GT', s1, s2) AS line FROM ({_TWO}) w"""


@query("convert_files", oracle("v_alleles v_contigs", f""",
w AS ({_TWO}),
x AS (SELECT w.*, substr(g.seq, CAST(w.pos - 1 AS INT), 1) AS base, substr(ref, 1, 1) <> substr(alt, 1, 1) AND (length(ref) > 1 OR length(alt) > 1) AS moved,
  replace(replace(s1, '/', '|'), '.', '0') AS g1, replace(replace(s2, '/', '|'), '.', '0') AS g2 FROM w JOIN v_contigs g ON g.chrom = w.chrom WHERE site_id % 13 <> 0 AND alt <> ref),
two AS (SELECT a.*, b.ref AS long_ref, b.alt AS more, substr(b.ref, length(a.ref) + 1, 1) AS follows FROM x a JOIN x b ON b.site_id = a.site_id AND b.second = 1 WHERE a.second = 0),
one AS (SELECT * FROM x WHERE second = 0 AND site_id NOT IN (SELECT site_id FROM two)),
o AS (SELECT chrom, CASE WHEN moved THEN pos - 1 ELSE pos END AS pos, ord, CASE WHEN moved THEN concat(base, ref) ELSE ref END AS ref, CASE WHEN moved THEN concat(base, alt) ELSE alt END AS alt, g1, g2,
    pos + length(ref) - 1 AS e, site_id % 3 = 0 AND site_id % 4 = 0 AS unused FROM one
  UNION ALL SELECT chrom, pos, ord, long_ref, CASE WHEN site_id % 12 = 0 THEN more WHEN g1 = '0|0' OR g2 = '0|0' THEN concat(alt, follows, ',', more) ELSE concat(alt, follows) END,
    CASE WHEN site_id % 12 = 0 THEN '1|0' WHEN g1 = '0|0' THEN '2|0' ELSE g1 END, CASE WHEN site_id % 12 = 0 THEN '0|1' WHEN g2 = '0|0' THEN '0|2' ELSE g2 END, pos + length(ref) - 1, false FROM two)
SELECT concat_ws(chr(9), chrom, CAST(pos AS VARCHAR), concat('v', CAST(ord AS VARCHAR)), ref, alt, '.', 'PASS', concat('END=', CAST(e AS VARCHAR)), 'GT', g1, g2) AS line FROM o WHERE NOT unused
UNION ALL SELECT '##fileformat=VCFv4.2' UNION ALL SELECT concat('##contig=<ID=', chrom, ',length=', CAST(length(seq) AS VARCHAR), '>') FROM v_contigs
UNION ALL SELECT concat_ws(chr(9), '{FIXED}', 's1', 's2')"""))  # fmt: skip
def convert_files(spark, d):
    """A VCF and a FASTA to a VCF fit for genotypers. The base after a REF is looked up in pieces: Spark's substr walks the contig up to it for each row."""
    some = sql_view(spark, d, "v_alleles", "SELECT * FROM v_alleles a WHERE a.site_id % 7 = 0 AND a.site_id % 13 <> 0 AND substr(a.ref, 1, 1) = substr(a.alt, 1, 1)")
    ref_lookup(some, contig_pieces(spark, d, CHUNK), F.col("pos") + F.length("ref"), F.lit(1), "follows").createOrReplaceTempView("v_follows")
    lines = sql_view(spark, d, "v_alleles", _TWO_LINES.replace(f"({_FOLLOWS})", "v_follows"))
    path = T.shared_folder(spark) + ".gz"
    flows.convert_files(spark, _vcf(spark, lines, "s1\ts2"), _fasta(spark, d), path)
    return _lines(spark, path)


_DELLY = f"""SELECT site_id AS ord, concat_ws(chr(9), chrom, CAST(pos AS VARCHAR(20)), concat('d', CAST(site_id AS VARCHAR(20))), 'N', alt, '.', filter, info, 'GT', '0/1') AS line FROM ({_SYMBOLIC}) w"""


@query("delly_files", oracle("v_alleles", f"""SELECT concat_ws(chr(9), chrom, CAST(pos AS VARCHAR), concat('d', CAST(site_id AS VARCHAR)), bases, CASE WHEN alt = '<DEL>' THEN substr(bases, 1, 1) WHEN alt = '<DUP>' THEN concat(bases, bases)
  ELSE reverse(bases) END, '.', filter, info, 'GT', '0/1') AS line FROM ({_SYMBOLIC}) WHERE filter = 'PASS' AND info <> 'PRECISE' AND alt IN ('<DEL>', '<DUP>', '<INV>', '[<INV>]')
UNION ALL SELECT '##fileformat=VCFv4.2' UNION ALL SELECT '##contig=<ID=old,length=1>' UNION ALL SELECT concat_ws(chr(9), '{FIXED}', 's1')"""))  # fmt: skip
def delly_files(spark, d):
    """Symbolic variants of a VCF with the bases of a FASTA."""
    path = T.shared_folder(spark)
    flows.delly_files(spark, _vcf(spark, sql_view(spark, d, "v_alleles", _DELLY), "s1"), _fasta(spark, d), path)
    return _lines(spark, path)


def _caller_vcfs(spark, d) -> dict[str, str]:
    """A VCF of two samples for each caller, gzip, sorted, all from one pass over the calls: they are sorted as numbers, and lines are made after that."""
    head = dict(enumerate(["##fileformat=VCFv4.2", "##contig=<ID=old,length=1>", "\t".join([FIXED, "s0\ts1"])], -3))
    heads = spark.createDataFrame([(k, c) for c in CALLERS for k in head], "call_id long, caller string")  # no chromosome: they come first
    calls = view(spark, d, "v_calls").unionByName(heads, allowMissingColumns=True)
    calls.orderBy("caller", "chrom", "pos", "call_id").createOrReplaceTempView("v_calls")
    value = F.substring_index("line", "\t", -1)
    both = [F.when(F.col("sample_id") == k, value).otherwise(F.regexp_replace(value, "^[^:]*", "0/0")) for k in (0, 1)]
    line = F.concat_ws("\t", F.substring_index("line", "\t", 9), *both)
    for k, text in head.items():
        line = F.when(F.col("ord") == k, text).otherwise(line)
    root = T.shared_folder(spark)
    spark.sql(VIEWS["v_call_lines"][2]).select("caller", line.alias("value")).write.partitionBy("caller").option("compression", "gzip").text(root)
    return {c: f"{root}/caller={c}" for c in CALLERS}


@query("merge_files", oracle("v_calls v_lines", f"""{_VOTED} SELECT concat('s', CAST(vt.sample_id AS VARCHAR)) AS sample, concat_ws(chr(9), array_to_string(string_split(l.line, chr(9))[1:8], chr(9)), 'GT:SO:DP:ADP:NDP',
  concat_ws(':', replace(cube.gt, '|', '/'), cube.caller, substr(printf('%.6f', cube.z), 1, 5), substr(printf('%.6f', cube.mean), 1, 5), substr(printf('%.6f', cube.depth), 1, 5))) AS line
FROM vt JOIN cube ON cube.site_id = vt.site_id AND cube.sample_id = vt.sample_id AND cube.caller = vt.chosen JOIN v_lines l ON l.ord = vt.site_id"""))  # fmt: skip
def merge_files(spark, d):
    """A base VCF and one VCF for each caller, merged for each of two samples: what the two files hold below their headers."""
    base = _vcf(spark, T.checkpointed(view(spark, d, "v_lines")), "p1\tp2")
    outs = {sample: T.shared_folder(spark) + ".gz" for sample in ("s0", "s1")}
    flows.merge_samples(spark, base, _caller_vcfs(spark, d), outs)
    rows = [_lines(spark, path).where("not startswith(line, '#')").select(F.lit(sample).alias("sample"), "line") for sample, path in outs.items()]
    return rows[0].unionByName(rows[1])


_ALL = f"""{_C}, {_T}, {_HAPS.replace("PARTITION BY caller, sample_id, site_id", "PARTITION BY site_id")},
o AS (SELECT c.call_id, CASE WHEN once.n_hap = 2 THEN 'genotype' WHEN once.n_hap = 1 THEN 'misgenotype' ELSE 'miscall' END AS outcome FROM c LEFT JOIN once ON once.call_id = c.call_id)"""


@query("evaluate_files", oracle("v_call_lines v_truth_lines v_truth", f""", {_ALL}
SELECT outcome AS part, line FROM o JOIN v_call_lines l ON l.ord = o.call_id UNION ALL SELECT 'failcall', line FROM v_truth_lines WHERE ord NOT IN (SELECT site_id FROM once)"""))  # fmt: skip
def evaluate_files(spark, d):
    """A VCF of calls against one of truth: the lines of each part."""
    path = T.shared_folder(spark)
    flows.evaluate_files(spark, _vcf(spark, view(spark, d, "v_truth_lines"), "t"), _vcf(spark, view(spark, d, "v_call_lines"), "s"), path, score="FORMAT.GQ", compressed=True)
    return spark.read.schema("value string, part string").text(f"{path}/records").select("part", F.col("value").alias("line"))


@query("evaluate_recall_roc", oracle("v_calls v_truth", f""", {_ALL},
oc AS (SELECT c.score, o.outcome, unnest(CASE WHEN c.sv_len = 0 THEN ['all', 'snp'] WHEN abs(c.sv_len) < 50 THEN ['all', 'indel'] WHEN c.sv_len <= -50 THEN ['all', 'del'] ELSE ['all', 'ins'] END) AS class FROM o JOIN c ON c.call_id = o.call_id),
tc AS (SELECT class, count(*) AS total FROM (SELECT unnest(CASE WHEN true_len = 0 THEN ['all', 'snp'] WHEN abs(true_len) < 50 THEN ['all', 'indel'] WHEN true_len <= -50 THEN ['all', 'del'] ELSE ['all', 'ins'] END) AS class FROM t) GROUP BY class),
g AS (SELECT class, score, sum(CASE WHEN outcome <> 'miscall' THEN 1 ELSE 0 END) AS tp1, count(*) AS n1 FROM oc GROUP BY ALL)
SELECT g.class, CAST(g.score AS DOUBLE) AS score, CAST(sum(tp1) OVER w AS BIGINT) AS tp, CAST(sum(n1) OVER w AS BIGINT) - CAST(sum(tp1) OVER w AS BIGINT) AS fp, coalesce(tc.total, 0) - CAST(sum(tp1) OVER w AS BIGINT) AS fn
FROM g LEFT JOIN tc ON tc.class = g.class WINDOW w AS (PARTITION BY g.class ORDER BY g.score DESC ROWS UNBOUNDED PRECEDING)"""))  # fmt: skip
def evaluate_recall_roc(spark, d):
    """The ROC table of a file against truth, with any match a hit."""
    path = T.shared_folder(spark)
    flows.evaluate_files(spark, _vcf(spark, view(spark, d, "v_truth_lines"), "t"), _vcf(spark, view(spark, d, "v_call_lines"), "s"), path, score="FORMAT.GQ", roc_by="recall", compressed=True)
    return spark.read.parquet(f"{path}/roc").select("class", "score", "tp", "fp", "fn")
