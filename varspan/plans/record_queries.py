"""Queries on VCF lines, files and sequences, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varspan.functions import variant as V
from varspan.operators import convert as C
from varspan.operators import sites as S
from varspan.operators.intervals import CHUNK
from varspan.plans.views import contig_pieces, ctes, oracle, register, view
from varspan.sources import text as T

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

FIXED = "\t".join(["#" + T.FIXED[0], *T.FIXED[1:]])
_HEAD = "concat('#CHROM', chr(9), 'POS', chr(9), 'ID', chr(9), 'REF', chr(9), 'ALT', chr(9), 'QUAL', chr(9), 'FILTER', chr(9), 'INFO', chr(9), 'FORMAT')"
#: Parsed lines, for oracles.
_REC = """rec AS (SELECT ord, p[1] AS chrom, CAST(p[2] AS BIGINT) AS pos, p[3] AS id, p[4] AS ref, string_split(p[5], ',') AS alts, p[6] AS qual,
  p[7] AS filter, p[8] AS info, p[9] AS format, p[10:] AS samples, length(p[4]) AS ref_len, CAST(p[2] AS BIGINT) + length(p[4]) - 1 AS ref_end
  FROM (SELECT ord, string_split(line, chr(9)) AS p FROM v_lines))"""
#: Panel genotypes with the sample's index.
_GT = "pan AS (SELECT site_id AS ord, a1, a2, CAST(row_number() OVER (PARTITION BY site_id ORDER BY sample_id) - 1 AS BIGINT) AS sample, CAST(count(*) OVER (PARTITION BY site_id) AS BIGINT) AS n_samples, sample_id FROM v_panel)"


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return add


def sql_view(spark: SparkSession, sf_dir: str, names: str, body: str) -> DataFrame:
    """A shared SQL text over the views, in Spark."""
    register(spark, sf_dir, *names.split())
    return spark.sql(f"WITH {ctes(*names.split(), dialect='spark')} {body}")


def recs(spark: SparkSession, d: str) -> DataFrame:
    return T.records(view(spark, d, "v_lines"))


def header(spark: SparkSession, d: str) -> DataFrame:
    """Header lines with the names of all samples, which are one line in any VCF file."""
    s = spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey")
    names = s.agg(F.array_sort(F.collect_list("s_suppkey")).alias("k")).select(F.concat_ws("\t", F.lit(FIXED), F.array_join(F.transform("k", lambda k: F.concat(F.lit("s"), k.cast("string"))), "\t")).alias("line"))
    rest = names.select(F.explode(F.array(F.lit("##fileformat=VCFv4.2"), F.lit("##contig=<ID=old,length=1>"))).alias("line"))
    return rest.unionByName(names)


# --- sources and sinks


@query("scan_vcf", oracle("v_lines v_sites", f""", {_REC}
SELECT chrom, pos, id, ref_len, ref_end, CASE WHEN qual = '.' THEN 0.0 ELSE CAST(qual AS DOUBLE) END AS qual, filter,
  CAST(len(alts) AS BIGINT) AS n_alts, CAST(len(samples) AS BIGINT) AS n_samples FROM rec"""))  # fmt: skip
def scan_vcf(spark, d):
    path = T.shared_folder(spark) + ".gz"
    T.write_lines(T.vcf_line(recs(spark, d)), path, header=["##fileformat=VCFv4.2", FIXED])
    r = T.scan_vcf(spark, path)
    return r.select("chrom", "pos", "id", "ref_len", "ref_end", "qual", "filter", F.size("alts").cast("long").alias("n_alts"), F.size("samples").cast("long").alias("n_samples"))


_NAMES = "SELECT CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS BIGINT) AS idx, concat('s', CAST(s_suppkey AS VARCHAR)) AS sample FROM supplier"


@query("scan_vcf_header", _NAMES)
def scan_vcf_header(spark, d):
    lines = header(spark, d).unionByName(view(spark, d, "v_lines").select("line"))
    return T.header_samples(lines).select(F.col("idx").cast("long").alias("idx"), "sample")


_PIECE = 1000


@query("scan_fasta", oracle("v_contigs", f"""SELECT chrom AS name, k AS piece, length(part) AS len, md5(part) AS seq_md5 FROM (
  SELECT chrom, k, substr(seq, CAST(k * {_PIECE} + 1 AS INT), {_PIECE}) AS part FROM (SELECT chrom, seq, unnest(range(CAST(ceil(length(seq) / {_PIECE}.0) AS BIGINT))) AS k FROM v_contigs))"""))  # fmt: skip
def scan_fasta(spark, d):
    path = T.shared_folder(spark)
    T.write_fasta(view(spark, d, "v_contigs").select(F.col("chrom").alias("name"), "seq"), path, 60)
    p = T.scan_contigs(spark, path, _PIECE)
    return p.select(F.col("chrom").alias("name"), "piece", F.length("bases").cast("long").alias("len"), F.md5("bases").alias("seq_md5"))


@query("scan_fastq", oracle("v_reads", "SELECT name, md5(seq) AS seq_md5, CAST(length(seq) AS BIGINT) AS seq_len, CAST(length(seq) AS BIGINT) AS qual_len, CAST(length(seq) AS BIGINT) AS mate_len FROM v_reads"))
def scan_fastq(spark, d):
    path, mates, reads = T.shared_folder(spark), T.shared_folder(spark), view(spark, d, "v_reads")
    n = reads.count()
    # files of a few thousand reads; both writes take the same splits in the same order, so a read and its mate are in files of one rank
    put = lambda name, seq, to: reads.select(T.fastq_record(name, seq).alias("value")).write.option("maxRecordsPerFile", n // (8 + n // 10_000) + 1).option("compression", "gzip").text(to)
    put(F.col("name"), F.col("seq"), path)
    put(F.concat("name", F.lit("/2")), F.reverse("seq"), mates)
    n = lambda c: F.length(c).cast("long")
    return T.scan_fastq(spark, path, mates).select("name", F.md5("seq").alias("seq_md5"), n("seq").alias("seq_len"), n("qual").alias("qual_len"), n("seq2").alias("mate_len"))


@query("scan_sample_sheet", """SELECT concat('sample', CAST(s_suppkey AS VARCHAR)) AS name, concat('/reads/', CAST(s_suppkey AS VARCHAR), '.1.fq') AS read1,
  CASE WHEN s_suppkey % 2 = 0 THEN concat('/reads/', CAST(s_suppkey AS VARCHAR), '.2.fq') END AS read2 FROM supplier""")  # fmt: skip
def scan_sample_sheet(spark, d):
    k = F.col("s_suppkey").cast("string")
    body = spark.read.parquet(f"{d}/supplier.parquet").select(F.concat(F.lit("sample"), k, F.lit("\t/reads/"), k, F.lit(".1.fq"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("  /reads/"), k, F.lit(".2.fq "))).otherwise("")).alias("value"))
    extra = body.limit(1).select(F.explode(F.array(F.lit("name read1_path read2_path"), F.lit("# a comment"), F.lit("  "))).alias("value"))
    path = T.shared_folder(spark)
    body.unionByName(extra).write.text(path)
    return T.scan_sample_sheet(spark, path)


@query("scan_intervals", oracle("v_contigs", "SELECT chrom, CAST(len AS BIGINT) AS length FROM v_contigs"))
def scan_intervals(spark, d):
    path = T.shared_folder(spark)
    view(spark, d, "v_contigs").select("chrom", "len").write.csv(path, sep="\t")
    return T.scan_intervals(spark, path)


@query("write_vcf", oracle("v_lines", f""", {_REC}
SELECT concat_ws(chr(9), chrom, CAST(pos AS VARCHAR), id, ref, array_to_string(alts, ','), qual,
  filter, info, format, array_to_string(samples, chr(9))) AS line FROM rec
UNION ALL SELECT '##fileformat=VCFv4.2' UNION ALL SELECT {_HEAD}"""))  # fmt: skip
def write_vcf(spark, d):
    path = T.shared_folder(spark)
    T.write_lines(T.vcf_line(recs(spark, d)), path, header=["##fileformat=VCFv4.2", FIXED])
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("write_split", oracle("v_lines v_sites", "SELECT s.shape, count(*) AS n, CAST(sum(length(l.line)) AS BIGINT) AS characters FROM v_lines l JOIN v_sites s ON s.site_id = l.ord GROUP BY s.shape"))
def write_split(spark, d):
    path = T.shared_folder(spark)
    sites = view(spark, d, "v_sites").select("site_id", "shape")
    T.write_split(view(spark, d, "v_lines").join(sites, F.col("ord") == F.col("site_id")), path, "shape")
    return spark.read.text(path).groupBy("shape").agg(F.count("*").alias("n"), F.sum(F.length("value")).alias("characters"))


@query("write_fasta_oneline", oracle("v_contigs", "SELECT md5(seq) AS seq_md5, CAST(length(seq) AS BIGINT) AS len FROM v_contigs"))
def write_fasta_oneline(spark, d):
    path = T.shared_folder(spark)
    T.write_fasta(view(spark, d, "v_contigs").select(F.col("chrom").alias("name"), "seq"), path)
    return spark.read.text(path).where("not startswith(value, '>')").select(F.md5("value").alias("seq_md5"), F.length("value").cast("long").alias("len"))


@query("contig_header", oracle("v_contigs", f"""SELECT CAST(0 AS BIGINT) AS n, '##fileformat=VCFv4.2' AS line UNION ALL
SELECT 1, concat('##contig=<ID=', chrom, ',length=', CAST(len AS VARCHAR), '>') FROM v_contigs UNION ALL
SELECT 2, concat_ws(chr(9), {_HEAD}, string_agg(concat('s', CAST(s_suppkey AS VARCHAR)), chr(9) ORDER BY s_suppkey)) FROM supplier"""))  # fmt: skip
def contig_header(spark, d):
    return T.contig_header(header(spark, d), view(spark, d, "v_contigs")).select(F.col("n").cast("long").alias("n"), "line")


# The FORMAT lines of a merged file, as the oracle has them.
_MERGE_LINES = (
    '##FORMAT=<ID=SO,Number=1,Type=String,Description="Software">',
    '##FORMAT=<ID=DP,Number=1,Type=Float,Description="Total filtered read depth used for genotyping.">',
    '##FORMAT=<ID=ADP,Number=1,Type=Float,Description="Average depth">',
    '##FORMAT=<ID=NDP,Number=1,Type=Float,Description="Depth after z-score normalization">',
)


@query("merge_header", "SELECT CAST(0 AS BIGINT) AS n, '##fileformat=VCFv4.2' AS line UNION ALL SELECT 0, '##contig=<ID=old,length=1>' UNION ALL " + " UNION ALL ".join(f"SELECT 1, '{x}'" for x in _MERGE_LINES) + f" UNION ALL SELECT 2, concat_ws(chr(9), {_HEAD}, 's3') WHERE (SELECT count(*) FROM supplier WHERE s_suppkey = 3) > 0")
def merge_header(spark, d):
    return T.merge_header(header(spark, d), "s3").select(F.col("n").cast("long").alias("n"), "line")


# --- genotypes and fields


@query("gt_parse", oracle("v_panel", f""", {_GT}
SELECT ord, sample, CASE WHEN a1 < 0 THEN '0,0' ELSE concat(CAST(a1 AS VARCHAR), ',', CAST(a2 AS VARCHAR)) END AS gt, CAST(CASE WHEN a1 < 0 THEN 2 ELSE 0 END AS BIGINT) AS n_missing FROM pan"""))  # fmt: skip
def gt_parse(spark, d):
    r = recs(spark, d).select("ord", "format", F.posexplode("samples").alias("sample", "s"))
    return r.select("ord", F.col("sample").cast("long").alias("sample"), V.gt_parse(F.col("format"), F.col("s")).alias("g")).select("ord", "sample", F.array_join("g.gt", ",").alias("gt"), F.col("g.missing").alias("n_missing"))


@query("gt_phase_all", oracle("v_panel", f""", {_GT}
SELECT ord, string_agg(CASE WHEN a1 < 0 THEN '0|0' ELSE concat(CAST(a1 AS VARCHAR), '|', CAST(a2 AS VARCHAR)) END, ',' ORDER BY sample) AS gts FROM pan GROUP BY ord"""))  # fmt: skip
def gt_phase_all(spark, d):
    return recs(spark, d).select("ord", F.array_join(F.transform("samples", lambda s: V.gt_phase(V.field(F.col("format"), s, "GT"))), ",").alias("gts"))


@query("gt_sample_merge", oracle("v_panel", f""", {_GT}
SELECT ord, CASE WHEN a1 < 0 THEN '0,0' ELSE concat(CAST(a1 AS VARCHAR), ',', CAST(a2 AS VARCHAR)) END AS gt FROM pan WHERE sample = 3"""))  # fmt: skip
def gt_sample_merge(spark, d):
    return recs(spark, d).where(F.size("samples") > 3).select("ord", F.array_join(V.gt_strict(F.col("format"), F.get("samples", F.lit(3))), ",").alias("gt"))


@query("gt_sample_eval", oracle("v_panel", f""", {_GT}
SELECT ord, CASE WHEN a1 < 0 THEN '0,0' ELSE concat(CAST(a1 AS VARCHAR), ',', CAST(a2 AS VARCHAR)) END AS gt FROM pan WHERE sample = n_samples - 1"""))  # fmt: skip
def gt_sample_eval(spark, d):
    return recs(spark, d).select("ord", F.array_join(V.gt_parse(F.col("format"), F.element_at("samples", -1))["gt"], ",").alias("gt"))


@query("depth_extract", oracle("v_panel", f""", {_GT}
SELECT ord, sample, CAST((ord + sample_id * 3) % 40 AS DOUBLE) AS depth_sum, CAST(1 AS BIGINT) AS n_depths FROM pan"""))  # fmt: skip
def depth_extract(spark, d):
    r = recs(spark, d).select("ord", "format", F.posexplode("samples").alias("sample", "s")).withColumn("dp", V.depths(F.col("format"), F.col("s")))
    return r.select("ord", F.col("sample").cast("long").alias("sample"), F.aggregate("dp", F.lit(0.0), lambda a, x: a + x).alias("depth_sum"), F.size("dp").cast("long").alias("n_depths"))


@query("score_extract", oracle("v_sites v_panel", f""", {_GT}
SELECT ord, CAST((ord + sample_id * 3) % 40 AS DOUBLE) AS dp_score, CAST(s.pos + s.ref_len - 1 AS DOUBLE) AS end_score, 0.0::DOUBLE AS no_score
FROM pan JOIN v_sites s ON s.site_id = pan.ord WHERE sample = n_samples - 1"""))  # fmt: skip
def score_extract(spark, d):
    last = F.element_at("samples", -1)
    of = lambda key: V.score(F.col("info"), F.col("format"), last, key)
    return recs(spark, d).select("ord", of("FORMAT.DP").alias("dp_score"), of("INFO.END").alias("end_score"), of("INFO.GQ").alias("no_score"))


# --- lengths and types: alt_lens of a site are its ALT length, and one more for a second ALT


def sites(spark, d) -> DataFrame:
    s = view(spark, d, "v_sites")
    return s.withColumn("alt_lens", F.when(F.col("n_alts") == 2, F.array("alt_len", F.col("alt_len") + 1)).otherwise(F.array("alt_len")))


def _type(ref: str, qry: str) -> str:
    return f"""CASE WHEN {ref} = 1 AND {qry} = 1 THEN 'SNP' WHEN abs({qry} - {ref}) <= 49 AND {ref} <= 49 AND {qry} <= 49 THEN 'InDel'
  WHEN abs({qry} - {ref}) <= 2 AND {ref} > 49 AND {qry} > 49 THEN 'Inversion'
  WHEN {qry} * 1.0 / {ref} BETWEEN 1.8 AND 2.2 AND {ref} > 49 AND {qry} > 49 THEN 'Duplication'
  WHEN {qry} < {ref} THEN 'Deletion' WHEN {qry} > {ref} THEN 'Insertion' ELSE 'Other' END"""


_ALLELES = f"""al AS (SELECT site_id, chrom, pos, ref_len, n_alts, a AS allele, alt_len + a AS qry, {_type('ref_len', '(alt_len + a)')} AS type
  FROM v_sites, (SELECT unnest([0, 1]) AS a) WHERE a < n_alts)"""


@query("variant_type_site", oracle("v_sites", f"SELECT site_id, {_type('ref_len', '(alt_len + n_alts - 1)')} AS type FROM v_sites"))
def variant_type_site(spark, d):
    return S.variant_type_site(sites(spark, d)).select("site_id", "type")


@query("variant_type_allele", oracle("v_sites", f", {_ALLELES} SELECT site_id, CAST(allele AS BIGINT) AS allele, type, n_alts > 1 AS multi FROM al"))
def variant_type_allele(spark, d):
    return S.variant_type_allele(sites(spark, d)).select("site_id", F.col("allele").cast("long").alias("allele"), "type", "multi")


@query("count_types", oracle("v_sites", f""", {_ALLELES} SELECT type, count(*) AS n, CAST(sum(CASE WHEN n_alts = 1 THEN 1 ELSE 0 END) AS BIGINT) AS biallelic,
CAST(sum(CASE WHEN n_alts > 1 THEN 1 ELSE 0 END) AS BIGINT) AS multiallelic FROM al GROUP BY type"""))  # fmt: skip
def count_types(spark, d):
    return S.count_types(sites(spark, d))


def _dim(edges: tuple[int, ...]) -> str:
    return "(VALUES " + ", ".join(f"({k}, {lo}, {hi})" for k, lo, hi in V.bins(edges)) + ") b(bin, lo, hi)"


@query("length_hist", oracle("v_sites", f""", {_ALLELES},
x AS (SELECT CASE WHEN type = 'Inversion' THEN 'inversion' WHEN type = 'Duplication' THEN 'duplication' ELSE 'sv' END AS family,
  CASE WHEN type = 'Inversion' THEN qry ELSE qry - ref_len END AS v FROM al)
SELECT f.family, CAST(b.bin AS BIGINT) AS bin, CAST(b.lo AS BIGINT) AS lo, CAST(b.hi AS BIGINT) AS hi, count(x.v) AS n, CAST(abs(coalesce(sum(x.v), 0)) AS BIGINT) AS total
FROM (VALUES ('sv'), ('inversion'), ('duplication')) f(family) CROSS JOIN {_dim(V.COUNT_EDGES)} LEFT JOIN x ON x.family = f.family AND x.v BETWEEN b.lo AND b.hi
GROUP BY f.family, b.bin, b.lo, b.hi"""))  # fmt: skip
def length_hist(spark, d):
    return S.length_hist(sites(spark, d)).withColumn("bin", F.col("bin").cast("long"))


#: Text alleles, some symbolic or named Duplication, with a genotype, for both engines.
_HAP = """SELECT site_id, CASE WHEN site_id % 11 = 0 THEN 'Duplication' ELSE concat('v', CAST(site_id AS VARCHAR(20))) END AS id, ref,
  CASE site_id % 13 WHEN 1 THEN '<INS:SVSIZE=97:BREAKPOINT1>' WHEN 2 THEN '<DEL:SVSIZE=1720:BREAKPOINT>' WHEN 3 THEN '<DUP:SVSIZE=2806:COVERAGE>' WHEN 4 THEN '<INS>' ELSE alt END AS alt,
  site_id % 2 AS g0, CASE WHEN site_id % 7 = 0 THEN 0 ELSE 1 END AS g1 FROM v_alleles"""
_HAP_LENS = f"""h AS ({_HAP}), h1 AS (SELECT *, length(ref) AS n, CASE WHEN alt LIKE '%SVSIZE=%' THEN CAST(regexp_extract(alt, 'SVSIZE=([0-9]+)', 1) AS BIGINT) END AS z FROM h),
h2 AS (SELECT *, CASE WHEN z IS NOT NULL AND (alt LIKE '<DEL%' OR alt LIKE '<DUP%') THEN z ELSE n END AS r0,
  CASE WHEN z IS NOT NULL AND alt LIKE '<INS%' THEN z WHEN z IS NOT NULL AND alt LIKE '<DEL%' THEN n WHEN z IS NOT NULL THEN 2 * z ELSE length(alt) END AS q0 FROM h1),
h3 AS (SELECT *, CASE WHEN id = 'Duplication' AND r0 <= 2 THEN q0 ELSE r0 END AS r, CASE WHEN id = 'Duplication' AND r0 <= 2 THEN 2 * q0 ELSE q0 END AS q FROM h2),
hl AS (SELECT *, CASE WHEN g0 = 0 THEN r ELSE q END AS l0, CASE WHEN g1 = 0 THEN r ELSE q END AS l1 FROM h3)"""


def _haps(spark, d) -> DataFrame:
    h = sql_view(spark, d, "v_alleles", _HAP)
    h = h.withColumns({"l": V.allele_lengths(F.col("id"), F.col("ref"), F.split("alt", ",")), "gt": F.array(F.col("g0").cast("int"), F.col("g1").cast("int"))})
    return h.withColumn("hap", V.hap_lengths(F.col("l"), F.col("gt")))


@query("hap_len", oracle("v_alleles", f", {_HAP_LENS} SELECT site_id, CAST(r AS BIGINT) AS ref_len, CAST(l0 AS BIGINT) AS hap0, CAST(l1 AS BIGINT) AS hap1 FROM hl"))
def hap_len(spark, d):
    return _haps(spark, d).select("site_id", F.col("l.ref_len").alias("ref_len"), F.get("hap", F.lit(0)).alias("hap0"), F.get("hap", F.lit(1)).alias("hap1"))


@query("sv_length", oracle("v_alleles", f", {_HAP_LENS} SELECT site_id, CAST(CASE WHEN g1 <> 0 THEN l1 - r WHEN g0 <> 0 THEN l0 - r ELSE 0 END AS BIGINT) AS sv_len FROM hl"))
def sv_length(spark, d):
    return _haps(spark, d).select("site_id", V.sv_length(F.col("l.ref_len"), F.col("hap"), F.col("gt")).alias("sv_len"))


@query("split_len", oracle("v_lines v_panel", f""", {_REC}, {_GT}
SELECT rec.ord, CAST(ref_len AS BIGINT) AS ref_len, CAST(length(alts[greatest(a1, a2)]) AS BIGINT) AS qry_len FROM rec JOIN pan ON pan.ord = rec.ord AND sample = n_samples - 1
WHERE filter = 'PASS' AND a1 >= 0 AND a1 + a2 > 0"""))  # fmt: skip
def split_len(spark, d):
    r = C.filter_pass(recs(spark, d)).withColumn("gt", V.gt_parse(F.col("format"), F.element_at("samples", -1))["gt"])
    r = C.filter_nonref(r).withColumn("l", V.allele_lengths(F.col("id"), F.col("ref"), F.array(F.get("alts", F.array_max("gt") - 1))))
    return r.select("ord", F.col("l.ref_len").alias("ref_len"), F.get("l.lens", F.lit(0)).alias("qry_len"))


# --- conversion


@query("breakpoint_shift", oracle("v_lines", f""", {_REC}
SELECT ord, greatest(pos - 1, 1) AS pos, regexp_replace(info, 'END=[0-9]+', concat('END=', CAST(greatest(pos - 1, 1) + ref_len - 1 AS VARCHAR))) AS info FROM rec"""))  # fmt: skip
def breakpoint_shift(spark, d):
    return C.breakpoint_shift(recs(spark, d)).select("ord", "pos", "info")


@query("fix_info", oracle("v_lines", f", {_REC} SELECT ord, concat('END=', CAST(ref_end AS VARCHAR)) AS info FROM rec"))
def fix_info(spark, d):
    return C.fix_info(recs(spark, d)).select("ord", "info")


_BAD = """SELECT ord, CASE WHEN ord % 13 = 0 THEN regexp_replace(line, '^chr[0-9]', 'chrX') WHEN ord % 17 = 0 THEN regexp_replace(line, 'GT:DP', 'DP')
  WHEN ord % 19 = 0 THEN replace(line, '0/1:', '0/3:') ELSE line END AS line FROM v_lines"""


@query("drop_bad_rows", oracle("v_lines v_panel v_sites v_contigs", """
SELECT s.site_id AS ord, CASE WHEN s.site_id % 13 <> 0 AND s.site_id % 17 = 0 THEN 'no_gt' WHEN s.site_id % 13 = 0 THEN 'unknown_chrom'
  WHEN s.pos < 350 THEN 'near_start' WHEN s.pos + s.ref_len - 1 >= g.len THEN 'beyond_end'
  WHEN s.site_id % 19 = 0 AND EXISTS (SELECT 1 FROM v_panel p WHERE p.site_id = s.site_id AND p.a1 = 0 AND p.a2 = 1 AND p.sample_id % 2 = 0) THEN 'gt_index' END AS reject_reason
FROM v_sites s JOIN v_contigs g ON g.chrom = s.chrom JOIN (SELECT DISTINCT site_id FROM v_panel) k ON k.site_id = s.site_id"""))  # fmt: skip
def drop_bad_rows(spark, d):
    return C.reject_reason(T.records(sql_view(spark, d, "v_lines", _BAD)), view(spark, d, "v_contigs")).select("ord", "reject_reason")


_WRONG = """SELECT site_id, chrom, pos, CASE WHEN site_id % 9 = 0 THEN concat('A', substr(ref, 2, length(ref))) ELSE ref END AS ref FROM v_alleles"""


@query("fix_ref", oracle("v_alleles", f"SELECT w.site_id, a.ref, w.ref <> a.ref AS changed FROM ({_WRONG}) w JOIN v_alleles a ON a.site_id = w.site_id"))
def fix_ref(spark, d):
    return C.fix_ref(sql_view(spark, d, "v_alleles", _WRONG), contig_pieces(spark, d, CHUNK)).select("site_id", "ref", "changed")


@query("ref_lookup", oracle("v_sites v_contigs", "SELECT s.site_id, substr(g.seq, CAST(s.pos - 5 AS INT), CAST(s.ref_len + 10 AS INT)) AS bases FROM v_sites s JOIN v_contigs g ON g.chrom = s.chrom"))
def ref_lookup(spark, d):
    s = view(spark, d, "v_sites").select("site_id", "chrom", "pos", "ref_len")
    return C.ref_lookup(s, contig_pieces(spark, d, CHUNK), F.col("pos") - 5, F.col("ref_len") + 10, "bases").select("site_id", "bases")


_ANCHOR = "SELECT site_id, chrom, pos, ref, CASE WHEN shape = 'INS' AND site_id % 4 = 0 THEN concat('N', alt, 'R') WHEN shape = 'sDEL' AND site_id % 4 = 1 THEN ref ELSE alt END AS alt FROM v_alleles"
_ANCHORED = f"""an AS (SELECT i.*, substr(g.seq, CAST(i.pos - 1 AS INT), 1) AS base, substr(i.ref, 1, 1) <> substr(i.alt, 1, 1) AND (length(i.ref) > 1 OR length(i.alt) > 1) AS moved
  FROM ({_ANCHOR}) i JOIN v_contigs g ON g.chrom = i.chrom),
ac AS (SELECT site_id, chrom, CASE WHEN moved THEN pos - 1 ELSE pos END AS pos, CASE WHEN moved THEN concat(base, ref) ELSE ref END AS ref, CASE WHEN moved THEN concat(base, alt) ELSE alt END AS alt
  FROM an WHERE ref <> alt AND NOT regexp_matches(alt, '[^ATGCNatgcn]'))"""


def _anchored(spark, d) -> DataFrame:
    rows = sql_view(spark, d, "v_alleles", _ANCHOR).withColumn("alts", F.array("alt"))
    return C.anchor_alleles(rows, contig_pieces(spark, d, CHUNK))


@query("anchor_alleles", oracle("v_alleles v_contigs", f", {_ANCHORED} SELECT site_id, pos, ref, alt FROM ac"))
def anchor_alleles(spark, d):
    return _anchored(spark, d).select("site_id", "pos", "ref", F.get("alts", F.lit(0)).alias("alt"))


@query("local_reorder", oracle("v_alleles v_contigs", f", {_ANCHORED} SELECT site_id, chrom, pos, row_number() OVER (PARTITION BY chrom ORDER BY pos, site_id) AS place FROM ac"))
def local_reorder(spark, d):
    return S.sort_variants(S.places(_anchored(spark, d).select("site_id", "chrom", "pos"))).select("site_id", "chrom", "pos", "place")


_DUPS = "SELECT site_id, CASE WHEN site_id % 5 = 0 THEN concat(alt, ',', alt) ELSE concat(alt, ',', alt, 'T') END AS alt FROM v_alleles"


@query("drop_dup_alleles", oracle("v_alleles", "SELECT site_id, concat(alt, ',', alt, 'T') AS alt FROM v_alleles WHERE site_id % 5 <> 0"))
def drop_dup_alleles(spark, d):
    rows = sql_view(spark, d, "v_alleles", _DUPS).withColumn("alts", F.split("alt", ","))
    return C.drop_dup_alleles(rows).select("site_id", "alt")


@query("gt_diploid", oracle("v_panel", f""", {_GT}
SELECT ord, sample, CASE WHEN ord % 6 = 0 THEN '0|0' WHEN ord % 6 = 1 THEN '1|0' WHEN ord % 6 = 2 THEN '0|1' WHEN a1 < 0 THEN '0|0' ELSE concat(CAST(a1 AS VARCHAR), '|', CAST(a2 AS VARCHAR)) END AS gt FROM pan"""))  # fmt: skip
def gt_diploid(spark, d):
    r = recs(spark, d).select("ord", "format", F.posexplode("samples").alias("sample", "s"))
    raw = F.when(F.col("ord") % 6 == 0, ".").when(F.col("ord") % 6 == 1, "1").when(F.col("ord") % 6 == 2, "0/1/2").otherwise(V.field(F.col("format"), F.col("s"), "GT"))
    return r.select("ord", F.col("sample").cast("long").alias("sample"), V.gt_diploid(raw).alias("gt"))


@query("trim_alleles", oracle("v_alleles v_panel", """
SELECT a.site_id AS ord, CASE WHEN p.top > 0 THEN a.alt ELSE '' END AS alts, p.gts FROM v_alleles a JOIN (
  SELECT site_id, max(greatest(a1, a2)) AS top, string_agg(concat(CAST(greatest(a1, 0) AS VARCHAR), '|', CAST(greatest(a2, 0) AS VARCHAR)), ',' ORDER BY sample_id) AS gts
  FROM v_panel GROUP BY site_id) p ON p.site_id = a.site_id"""))  # fmt: skip
def trim_alleles(spark, d):
    r = recs(spark, d).withColumn("gts", F.transform("samples", lambda s: V.gt_parse(F.col("format"), s)["gt"]))
    t = C.trim_alleles(r)
    return t.select("ord", F.array_join("alts", ",").alias("alts"), F.array_join(F.transform("gts", lambda g: F.array_join(g, "|")), ",").alias("gts"))


@query("clean_sequence", oracle("v_contigs", "SELECT chrom, md5(concat(seq, 'NANN', seq)) AS seq_md5 FROM v_contigs"))
def clean_sequence(spark, d):
    c = view(spark, d, "v_contigs").withColumn("seq", F.concat(F.lower("seq"), F.lit("RaY-"), F.col("seq")))
    return c.select("chrom", F.md5(V.clean_sequence(F.col("seq"))).alias("seq_md5"))


@query("sv_only", oracle("v_sites", "SELECT site_id FROM v_sites WHERE ref_len >= 50 OR alt_len >= 50"))
def sv_only(spark, d):
    return C.sv_only(view(spark, d, "v_sites")).select("site_id")


_SYMBOLIC = """SELECT site_id, chrom, pos, CASE WHEN shape = 'INS' THEN '<INS>' WHEN shape = 'sDEL' THEN '<DEL>' WHEN shape = 'SNP' THEN '[<INV>]' WHEN site_id % 3 = 0 THEN '<INV>' WHEN site_id % 3 = 1 THEN '<DUP>' ELSE ']chr1:5]' END AS alt,
  CASE WHEN site_id % 8 = 7 THEN 'LOWQ' ELSE 'PASS' END AS filter, CASE WHEN site_id % 10 = 4 THEN 'PRECISE' ELSE concat('SVTYPE=X;END=', CAST(pos + length(ref) - 1 AS VARCHAR(20))) END AS info, ref AS bases FROM v_alleles"""


@query("symbolic_expand", oracle("v_alleles", f"""SELECT site_id, bases AS ref, CASE WHEN alt = '<DEL>' THEN substr(bases, 1, 1) WHEN alt = '<DUP>' THEN concat(bases, bases) ELSE reverse(bases) END AS alt
FROM ({_SYMBOLIC}) WHERE filter = 'PASS' AND info <> 'PRECISE' AND alt IN ('<DEL>', '<DUP>', '<INV>', '[<INV>]')"""))  # fmt: skip
def symbolic_expand(spark, d):
    rows = sql_view(spark, d, "v_alleles", _SYMBOLIC).drop("bases")
    return C.symbolic_expand(rows, contig_pieces(spark, d, CHUNK)).select("site_id", "ref", "alt")


_LOCI = """SELECT /*+ MERGE(a, g) */ a.site_id AS ord, a.chrom, a.pos, a.ref, a.alt, g.gts FROM v_alleles a JOIN v_genotypes g ON g.site_id = a.site_id"""
_LOCI2 = f"""SELECT * FROM ({_LOCI}) x UNION ALL SELECT /*+ MERGE(a, g) */ a.site_id + 10000000000, a.chrom, a.pos, concat(a.ref, 'C'), concat(a.alt, 'GG'), g.fresh
FROM v_alleles a JOIN v_genotypes g ON g.site_id = a.site_id WHERE a.site_id % 5 = 0"""


def _numbers(text: str):
    return F.transform(F.split(text, ","), lambda g: F.transform(F.split(g, r"\|"), lambda a: a.cast("int")))


@query("merge_loci", oracle("v_alleles v_panel", """, g AS (SELECT site_id, string_agg(CASE WHEN site_id % 5 <> 0 OR a1 > 0 OR a2 > 0 THEN concat(CAST(greatest(a1, 0) AS VARCHAR), '|', CAST(greatest(a2, 0) AS VARCHAR))
  WHEN sample_id % 2 = 1 THEN '2|0' ELSE '0|2' END, ',' ORDER BY sample_id) AS gts FROM v_panel GROUP BY site_id)
SELECT a.chrom, a.pos, CAST(CASE WHEN a.site_id % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_rows, CASE WHEN a.site_id % 5 = 0 THEN concat(ref, 'C') ELSE ref END AS ref,
  CASE WHEN a.site_id % 5 = 0 THEN concat(alt, 'C,', alt, 'GG') ELSE alt END AS alts, g.gts FROM v_alleles a JOIN g ON g.site_id = a.site_id"""))  # fmt: skip
def merge_loci(spark, d):
    rows = sql_view(spark, d, "v_alleles v_genotypes", _LOCI2)
    m = C.merge_loci(rows.select("ord", "chrom", "pos", "ref", F.array("alt").alias("alts"), _numbers("gts").alias("gts")))
    return m.select("chrom", "pos", F.col("n_rows").cast("long").alias("n_rows"), "ref", F.array_join("alts", ",").alias("alts"), F.array_join(F.transform("gts", lambda g: F.array_join(g, "|")), ",").alias("gts"))


@query("dup_position_overwrite", oracle("v_alleles v_panel", """SELECT chrom, pos, CASE WHEN site_id % 5 = 0 THEN site_id + 10000000000 ELSE site_id END AS ord,
  CASE WHEN site_id % 5 = 0 THEN concat(alt, 'GG') ELSE alt END AS alt FROM v_alleles WHERE site_id IN (SELECT site_id FROM v_panel)"""))  # fmt: skip
def dup_position_overwrite(spark, d):
    return C.dup_position_overwrite(sql_view(spark, d, "v_alleles v_genotypes", _LOCI2).select("chrom", "pos", "ord", "alt"))


#: Lines with faults of each kind, with records of one position, and with a REF to mend.
_FAULTY = """SELECT ord, CASE WHEN ord % 13 = 0 THEN regexp_replace(line, '^chr[0-9]', 'chrX') WHEN ord % 17 = 0 THEN replace(line, 'GT:DP', 'DP') WHEN ord % 19 = 0 THEN replace(line, '0/1:', '0/3:')
  WHEN ord % 46 = 0 THEN 'chr1' || chr(9) || '5' WHEN ord % 23 = 0 THEN concat(line, chr(9), '0/0:1') ELSE line END AS line FROM v_lines
UNION ALL SELECT /*+ MERGE(a, g) */ a.site_id + 10000000000, concat_ws(chr(9), a.chrom, CAST(a.pos AS VARCHAR(20)), 'second', concat(a.ref, 'Z'), concat(a.alt, 'GG'), '7', 'PASS', 'SVLEN=5', 'GT', replace(g.fresh, ',', chr(9)))
  FROM v_alleles a JOIN v_genotypes g ON g.site_id = a.site_id WHERE a.shape = 'sDEL' AND a.site_id % 5 = 0"""


@query("convert_vcf", oracle("v_sites v_alleles v_panel v_contigs", """,
x AS (SELECT s.site_id, s.chrom, s.pos, s.ref_len, s.alt_len, s.n_alts, a.ref, a.alt, substr(g.seq, CAST(s.pos - 1 AS INT), 1) AS base, substr(g.seq, CAST(s.pos + s.ref_len AS INT), 1) AS follows,
  s.shape = 'sDEL' AND s.site_id % 5 = 0 AS two, substr(a.ref, 1, 1) <> substr(a.alt, 1, 1) AND (s.ref_len > 1 OR s.alt_len > 1 OR s.n_alts = 2) AS moved
  FROM v_sites s JOIN v_alleles a ON a.site_id = s.site_id JOIN v_contigs g ON g.chrom = s.chrom),
pa AS (SELECT site_id, sample_id, greatest(a1, 0) AS x1, a1 < 0 AS miss,
  CASE WHEN a1 = 0 AND a2 = 1 AND sample_id % 2 = 0 AND site_id % 19 = 0 AND site_id % 13 <> 0 AND site_id % 17 <> 0 THEN 3 ELSE greatest(a2, 0) END AS x2 FROM v_panel),
ct AS (SELECT site_id, a, count(*) AS c FROM (SELECT site_id, x1 AS a FROM pa WHERE NOT miss UNION ALL SELECT site_id, x2 FROM pa WHERE NOT miss) GROUP BY site_id, a),
sec AS (SELECT site_id, c FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY c DESC) AS k FROM ct) WHERE k = 2),
ps AS (SELECT site_id, count(*) AS n, sum(CASE WHEN miss THEN 1 ELSE 0 END) AS m, max(greatest(x1, x2)) AS top, bool_or(x1 + x2 > 0) AS used FROM pa GROUP BY site_id),
f AS (SELECT x.*, ps.used, CASE WHEN x.site_id % 13 <> 0 AND x.site_id % 17 <> 0 AND x.site_id % 19 <> 0 AND x.site_id % 23 = 0 THEN 'columns'
    WHEN x.site_id % 13 <> 0 AND x.site_id % 17 = 0 THEN 'no_gt'
    WHEN ref_len = 1 AND alt_len + n_alts - 1 = 1 AND NOT (n - m > 1 AND coalesce(c, 0) * 1.0 / (2 * n) >= 0.25 AND m * 1.0 / n <= 0.15) THEN 'frequency'
    WHEN x.site_id % 13 = 0 THEN 'unknown_chrom' WHEN alt = ref THEN 'alleles' WHEN top > n_alts THEN 'gt_index' END AS reason
  FROM x JOIN ps ON ps.site_id = x.site_id LEFT JOIN sec ON sec.site_id = x.site_id),
t AS (SELECT f.site_id, string_agg(concat(CAST(x1 AS VARCHAR), '|', CAST(x2 AS VARCHAR)), chr(9) ORDER BY sample_id) AS own,
  string_agg(CASE WHEN sample_id % 2 = 1 THEN '1|0' ELSE '0|1' END, chr(9) ORDER BY sample_id) AS fresh, bool_or(x1 + x2 = 0) AS zero,
  string_agg(CASE WHEN x1 + x2 > 0 THEN concat(CAST(x1 AS VARCHAR), '|', CAST(x2 AS VARCHAR)) WHEN sample_id % 2 = 1 THEN concat(CASE WHEN used THEN '2' ELSE '1' END, '|0')
    ELSE concat('0|', CASE WHEN used THEN '2' ELSE '1' END) END, chr(9) ORDER BY sample_id) AS mixed
  FROM f JOIN pa ON pa.site_id = f.site_id GROUP BY f.site_id),
h AS (SELECT f.*, t.own, t.fresh, t.mixed, t.zero, concat_ws(chr(9), concat('v', CAST(f.site_id AS VARCHAR))) AS id, CASE WHEN f.site_id % 10 = 9 THEN '.' ELSE CAST(f.site_id % 60 AS VARCHAR) END AS qual,
  CASE WHEN f.site_id % 8 = 7 THEN 'LOWQ' ELSE 'PASS' END AS flt, concat('END=', CAST(pos + ref_len - 1 AS VARCHAR)) AS info FROM f JOIN t ON t.site_id = f.site_id)
SELECT site_id AS ord, CASE WHEN reason IS NOT NULL THEN reason WHEN NOT two AND NOT used THEN 'no_alt' END AS reject_reason,
  CASE WHEN reason IS NOT NULL OR (NOT two AND NOT used) THEN NULL
    WHEN two THEN concat_ws(chr(9), chrom, CAST(pos AS VARCHAR), id, concat(ref, follows),
      CASE WHEN used AND zero THEN concat(alt, follows, ',', alt, 'GG') WHEN used THEN concat(alt, follows) ELSE concat(alt, 'GG') END, qual, flt, info, 'GT', mixed)
    ELSE concat_ws(chr(9), chrom, CAST(CASE WHEN moved THEN pos - 1 ELSE pos END AS VARCHAR), id, CASE WHEN moved THEN concat(base, ref) ELSE ref END,
      CASE WHEN moved THEN concat(base, alt) ELSE alt END, qual, flt, info, 'GT', own) END AS line FROM h
UNION ALL SELECT site_id + 10000000000, CASE WHEN reason IS NULL THEN 'merged' END,
  CASE WHEN reason IS NOT NULL THEN concat_ws(chr(9), chrom, CAST(pos AS VARCHAR), 'second', concat(ref, follows), concat(alt, 'GG'), '7', 'PASS', '.', 'GT', fresh) END FROM h WHERE two"""))  # fmt: skip
def convert_vcf(spark, d):
    lines = sql_view(spark, d, "v_lines v_alleles v_genotypes", _FAULTY)
    samples = view(spark, d, "v_panel").groupBy("site_id").agg((F.count("*") + len(T.FIXED)).alias("columns"))
    r = T.records(lines, strict=False).join(samples.hint("merge"), F.col("ord") % 10_000_000_000 == F.col("site_id"))
    return C.convert(r, contig_pieces(spark, d, CHUNK), F.col("columns"), maf=0.25, missing=0.15).select("ord", "reject_reason", "line")


_GRAM = "SELECT site_id, CAST(site_id % 2 AS VARCHAR(2)) AS gt, CASE WHEN site_id % 3 = 0 THEN '10,20' WHEN site_id % 3 = 1 THEN '0,20' ELSE '7,0' END AS cov, 'FAIL' AS filter FROM v_sites"


@query("gramtools_gt", oracle("v_sites", "SELECT site_id, CASE WHEN site_id % 2 = 0 THEN '0/0' WHEN site_id % 3 = 0 THEN '0/1' ELSE '1/1' END AS gt, 'PASS' AS filter FROM v_sites"))
def gramtools_gt(spark, d):
    return C.gramtools_gt(sql_view(spark, d, "v_sites", _GRAM)).select("site_id", "gt", "filter")
