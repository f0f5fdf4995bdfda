"""Normalising variant records: checks, reference fixes, anchoring, merging of loci, expansion of symbolic alleles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspan.functions.variant import alleles, diploid_alleles, field, info_number
from varspan.operators.intervals import ref_lookup
from varspan.operators.order import running

#: Read length that positions must leave before them; beyond the second, positions aren't tested.
READ_LENGTH, LONG_READ = 350, 1000
LONGEST = 100_000


def filter_pass(df: DataFrame, column: str = "filter") -> DataFrame:
    return df.where(F.col(column) == "PASS")


def filter_nonref(df: DataFrame, gt: str = "gt") -> DataFrame:
    """Drops all-zero and empty genotypes."""
    return df.where(F.exists(gt, lambda g: g != 0))


def breakpoint_shift(df: DataFrame, s: int = 1) -> DataFrame:
    """POS moved back by s, to 1 at least; INFO's END follows."""
    pos = F.greatest(F.col("pos") - s, F.lit(1))
    return df.withColumn("pos", pos).withColumn("info", F.regexp_replace("info", F.lit(r"END=\d+"), F.concat(F.lit("END="), (F.col("pos") + F.col("ref_len") - 1).cast("string"))))


def fix_info(df: DataFrame) -> DataFrame:
    """END recomputed from REF; SVLEN removed, `.` where it stood alone."""
    end = F.regexp_replace("info", F.lit(r"END=\d+"), F.concat(F.lit("END="), F.col("ref_end").cast("string")))
    out = F.regexp_replace(F.regexp_replace(end, r"SVLEN=-?\d+;", ""), r";SVLEN=-?\d+", "")
    return df.withColumn("info", F.regexp_replace(out, r"^SVLEN=-?\d+$", "."))


def _lengths(contigs: DataFrame) -> DataFrame:
    """(c_chrom, c_len) of contigs with seq and len, or in pieces, which may have the contig's len."""
    from varspan.sources.text import contig_lengths

    own = contigs.where("piece = 0") if "piece" in contigs.columns else contigs
    c = own if "len" in contigs.columns else contig_lengths(contigs)
    return c.select(F.col("chrom").alias("c_chrom"), F.col("len").alias("c_len"))


def reject_reason(df: DataFrame, contigs: DataFrame, read_length: int = READ_LENGTH) -> DataFrame:
    """Adds reject_reason, null for good rows. Only the lengths of contigs are read."""
    lens = _lengths(contigs)
    near = read_length if read_length <= LONG_READ else 0
    top = F.array_max(F.transform("samples", lambda s: F.coalesce(F.array_max(alleles(F.coalesce(field(F.col("format"), s, "GT"), F.lit("0")))), F.lit(0))))
    reason = (
        F.when(~F.array_contains(F.split("format", ":"), "GT"), "no_gt")
        .when(F.col("c_len").isNull(), "unknown_chrom")
        .when(F.exists("alts", lambda a: a.contains("<")), "symbolic")
        .when(F.col("pos") < near, "near_start")
        .when(F.col("ref_end") >= F.col("c_len"), "beyond_end")
        .when(F.coalesce(top, F.lit(0)) > F.size("alts"), "gt_index")
    )
    return df.join(lens, F.col("chrom") == F.col("c_chrom"), "left").withColumn("reject_reason", reason).drop("c_chrom", "c_len")


def drop_bad_rows(df: DataFrame, contigs: DataFrame, read_length: int = READ_LENGTH) -> DataFrame:
    return reject_reason(df, contigs, read_length).where("reject_reason is null").drop("reject_reason")


def fix_ref(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """REF replaced by the reference bases where it differs; `changed` tells."""
    j = ref_lookup(df, contigs, F.col("pos"), F.length("ref"))
    new = F.when(F.upper("bases_at") != F.upper("ref"), F.col("bases_at")).otherwise(F.col("ref"))
    return j.withColumns({"changed": F.coalesce(new != F.col("ref"), F.lit(False)), "ref": F.coalesce(new, "ref")}).drop("bases_at")


def _steps() -> Column:
    """How far anchoring moves a record back: one base, or none."""
    steps = F.aggregate(
        F.transform("alts", lambda a: F.struct(F.substring(a, 1, 1).alias("b"), F.length(a).alias("n"))), F.struct(F.lit(0).alias("k"), F.substring("ref", 1, 1).alias("b")),
        # once moved, every ALT begins with the reference base, so later ones don't differ
        lambda s, a: F.when((s["k"] == 0) & (a["b"] != s["b"]) & ((a["n"] > 1) | (F.length("ref") > 1)), F.struct((s["k"] + 1).alias("k"), s["b"].alias("b"))).otherwise(s),
    )["k"]
    return F.when(F.size("alts") > 0, steps).otherwise(F.lit(0))


def _moved(df: DataFrame, base: Column) -> DataFrame:
    """Records moved `_k` bases back, with the base that stands there before their alleles."""
    return df.withColumns({"pos": F.col("pos") - F.col("_k"), "ref": F.concat(base, F.col("ref")), "alts": F.transform("alts", lambda a: F.concat(base, a))}).drop("_k", "_base")


def _anchored(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Records whose first bases differ (and aren't SNPs) moved one base back, for each such ALT in turn."""
    d = df.withColumn("_k", _steps())
    j = ref_lookup(d, contigs, F.greatest(F.col("pos") - F.col("_k"), F.lit(1)), F.col("_k"), "_base")
    return _moved(j, F.coalesce(F.col("_base"), F.lit("")))


def _fixed_and_anchored(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """fix_ref() and fix_info(), then _anchored(), by one lookup: of the bases of REF and of the one before them."""
    n, first = F.length("ref"), F.greatest(F.col("pos") - 1, F.lit(1))
    j = ref_lookup(df, contigs, first, F.greatest(F.col("pos") + n - first, F.lit(1)), "_bases")
    own = F.when(F.col("pos") > 1, F.substring("_bases", F.lit(2), n)).otherwise(F.substring("_bases", F.lit(1), F.greatest(F.col("pos") + n - 1, F.lit(0)).cast("int")))
    j = j.withColumns({"_own": own, "_base": F.substring("_bases", 1, 1)}).drop("_bases")
    j = fix_info(j.withColumn("ref", F.coalesce(F.when((F.col("_own") != F.col("ref")) & (F.upper("_own") != F.upper("ref")), F.col("_own")), "ref")).drop("_own"))
    return _moved(j.withColumn("_k", _steps()), F.when(F.col("_k") > 0, F.coalesce("_base", F.lit(""))).otherwise(F.lit("")))


def anchor_alleles(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Records whose first bases differ (and aren't SNPs) move one base back, for each such ALT in turn; REF = ALT and letters other than
    ATGCN drop the record."""
    bad = F.exists("alts", lambda a: (a == F.col("ref")) | a.rlike("[^ATGCNatgcn]"))
    return _anchored(df, contigs).where(~bad)


def drop_dup_alleles(df: DataFrame) -> DataFrame:
    # alts stand once: an expression behind them isn't copied into the code for each use
    return df.where(F.forall(F.array("alts"), lambda a: F.size(F.array_distinct(a)) == F.size(a)))


def trim_alleles(df: DataFrame) -> DataFrame:
    """ALTs that no sample's genotype uses are removed and genotypes (gts, array of arrays) renumbered."""
    used = F.array_sort(F.array_distinct(F.filter(F.flatten("gts"), lambda g: g > 0)))
    d = df.withColumn("_used", used)
    return d.withColumns({
        "alts": F.transform("_used", lambda g: F.get("alts", g - 1)),
        "gts": F.transform("gts", lambda t: F.transform(t, lambda g: F.when(g > 0, F.array_position("_used", g).cast("int")).otherwise(g))),
    }).drop("_used")


def _row_maf(record: DataFrame) -> DataFrame:
    """Adds _maf, _missing and _called of a record's own genotypes (gts, array of arrays; null alleles are missing)."""
    record = record.withColumn("_held", F.filter(F.flatten("gts"), lambda a: a.isNotNull()))  # a column: counted in the loop, not made there
    counts = F.array_sort(F.transform(F.array_distinct("_held"), lambda a: -F.size(F.filter("_held", lambda b: b == a))))
    n, absent = F.size("gts"), F.size(F.filter("gts", lambda g: F.exists(g, lambda a: a.isNull())))
    ploidy = F.array_max(F.transform("gts", lambda g: F.size(g)))
    return record.withColumns({"_maf": -F.coalesce(F.get(counts, F.lit(1)), F.lit(0)) / (ploidy * n), "_missing": absent / n, "_called": n - absent}).drop("_held")


def convert(records: DataFrame, contigs: DataFrame, columns: int | Column, read_length: int = READ_LENGTH, maf: float = 0.0, missing: float = 1.0) -> DataFrame:
    """VCF records (sources.text.records, not strict) made fit for genotypers, as (ord, chrom, pos, reject_reason, line): line is null for rejected
    rows, and for merged ones reject_reason is `merged`.

    In order: number of columns and GT; with maf over 0 and missing under 1 SNPs by frequency and missing rate; chromosome, symbolic
    ALTs, start and end; REF from the contig; END and SVLEN; anchoring, equal and odd alleles; diploid phased genotypes alone; allele
    numbers; end at the contig's end; records of one position to one; ALTs that no sample has removed; repeated ALTs."""
    from varspan.sources.text import checkpointed

    lens = _lengths(contigs)
    near = read_length if read_length <= LONG_READ else 0
    gt_at = F.col("gt_at")  # a column, so that it is found once a record and not once a sample
    raw = F.transform("samples", lambda s: F.coalesce(F.get(F.split(s, ":"), (gt_at - 1).cast("int")), F.lit("0|0")))
    d = records.withColumn("gt_at", F.array_position(F.split("format", ":"), "GT"))
    d = d.join(lens, F.col("chrom") == F.col("c_chrom"), "left").withColumn("raw", F.when(gt_at > 0, raw))
    d = d.withColumn("gts", F.transform("raw", lambda g: alleles(g)))
    rare = F.lit(False)
    if maf > 0 and missing < 1:
        d = _row_maf(d)
        snp = (F.length("ref") == 1) & (F.array_max(F.transform("alts", lambda a: F.length(a))) == 1)
        rare = snp & ~F.coalesce((F.col("_called") > 1) & (F.col("_maf") >= maf) & (F.col("_missing") <= missing), F.lit(False))
    reason = (
        F.when((F.col("n_columns") != columns) | F.col("pos").isNull(), "columns")
        .when(F.coalesce(gt_at, F.lit(0)) <= 0, "no_gt")
        .when(rare, "frequency")
        .when(F.col("c_len").isNull(), "unknown_chrom")
        .when(F.exists("alts", lambda a: a.contains("<")), "symbolic")
        .when(F.col("pos") < near, "near_start")
        .when(F.col("ref_end") > F.col("c_len"), "beyond_end")
    )
    held = ("ord", "chrom", "pos", "id", "ref", "alts", "qual_text", "filter", "info", "ref_end", "c_len", "raw", "gts")
    d = checkpointed(d.withColumn("reject_reason", reason).select(*held, "reject_reason"))  # read by both branches
    good, bad = d.where("reject_reason is null"), d.where("reject_reason is not null")
    moved = _fixed_and_anchored(good, contigs)
    top = F.coalesce(F.array_max(F.flatten("gts")), F.lit(0))
    odd = F.exists("alts", lambda a: (a == F.col("ref")) | a.rlike("[^ATGCNatgcn]"))
    late = (
        F.when(odd, "alleles")
        .when(F.size(F.array_distinct("alts")) < F.size("alts"), "repeated")
        .when(top > F.size("alts"), "gt_index")
        .when(F.col("ref_end") == F.col("c_len"), "beyond_end")
    )
    moved = moved.withColumns({"reject_reason": late, "gts": F.transform("raw", diploid_alleles)})
    moved = checkpointed(moved.drop("raw"))
    kept, bad2 = moved.where("reject_reason is null"), moved.where("reject_reason is not null")
    fixed = F.struct("id", "qual_text", "filter", "info")
    merged = trim_alleles(merge_loci(kept.select("chrom", "pos", "ord", "ref", "alts", "gts")))
    merged = merged.hint("merge").join(kept.select("ord", fixed.alias("f")).hint("merge"), "ord")  # of long alleles that deflate well: not broadcast
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), "f.id", "ref", F.array_join("alts", ","), "f.qual_text", "f.filter", "f.info", F.lit("GT"), F.array_join(F.transform("gts", lambda g: F.array_join(g, "|")), "\t"))
    last = F.when(F.size("alts") == 0, "no_alt").when(F.size(F.array_distinct("alts")) < F.size("alts"), "repeated")
    out = merged.select("ord", "chrom", "pos", last.alias("reject_reason"), F.when(last.isNull(), line).alias("line"))
    first = kept.groupBy("chrom", "pos").agg(F.min("ord").alias("first"))
    swallowed = kept.select("ord", "chrom", "pos").join(first.hint("merge"), ["chrom", "pos"]).where("ord > first").select("ord", "chrom", "pos").withColumns({"reject_reason": F.lit("merged"), "line": F.lit(None).cast("string")})
    gone = bad.select("ord", "chrom", "pos", "reject_reason").unionByName(bad2.select("ord", "chrom", "pos", "reject_reason")).withColumn("line", F.lit(None).cast("string"))
    return out.unionByName(swallowed).unionByName(gone)


def sv_only(df: DataFrame, ref_len: str = "ref_len", alt_len: str = "alt_len") -> DataFrame:
    """Drops rows whose REF and ALT texts are both under 50."""
    return df.where((F.col(ref_len) >= 50) | (F.col(alt_len) >= 50))


def symbolic_expand(df: DataFrame, contigs: DataFrame, complement: bool = False) -> DataFrame:
    """Rows of symbolic deletions, duplications and inversions with their bases: PASS alone, END needed, no longer than LONGEST; insertions
    and breakends are dropped, other ALTs stay and only REF is replaced. <INV> is the reversed REF, or its reverse complement."""
    end = info_number(F.col("info"), "END").cast("long")
    alt = F.regexp_replace("alt", r"[\[\]]", "")
    d = df.where("filter = 'PASS'").withColumns({"alt": alt, "_end": end})
    d = d.where(F.col("_end").isNotNull() & (F.col("_end") - F.col("pos") < LONGEST) & (F.col("_end") >= F.col("pos")) & ~F.col("alt").contains(":") & (F.col("alt") != "<INS>"))
    j = ref_lookup(d, contigs, F.col("pos"), F.col("_end") - F.col("pos") + 1)
    seq = F.col("bases_at")
    flipped = F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca") if complement else seq)
    new = F.when(F.col("alt") == "<INV>", flipped).when(F.col("alt") == "<DEL>", F.substring(seq, 1, 1)).when(F.col("alt") == "<DUP>", F.repeat(seq, F.lit(2))).otherwise(F.col("alt"))
    return j.where(seq.isNotNull()).withColumns({"ref": seq, "alt": new}).drop("bases_at", "_end")


def merge_loci(df: DataFrame, key: tuple[str, ...] = ("chrom", "pos")) -> DataFrame:
    """Records of one position to one, in file order (ord, unique): the longest REF (of equal ones the last), ALTs of shorter ones filled up with the bases
    missing, ALTs appended; genotypes (gts) of samples still 0 take the next record's, renumbered by the ALTs before it. Gives n_rows and the first record's ord.

    Positions of one record are only given a new form. Of the others REF is a grouped maximum, the ALTs before a record are a running sum,
    and a sample's genotype is that of its first record that isn't 0: records and samples are rows, so no row holds a position's records."""
    from varspan.sources.text import checkpointed

    plain = df.select(*key, "ord", "ref", "alts", "gts")
    stats = plain.groupBy(*key).agg(F.count("*").alias("n_rows"), F.min("ord").alias("first"), F.max_by("ref", F.struct(F.length("ref"), F.col("ord"))).alias("long_ref"))
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in key]
    both = plain.alias("r").join(stats.hint("merge").alias("s"), same("r", "s")).select("r.*", "s.n_rows", "s.first", "s.long_ref")
    one = both.where("n_rows = 1").select(*key, "n_rows", "ord", "ref", "alts", "gts")
    many = checkpointed(both.where("n_rows > 1").withColumn("n_alts", F.size("alts")))  # read four times
    offsets = running(many.select(*key, "ord", "n_alts"), list(key), ["ord"], ["n_alts"]).select(F.col("ord").alias("o_ord"), (F.col("n_alts_upto") - F.col("n_alts")).cast("int").alias("before"))
    many = many.join(offsets.hint("merge"), F.col("ord") == F.col("o_ord")).drop("o_ord")
    rest = F.substring("long_ref", F.length("ref") + 1, F.length("long_ref"))
    own = many.select(*key, "ord", F.transform("alts", lambda a: F.concat(a, rest)).alias("alts"))
    alts = own.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("ord", "alts"))).alias("a")).select(*key, F.flatten(F.transform("a", lambda x: x["alts"])).alias("alts"))  # the merged record's own
    gts = many.select(*key, "ord", "first", "before", F.posexplode("gts").alias("sample", "gt"))
    used = F.coalesce(F.exists("gt", lambda v: v > 0), F.lit(False))
    gts = gts.where((F.col("ord") == F.col("first")) | used).groupBy(*key, "sample").agg(
        F.max(F.when(F.col("ord") == F.col("first"), F.col("gt"))).alias("base"), F.min_by(F.when(used, F.struct("gt", "before")), F.when(used, F.col("ord"))).alias("q"))
    taken = F.zip_with("base", F.col("q.gt"), lambda a, b: F.when(b > 0, b + F.col("q.before")).otherwise(a))
    gts = gts.select(*key, "sample", F.when(F.col("q").isNull() | F.exists("base", lambda v: v > 0), F.col("base")).otherwise(taken).alias("gt"))
    gts = gts.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("sample", "gt"))).alias("g")).select(*key, F.transform("g", lambda x: x["gt"]).alias("gts"))  # an entry a sample
    merged = stats.where("n_rows > 1").alias("s").join(alts.alias("a"), same("s", "a")).join(gts.alias("g"), same("s", "g"), "left")
    merged = merged.select(*[f"s.{k}" for k in key], "s.n_rows", F.col("s.first").alias("ord"), F.col("s.long_ref").alias("ref"), "a.alts", F.coalesce("g.gts", F.array().cast(df.schema["gts"].dataType)).alias("gts"))
    return one.unionByName(merged)


def dup_position_overwrite(df: DataFrame, key: tuple[str, ...] = ("chrom", "pos"), order: str = "ord") -> DataFrame:
    """Of records of one position the last one alone."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("v")).select(*key, "v.*")


def gramtools_gt(df: DataFrame) -> DataFrame:
    """Haploid genotype to diploid by coverage (cov, text): 0 is 0/0; with a zero coverage 1/1, else 0/1. FILTER becomes PASS."""
    zero = F.exists(F.split("cov", ","), lambda x: x == "0")
    return df.withColumns({"gt": F.when(F.col("gt") == "0", "0/0").when(zero, "1/1").otherwise("0/1"), "filter": F.lit("PASS")})


def gramtools_records(records: DataFrame) -> DataFrame:
    """VCF records with the last sample's haploid genotype made diploid by its COV; other fields stay, FILTER is PASS."""
    last = F.element_at("samples", -1)
    r = records.withColumns({"gt": F.coalesce(field(F.col("format"), last, "GT"), F.lit("0")), "cov": F.coalesce(field(F.col("format"), last, "COV"), F.lit(""))})
    at = F.array_position(F.split("format", ":"), "GT") - 1
    new = F.array_join(F.transform(F.split(last, ":"), lambda x, i: F.when(i == at, F.col("gt")).otherwise(x)), ":")
    return gramtools_gt(r).withColumn("samples", F.array(new)).drop("gt", "cov")


def chrom_known(df: DataFrame, contigs: DataFrame, known: bool = True) -> DataFrame:
    """Rows on chromosomes that are (or aren't) among the contigs."""
    return df.join(contigs.select("chrom").distinct(), "chrom", "left_semi" if known else "left_anti")


def tool_select(read_len: Column, depth: Column, genome: Column) -> Column:
    """Callers for a cohort, as an array."""
    short = F.array(F.lit("Paragraph"), F.lit("BayesTyper"), F.when(genome > 200 * 1024 * 1024, "VG-Giraffe").otherwise("VG-MAP"), F.when((read_len > 130) & (depth > 5), "GraphTyper2").otherwise("PanGenie"))
    return F.when(read_len >= 10000, F.array(F.lit("GraphAligner"))).otherwise(short)


def depth_plan(df: DataFrame, most: float = 15.0) -> DataFrame:
    """Adds depth, at most `most`, and the fraction of reads to keep; at 1 or more no sampling is done. Needs bases and genome."""
    b, g = F.col("bases").cast("double"), F.col("genome").cast("double")
    fraction = F.round(g * most / b, 3)
    return df.withColumns({"depth": F.least(b / g, F.lit(most)), "fraction": fraction, "sampled": fraction < 1})
