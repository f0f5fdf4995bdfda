"""Whole commands, from files to files: convert, merge, evaluate, expand symbolic variants. A VCF is a file or a folder of parts, as Spark writes it,
plain or gzip; headers are tables too, so a draft assembly's million contig lines pass through no driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varspan.functions import variant as V
from varspan.operators import convert as C
from varspan.operators import ensemble as N
from varspan.operators import evaluate as E
from varspan.operators import intervals as I
from varspan.operators import sites as S
from varspan.sources import text as T
from varspan.sources.text import checkpointed

#: Lines of one caller, and so the step between the call numbers of two callers.
CALLS = 1 << 40


def _read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Header and body of a VCF, each (ord, line)."""
    lines = T.lines_of(spark, path).where("trim(line) <> ''")
    head = F.col("line").startswith("#")
    return lines.where(head), lines.where(~head)


def _columns(header: DataFrame, path: str) -> int:
    row = header.where(F.col("line").startswith("#CHROM")).select(F.size(F.split("line", "\t")).alias("n")).first()
    if row is None:
        raise ValueError(f"{path}: no #CHROM line")
    return row.n


def _need_sorted(records: DataFrame, path: str) -> None:
    odd = S.check_sorted(records).limit(1).collect()
    if odd:
        raise ValueError(f"{path}: not sorted at {odd[0].chrom}:{odd[0].pos}, after {odd[0].before}")


def convert_files(spark: SparkSession, vcf: str, fasta: str, out: str, read_length: int = C.READ_LENGTH, maf: float = 0.0, missing: float = 1.0) -> DataFrame:
    """A VCF made fit for genotypers, with contig lines of the FASTA in its header. Gives the audit (ord, chrom, pos, reject_reason), reject_reason null for
    rows that are written."""
    header, body = _read(spark, vcf)
    n = _columns(header, vcf)
    contigs = checkpointed(T.scan_contigs(spark, fasta, I.CHUNK))
    done = checkpointed(C.convert(T.records(body, strict=False), contigs, n, read_length, maf, missing))
    lengths = T.contig_lengths(contigs)
    fresh = lengths.select(F.lit(1).alias("n"), F.lit(0).cast("long").alias("ord"), F.format_string("##contig=<ID=%s,length=%d>", F.col("chrom"), F.col("len")).alias("line"))
    kept = header.where(~F.col("line").startswith("##contig")).select(F.when(F.col("line").startswith("#CHROM"), 2).otherwise(0).alias("n"), "ord", "line")
    T.write_vcf(kept.unionByName(fresh), done.where("line is not null"), out)
    return done.select("ord", "chrom", "pos", "reject_reason")


def delly_files(spark: SparkSession, vcf: str, fasta: str, out: str, complement: bool = False) -> None:
    """Symbolic deletions, duplications and inversions of a VCF with their bases; the header stays, rows stay in file order."""
    header, body = _read(spark, vcf)
    r = T.records(body).withColumn("alt", F.array_join("alts", ","))
    d = C.symbolic_expand(r, T.scan_contigs(spark, fasta, I.CHUNK), complement).withColumn("alts", F.array("alt"))
    T.write_vcf(header.withColumn("n", F.lit(0)), T.vcf_line(d), out, ("ord",))


def _callers(spark: SparkSession, callers: dict[str, str], samples: list[str]) -> DataFrame:
    """Calls of all callers' files, read as one, a row for each sample (its number in the list): all rows, with the sample's depths, and whether they count
    (PASS, a genotype that isn't 0); lengths are told where it is PASS. Calls are numbered in order of callers, files and lines.

    A first pass counts the lines of each split and finds the samples' columns, a second one parses each line once; no line is shuffled."""
    plain = lambda f: f.replace(":///", ":/")  # noqa: E731  as _metadata spells them
    files = [(plain(f), caller, k) for k, (caller, path) in enumerate(sorted(callers.items())) for f in spark.read.text(path).inputFiles()]
    lists = F.broadcast(spark.createDataFrame(files, "file string, caller string, number long"))  # a row a file, of lists that the driver has anyway
    text = spark.read.option("recursiveFileLookup", "true").text(list(callers.values()))  # folders of several roots
    raw = text.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("m"))
    names = F.split("value", "\t")
    own = F.slice(names, len(T.FIXED) + 1, F.greatest(F.size(names) - len(T.FIXED), F.lit(0)))
    head = F.col("value").startswith("#CHROM")
    splits = raw.groupBy("path", "block").agg(F.min("m").alias("first"), F.count("*").alias("n"), *[F.max(F.when(head, F.array_position(own, s) - 1)).alias(f"i{k}") for k, s in enumerate(samples)])
    splits = checkpointed(splits.withColumn("file", F.replace("path", F.lit(":///"), F.lit(":/"))).join(lists, "file"))
    upto = F.sum("n").over(Window.partitionBy("caller").orderBy("file", "block"))
    base = splits.select("path", "block", (upto - F.col("n") - F.col("first") + F.col("number") * CALLS).alias("base"))  # a row a split
    found = splits.groupBy("caller").agg(*[F.max(f"i{k}").alias(f"i{k}") for k in range(len(samples))]).collect()  # a row a caller
    place = {r.caller: [r[f"i{k}"] for k in range(len(samples))] for r in found}
    for caller in callers:
        for k, sample in enumerate(samples):
            if caller not in place or place[caller][k] is None or place[caller][k] < 0:
                raise ValueError(f"{caller}: no sample {sample}")
    body = raw.where("trim(value) <> '' and not startswith(value, '#')").join(F.broadcast(base), ["path", "block"]).select((F.col("m") + F.col("base")).alias("ord"), F.col("value").alias("line"))
    r = T.records(body).withColumn("number", F.floor(F.col("ord") / CALLS))
    of = lambda values: F.element_at(F.array(*values), (F.col("number") + 1).cast("int"))
    order = sorted(callers)
    r = r.withColumn("caller", of([F.lit(c) for c in order]))
    passed = F.col("filter") == "PASS"
    each = [F.struct(F.lit(k).alias("sample"), F.get("samples", of([F.lit(int(place[c][k])) for c in order])).alias("s")) for k in range(len(samples))]
    # the texts of one plain ALT end here, before the samples and all that is not compiled; allele_lengths() tells the others
    alt = F.get("alts", F.lit(0))
    one = (F.size("alts") == 1) & ~alt.contains(">") & ~F.col("id").contains("Duplication")
    r = r.select("ord", "caller", "chrom", "pos", "format", passed.alias("passed"), F.when(one, F.length(alt).cast("long")).alias("alt_len"), "ref_len", F.when(passed & F.coalesce(~one, F.lit(True)), F.struct("id", "ref", "alts")).alias("texts"), F.explode(F.array(*each)).alias("x"))
    named = V.allele_lengths(F.col("texts.id"), F.col("texts.ref"), F.col("texts.alts"))
    r = r.withColumn("l", F.when(F.col("texts").isNotNull(), named).otherwise(F.struct("ref_len", F.array("alt_len").alias("lens"))))
    # one or two alleles and one depth, as most have, are told without lambdas, which are not compiled; gt_strict() and depths() tell the others
    text = lambda *keys: F.coalesce(*[V.field(F.col("format"), F.col("x.s"), k) for k in keys])
    r = r.withColumns({"parts": F.split(F.translate(F.coalesce(text("GT"), F.lit("0/0")), "|", "/"), "/"), "dp": text("DP", "MAC", "KC")})
    at = lambda k: F.get("parts", F.lit(k))
    r = r.withColumns({"n": F.size("parts"), "v": F.when(~F.contains("dp", F.lit(",")), F.col("dp").try_cast("double")), **{f"a{k}": F.when(at(k) != ".", at(k).try_cast("int")) for k in (0, 1)}})
    r = r.withColumns({"gt": F.when(F.col("n") > 2, V.gt_strict(F.col("format"), F.col("x.s"))), "depths": F.when(F.contains("dp", F.lit(",")), V.depths(F.col("format"), F.col("x.s")))})
    missing = F.col("a0").isNull() | (F.col("n") == 2) & F.col("a1").isNull()
    allele = lambda k: F.when(F.col("n") > 2, F.get("gt", F.lit(k))).when(missing, 0).otherwise(F.when(F.col("n") == 1, F.col("a0")).otherwise(F.col(f"a{k}")))  # noqa: E731  one allele counts twice
    one_depth = F.when(F.col("v") == -1, 0.0).otherwise(F.coalesce("v", F.lit(0.0)))
    depth = lambda k: F.when(F.col("depths").isNull(), one_depth).otherwise(F.get("depths", F.least(F.lit(k), F.size("depths") - 1)))
    r = r.withColumns({**{f"g{k}": allele(k) for k in (0, 1)}, **{f"d{k}": depth(k) for k in (0, 1)}})
    total = F.when(F.col("depths").isNull(), F.col("d0")).otherwise(F.aggregate("depths", F.lit(0.0), lambda a, x: a + x))
    varies = F.when(F.col("n") > 2, F.exists("gt", lambda g: g != 0)).otherwise((F.col("g0") != 0) | (F.col("g1") != 0))
    length = lambda g: F.when(F.col(g) == 0, F.col("l.ref_len")).otherwise(F.get("l.lens", F.col(g) - 1))
    return r.select(
        F.col("ord").alias("call_id"), "x.sample", "caller", "chrom", "pos", F.col("l.ref_len").alias("ref_len"), *[length(f"g{k}").alias(f"h{k}") for k in (0, 1)],
        "g0", "g1", "d0", "d1", total.alias("depth"), (F.col("passed") & varies).alias("counts"),
    )


def merge_files(spark: SparkSession, base: str, callers: dict[str, str], sample: str, out: str, mode: str = "all", second: str | None = None, as_named: bool = False) -> DataFrame:
    """merge_samples() of one sample: gives (panel_sample, name, n, share)."""
    return merge_samples(spark, base, callers, {sample: out}, mode, {sample: second} if second else None, as_named).drop("sample")


def merge_samples(spark: SparkSession, base: str, callers: dict[str, str], outs: dict[str, str], mode: str = "all", seconds: dict[str, str] | None = None, as_named: bool = False) -> DataFrame:
    """Genotypes of several callers (name to VCF) for each of some samples (name to the file to write), at the sites of a base VCF; files are read once for
    all samples. In mode `all` a second file, where named for a sample, takes the sites where the most similar sample of the base is not reference, by the
    rule `specific`. as_named: see merged_lines. Gives (sample, panel_sample, name, n, share), the most similar sample of each.

    A base that isn't sorted, a file without a sample, and calls on a chromosome that the base doesn't have are errors. Of base records at one
    position the last one counts."""
    if mode not in ("all", "specific"):
        raise ValueError(f"merge: mode {mode}")
    names = list(outs)
    header, body = _read(spark, base)
    fixed = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), "id", "ref", F.array_join("alts", ","), "qual_text", "filter", "info")
    phased = F.transform("samples", lambda s: V.gt_phase(V.field(F.col("format"), s, "GT")))
    records = T.records(body).withColumn("l", V.allele_lengths(F.col("id"), F.col("ref"), F.col("alts")))
    records = checkpointed(records.select("ord", "chrom", "pos", F.concat(F.array(F.col("l.ref_len")), F.col("l.lens")).alias("lens"), fixed.alias("fixed"), phased.alias("gts")))
    _need_sorted(records, base)
    # places alone are dealt out; texts and genotypes wait in the records, whose numbers voted sites keep
    sites = checkpointed(C.dup_position_overwrite(records.select("ord", "chrom", "pos", "lens")).withColumnRenamed("ord", "site_id"))
    records = records.withColumnRenamed("ord", "site_id")
    rows = checkpointed(_callers(spark, callers, names))
    calls = rows.where("counts")
    strange = calls.join(sites.select("chrom").distinct(), "chrom", "left_anti").select("caller", "chrom").limit(1).collect()
    if strange:
        raise ValueError(f"{strange[0].caller}: chromosome {strange[0].chrom} is not in {base}")
    by, key = ("sample", "caller"), ("site_id", "sample")
    stats = checkpointed(N.caller_depth(rows, by))
    matches = I.match_calls(calls, sites, ("call_id", "sample"), ("caller", "pos", "d0", "d1"))
    cube = N.with_z(N.cube(N.taken(matches, by, I.PLACE, ("d0", "d1")), sites, by), stats, by)
    again = mode == "all" and bool(seconds)
    if again:
        cube = checkpointed(cube)
    voted = checkpointed(N.vote(cube, key, len(callers), mode, ("z", "depth")))

    def write(chosen: DataFrame, paths: dict[str, str]) -> None:
        lines = N.merged_lines(chosen, None, stats, records, key, as_named, by).join(records.select("site_id", "chrom", "pos"), "site_id")
        lines = checkpointed(lines.withColumnRenamed("site_id", "ord"))
        for sample, path in paths.items():
            T.write_vcf(merged_header(header, sample), lines.where(F.col("sample") == names.index(sample)), path)

    write(voted, outs)
    similar = checkpointed(N.similar_sample(voted, records.select("site_id", "gts"), "sample"))
    if again:
        panel = records.select("site_id", F.posexplode("gts").alias("panel_sample", "gt"))
        write(N.high_conf(cube, panel, similar, key, len(callers), "sample", ("z", "depth")), seconds)
    panel_names = T.header_samples(header).withColumnRenamed("idx", "panel_sample").withColumnRenamed("sample", "name")
    of = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("sample") + 1)
    return similar.join(panel_names, "panel_sample", "left").select(of.alias("sample"), "panel_sample", "name", "n", "share")


def merged_header(header: DataFrame, sample: str) -> DataFrame:
    """(n, ord, line): the base's header lines, the four FORMAT lines, #CHROM with one sample."""
    formats = header.sparkSession.createDataFrame([(1, k, x) for k, x in enumerate(T.MERGE_FORMATS)], "n int, ord long, line string")
    chrom = F.col("line").startswith("#CHROM")
    cut = F.concat_ws("\t", F.slice(F.split("line", "\t"), 1, len(T.FIXED)))
    rest = header.select(F.when(chrom, 2).otherwise(0).alias("n"), "ord", F.when(chrom, F.concat(cut, F.lit("\t" + sample))).otherwise(F.col("line")).alias("line"))
    return rest.unionByName(formats)


def evaluate_files(spark: SparkSession, truth: str, calls: str, out: str, model: str = "genotype", score: str | None = None, roc_by: str = "genotype", compressed: bool = False) -> None:
    """A call set against truth, to folders below `out`: records (lines, by part: genotype, misgenotype, miscall, failcall), summary, histogram, roc.

    model: genotype (a call meets truth at its own position), recall (within tolerances, each truth row once), gramtools (haploid genotypes made
    diploid by coverage, then as genotype). score: FORMAT.<key> or INFO.<key>. roc_by: genotype, or recall for any match. Calls on chromosomes
    that truth doesn't have are miscalls; a truth file that isn't sorted is an error. compressed: the lines are written as gzip."""
    if model not in ("genotype", "recall", "gramtools") or roc_by not in ("genotype", "recall"):
        raise ValueError(f"evaluate: model {model}, roc_by {roc_by}")
    t_lines, c_lines = (checkpointed(_read(spark, p)[1]) for p in (truth, calls))
    t_records, c_records = T.records(t_lines), T.records(c_lines)
    _need_sorted(t_records, truth)
    if model == "gramtools":
        c_records = C.gramtools_records(c_records)
    t = E.from_records(t_records, passed=False).withColumnsRenamed({"ord": "site_id", "sv_len": "true_len"}).drop("score")
    c = E.from_records(c_records, score).withColumnRenamed("ord", "call_id")
    t, c = checkpointed(t), checkpointed(c)
    m = I.match_truth(c, t) if model == "recall" else E.use_once(I.match_exact(c, t))
    o = checkpointed(E.outcomes(c, m, t.select("site_id", "true_len")))
    hit = o.where("site_id is not null").select("site_id")
    missed = t.join(hit, "site_id", "left_anti").select(F.col("site_id").alias("ord"), F.lit("failcall").alias("part"))
    records = o.select(F.col("call_id").alias("ord"), F.col("outcome").alias("part")).join(c_lines, "ord").unionByName(missed.join(t_lines, "ord").select("ord", "part", "line"))
    T.write_split(records, f"{out}/records", "part", codec="gzip" if compressed else "none")
    E.summary(o, t).write.parquet(f"{out}/summary")
    E.histogram(o, t).write.parquet(f"{out}/histogram")
    E.roc(o, t, by=roc_by).write.parquet(f"{out}/roc")
