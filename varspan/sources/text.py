"""Text sources and sinks as Spark reads and writes: gzip by name, one line a row, numbered within its file."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FIXED = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share. Where that is unset, a local master gets one of its own; on a
    cluster it is an error, as executors on other machines wouldn't see it."""
    if not spark.conf.get("spark.checkpoint.dir", ""):
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="spark-"))
    return f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again, to cut the lineage of a loop."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, *order: str, name: str = "rank") -> DataFrame:
    """df with the place of each row in an order, from 0. Rows go to partitions by range and are sorted there; only the partitions'
    counts are summed up. They are written before, so that lost executors change no place."""
    d = df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id"))
    d = checkpointed(d)
    parts = d.groupBy("_part").agg(F.count("*").alias("n"), F.min("_id").alias("first"))
    base = parts.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n") - F.col("first")).alias("_shift"))  # a row a partition
    return d.join(F.broadcast(base), "_part").withColumn(name, F.col("_id") + F.col("_shift")).drop("_part", "_id", "_shift")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_no, value) of text files. Each split's lines are counted, counts are summed up within a file; no
    window goes over the lines themselves. The sums, a row a split, are broadcast, so no line is shuffled."""
    text = spark.read.text(path) if isinstance(path, str) else spark.read.option("recursiveFileLookup", "true").text(path)  # folders of several roots
    raw = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("m"))
    blocks = raw.groupBy("file", "block").agg(F.min("m").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return raw.join(F.broadcast(base), ["file", "block"]).select("file", (F.col("m") + F.col("shift")).alias("line_no"), "value")


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(ord, line) of text files taken as one, in order of their paths: ord goes on from file to file."""
    lines = numbered_lines(spark, path)
    sizes = lines.groupBy("file").agg(F.count("*").alias("n"))
    base = sizes.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("base"))  # a row a file
    return lines.join(F.broadcast(base), "file").select((F.col("line_no") + F.col("base")).alias("ord"), F.col("value").alias("line"))


def records(lines: DataFrame, line: str = "line", ord_: str = "ord", strict: bool = True) -> DataFrame:
    """VCF records of tab-separated lines: fixed columns, alts and samples as arrays, and derived lengths. Header lines start with
    `#`. Lines with fewer than nine columns are an error, or where not strict records without the columns that are missing."""
    # exploded, so that no filter on a field is taken below the split and splits the line again
    p = F.explode(F.array(F.split(F.col("line"), "\t")))
    # and the line likewise, so that the filter on it isn't taken below and makes the line again
    rows = lines.select(F.col(ord_).alias("ord"), F.explode(F.array(line)).alias("line")).where(~F.col("line").startswith("#")).select("ord", p.alias("p"))
    if strict:
        rows = rows.withColumn("p", F.when(F.size("p") >= len(FIXED), F.col("p")).otherwise(F.raise_error(F.concat(F.lit("fewer than 9 columns: "), F.array_join("p", "\t"))).cast("array<string>")))
    at = lambda k: F.get("p", k)
    ref, pos = at(3), at(1).cast("long") if strict else at(1).try_cast("long")
    return rows.select(
        "ord", at(0).alias("chrom"), pos.alias("pos"), at(2).alias("id"), ref.alias("ref"), F.split(at(4), ",").alias("alts"),
        F.coalesce(at(5).try_cast("double"), F.lit(0.0)).alias("qual"), at(5).alias("qual_text"), at(6).alias("filter"), at(7).alias("info"), at(8).alias("format"),
        F.slice("p", len(FIXED) + 1, F.greatest(F.size("p") - len(FIXED), F.lit(0))).alias("samples"),
        F.length(ref).cast("long").alias("ref_len"), (pos + F.length(ref) - 1).alias("ref_end"), F.size("p").alias("n_columns"),
    )


def scan_vcf(spark: SparkSession, path: str) -> DataFrame:
    """Records of plain or gzip VCF files; ord is the line number in the file."""
    return records(numbered_lines(spark, path).where("value <> ''"), "value", "line_no")


def header_samples(lines: DataFrame, line: str = "line") -> DataFrame:
    """(idx, sample) of the #CHROM line, and so the index of a named sample."""
    names = F.split(F.col(line), "\t")
    head = lines.where(F.col(line).startswith("#CHROM")).select(F.slice(names, len(FIXED) + 1, F.greatest(F.size(names) - len(FIXED), F.lit(0))).alias("s"))
    return head.select(F.posexplode("s").alias("idx", "sample"))


def sample_index(lines: DataFrame, name: str, line: str = "line") -> DataFrame:
    """One row with the sample's index; a missing sample is an error."""
    found = header_samples(lines, line).where(F.col("sample") == name).agg(F.min("idx").alias("idx"))
    return found.select(F.when(F.col("idx").isNull(), F.raise_error(F.lit(f"no sample {name}")).cast("int")).otherwise(F.col("idx")).alias("idx"))


def vcf_line(df: DataFrame) -> DataFrame:
    """Records back to lines, with chrom and pos for sorting; QUAL keeps its text."""
    cols = ["chrom", F.col("pos").cast("string"), "id", "ref", F.array_join("alts", ","), "qual_text", "filter", "info", "format", F.array_join("samples", "\t")]
    return df.select("chrom", "pos", "ord", F.concat_ws("\t", *cols).alias("line"))


def write_lines(df: DataFrame, path: str, line: str = "line", header: list[str] | None = None) -> None:
    """Lines with chrom, pos and ord, sorted by chromosome text and position; the header is the first file. gzip if the path ends so."""
    codec = "gzip" if path.endswith(".gz") else "none"
    spark = df.sparkSession
    if header:
        spark.createDataFrame([("\n".join(header),)], "value string").coalesce(1).write.mode("append").option("compression", codec).text(path + "/part=0")
    body = df.orderBy("chrom", "pos", "ord").select(F.col(line).alias("value"))
    body.write.mode("append").option("compression", codec).text(path + "/part=1")


def write_vcf(header: DataFrame, body: DataFrame, path: str, order: tuple[str, ...] = ("chrom", "pos", "ord")) -> None:
    """Header lines (n, ord, line) and records (line and the columns of the order) as a folder whose files, by name, are the VCF; gzip if the path
    ends so."""
    codec = "gzip" if path.endswith(".gz") else "none"
    put = lambda df, part, by: df.orderBy(*by).select(F.col("line").alias("value")).write.option("compression", codec).text(f"{path}/part={part}")
    put(header, 0, ("n", "ord", "line"))
    put(body, 1, order)


def write_split(df: DataFrame, path: str, by: str, line: str = "line", codec: str = "none") -> None:
    """One folder of lines for each class; codec: none or gzip."""
    df.select(F.col(by), F.col(line).alias("value")).write.partitionBy(by).option("compression", codec).text(path)


def scan_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq, len): records are split at `>`, line ends inside a sequence are dropped. A record is a row; long contigs are read by scan_contigs."""
    raw = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    head = F.split("value", "\n", 2)
    seq = F.regexp_replace(F.coalesce(F.get(head, 1), F.lit("")), r"\s", "")
    return raw.select(F.get(F.split(F.trim(head[0]), r"\s+"), 0).alias("name"), seq.alias("seq"), F.length(seq).cast("long").alias("len"))


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of file splits, in order, as (file, block, n, contig, at, bases, head): the contig whose header came before in the same split (null before the
    first), the bases since then, and whether the line is the header."""
    where, n, contig, at = None, 0, None, 0
    for b in batches:
        names, starts, bases, numbers, heads = [], [], [], [], []
        for file, block, line in zip(*(b.column(k).to_pylist() for k in ("file", "block", "value")), strict=True):
            if (file, block) != where:
                where, n, contig, at = (file, block), 0, None, 0
            heads.append(line.startswith(">"))
            if heads[-1]:
                contig, at, line = (line[1:].split() or [""])[0], 0, ""
            else:
                line = "".join(line.split())
            names.append(contig)
            starts.append(at)
            bases.append(line.encode())
            numbers.append(n)
            at += len(bases[-1])
            n += 1
        yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block"), pa.array(numbers, pa.int64()), pa.array(names, pa.string()), pa.array(starts, pa.int64()), pa.array(bases, pa.binary()), pa.array(heads)], ["file", "block", "n", "contig", "at", "bases", "head"])


def scan_contigs(spark: SparkSession, path: str, chunk: int = 1 << 13) -> DataFrame:
    """FASTA files as pieces (chrom, piece, bases): `chunk` bases each (binary, the last one shorter), so that no row holds a contig. A contig without
    bases is one empty piece; a name that comes twice is an error; a byte is a base.

    Each split of a file counts its own lines; the contig that a split begins in, and the bases of it so far, are carried over from the
    splits before, a row each. Lines go once through a shuffle, by piece."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = raw.mapInArrow(_located, "file string, block long, n long, contig string, at long, bases binary, head boolean")
    tail = F.max_by(F.struct("contig", (F.col("at") + F.length("bases")).alias("size")), "n")
    ends = rows.groupBy("file", "block").agg(tail.alias("t")).select("file", "block", "t.contig", "t.size")
    order = Window.partitionBy("file").orderBy("block")  # a row a split
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = ends.withColumn("upto", F.sum("size").over(order)).withColumn("from", F.when(F.col("contig").isNotNull(), F.col("upto") - F.col("size")))
    carried = upto.select("file", "block", F.last("contig", True).over(earlier).alias("c_contig"), (F.last("upto").over(earlier) - F.coalesce(F.last("from", True).over(earlier), F.lit(0))).alias("c_size"))
    lines = rows.join(carried, ["file", "block"])
    own = F.col("contig").isNotNull()
    lines = lines.select(F.coalesce("contig", "c_contig").alias("chrom"), F.when(own, F.col("at")).otherwise(F.col("at") + F.coalesce("c_size", F.lit(0))).alias("at"), "bases", "head").where("chrom is not null and (head or length(bases) > 0)")
    first, last = F.floor(F.col("at") / chunk), F.floor((F.col("at") + F.greatest(F.length("bases"), F.lit(1)) - 1) / chunk)
    parts = lines.select("chrom", "at", "bases", "head", F.explode(F.sequence(first, last)).alias("piece"))
    lo = F.greatest(F.col("piece") * chunk - F.col("at"), F.lit(0))
    hi = F.least((F.col("piece") + 1) * chunk - F.col("at"), F.length("bases").cast("long"))
    parts = parts.select("chrom", "piece", (F.col("at") + lo).alias("at"), F.substring("bases", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("bases"), "head")
    held = F.array_sort(F.collect_list(F.struct("at", "bases")))  # a piece's lines
    out = parts.groupBy("chrom", "piece").agg(F.transform(held, lambda x: x["bases"]).alias("b"), F.sum(F.length("bases")).alias("size"), F.sum(F.col("head").cast("int")).alias("heads"))
    twice = F.raise_error(F.concat(F.lit("contig name twice: "), F.col("chrom"))).cast("binary")
    joined = F.aggregate("b", F.lit(b"").cast("binary"), lambda x, y: F.concat(x, y))
    return out.select("chrom", "piece", F.when((F.col("heads") > 1) | (F.col("size") > chunk), twice).otherwise(joined).alias("bases"))


def contig_lengths(pieces: DataFrame) -> DataFrame:
    """(chrom, len) of contigs in pieces."""
    return pieces.groupBy("chrom").agg(F.sum(F.length("bases")).cast("long").alias("len"))


def fasta_record(name: Column, seq: Column, width: int | None = None) -> Column:
    """One FASTA record without the final line end; lines of `width` bases, or one line."""
    body = seq if width is None else F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")
    return F.concat(F.lit(">"), name, F.lit("\n"), body)


def write_fasta(df: DataFrame, path: str, width: int | None = None) -> None:
    """name and seq; on one line each unless a width is given."""
    df.select(fasta_record(F.col("name"), F.col("seq"), width).alias("value")).write.text(path)


def mate_files(spark: SparkSession, path: str, mates: str) -> DataFrame:
    """(file, pair) of both read sets: files pair by their rank among the sorted paths. Sets of different numbers of files, or
    partition folders (`key=value`) that differ within a pair, are an error."""
    sides = [sorted(f.replace(":///", ":/") for f in spark.read.text(p).inputFiles()) for p in (path, mates)]  # as _metadata spells them
    folders = [[re.findall(r"(?<=/)[^/=]+=[^/]*(?=/)", f) for f in side] for side in sides]
    if folders[0] != folders[1]:
        raise ValueError(f"mates: {len(sides[0])} and {len(sides[1])} files, or other partition folders, in {path} and {mates}")
    return spark.createDataFrame([(f, k) for side in sides for k, f in enumerate(side)], "file string, pair long")


def scan_fastq(spark: SparkSession, path: str, mates: str | None = None) -> DataFrame:
    """(file, idx, name, seq, qual[, seq2, qual2]): four lines a read; mates are joined by pair of files and index, so the shorter
    file of a pair ends both. Lines of a read, and of its mate, meet in one grouping: each text is shuffled once."""
    name = lambda head: F.substring_index(F.substring(head, 2, 1 << 30), " ", 1).alias("name")
    lines = lambda p: numbered_lines(spark, p).select("file", F.floor(F.col("line_no") / 4).alias("idx"), (F.col("line_no") % 4).alias("k"), "value")
    of = lambda k, side=F.lit(True): F.max(F.when((F.col("k") == k) & side, F.col("value")))
    if mates is None:
        return lines(path).groupBy("file", "idx").agg(name(of(0)), of(1).alias("seq"), of(3).alias("qual"))
    files = F.broadcast(mate_files(spark, path, mates))  # a row a file, of lists that the driver has anyway
    no_pair = F.raise_error(F.concat(F.lit("no pair for "), F.col("file"))).cast("long")
    both = lines(path).withColumn("mate", F.lit(False)).unionByName(lines(mates).withColumn("mate", F.lit(True)))
    both = both.withColumn("file", F.replace("file", F.lit(":///"), F.lit(":/"))).join(files, "file", "left").withColumn("pair", F.coalesce("pair", no_pair))
    own, other = ~F.col("mate"), F.col("mate")
    texts = [name(of(0, own)), of(1, own).alias("seq"), of(3, own).alias("qual"), of(1, other).alias("seq2"), of(3, other).alias("qual2")]
    reads = both.groupBy("pair", "idx").agg(F.max(F.when(own, F.col("file"))).alias("file"), *texts, F.bool_or("mate").alias("some"), F.bool_and("mate").alias("all"))
    return reads.where("some and not all").select("file", "idx", "name", "seq", "qual", "seq2", "qual2")


def fastq_record(name: Column, seq: Column) -> Column:
    return F.concat(F.lit("@"), name, F.lit("\n"), seq, F.lit("\n+\n"), F.regexp_replace(seq, ".", "I"))


def scan_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(name, read1, read2): blank lines, `#` lines and the read1_path heading are skipped; fewer than two fields is an error."""
    v = F.trim("value")
    rows = spark.read.text(path).where((v != "") & ~v.startswith("#") & ~v.contains("read1_path")).select(F.split(v, r"\s+").alias("f"))
    rows = rows.withColumn("f", F.when(F.size("f") >= 2, F.col("f")).otherwise(F.raise_error(F.lit("sample sheet: fewer than two fields")).cast("array<string>")))
    return rows.select(F.get("f", 0).alias("name"), F.get("f", 1).alias("read1"), F.get("f", 2).alias("read2"))


def scan_intervals(spark: SparkSession, path: str, schema: str = "chrom string, length long") -> DataFrame:
    """Chromosome lengths, or with another schema sample groups: tab-separated."""
    return spark.read.csv(path, sep="\t", schema=schema)


def contig_header(header: DataFrame, contigs: DataFrame, line: str = "line") -> DataFrame:
    """Header lines with fresh ##contig lines before #CHROM; old ones are dropped. Adds n, the place of each line's kind."""
    kept = header.where(~F.col(line).startswith("##contig")).select(F.when(F.col(line).startswith("#CHROM"), F.lit(2)).otherwise(F.lit(0)).alias("n"), F.col(line).alias("line"))
    fresh = contigs.select(F.lit(1).alias("n"), F.format_string("##contig=<ID=%s,length=%d>", F.col("chrom"), F.col("len")).alias("line"))
    return kept.unionByName(fresh)


# The FORMAT lines of a merged file.
MERGE_FORMATS = (
    '##FORMAT=<ID=SO,Number=1,Type=String,Description="Software">',
    '##FORMAT=<ID=DP,Number=1,Type=Float,Description="Total filtered read depth used for genotyping.">',
    '##FORMAT=<ID=ADP,Number=1,Type=Float,Description="Average depth">',
    '##FORMAT=<ID=NDP,Number=1,Type=Float,Description="Depth after z-score normalization">',
)


def merge_header(header: DataFrame, sample: str, line: str = "line") -> DataFrame:
    """Header of a merged file: the four FORMAT lines, and #CHROM cut to the fixed columns and one sample."""
    other = header.where(~F.col(line).startswith("#CHROM")).select(F.lit(0).alias("n"), F.col(line).alias("line"))
    formats = header.sparkSession.createDataFrame([(1, x) for x in MERGE_FORMATS], "n int, line string")
    names = F.split(F.col(line), "\t")
    chrom = header.where(F.col(line).startswith("#CHROM")).select(F.lit(2).alias("n"), F.when(F.array_contains(names, sample), F.concat_ws("\t", F.array_join(F.slice(names, 1, len(FIXED)), "\t"), F.lit(sample))).otherwise(F.raise_error(F.lit(f"no sample {sample}"))).alias("line"))
    return other.unionByName(formats).unionByName(chrom)
