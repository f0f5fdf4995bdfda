"""Counts, frequencies, densities and ordered passes over sites, and reads."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varspan.functions.variant import COUNT_EDGES, TYPES, bin_of, bins, variant_type
from varspan.operators.order import running

#: Positions in one block of an ordered pass.
BLOCK = 1_000_000


def variant_type_site(df: DataFrame) -> DataFrame:
    """Type from the REF length and the longest ALT; needs ref_len and alt_lens."""
    return df.withColumn("type", variant_type(F.col("ref_len"), F.array_max("alt_lens")))


def variant_type_allele(df: DataFrame) -> DataFrame:
    """One row an ALT, with its type, its length and whether the site has more ALTs."""
    d = df.select("*", F.posexplode("alt_lens").alias("allele", "alt_length"))
    return d.withColumns({"type": variant_type(F.col("ref_len"), F.col("alt_length")), "multi": F.size("alt_lens") > 1, "sv_len": F.col("alt_length") - F.col("ref_len")})


def count_types(df: DataFrame) -> DataFrame:
    """Alleles of each type, of sites with one ALT and with more."""
    n = lambda c: F.sum(c.cast("long"))
    return variant_type_allele(df).groupBy("type").agg(F.count("*").alias("n"), n(~F.col("multi")).alias("biallelic"), n(F.col("multi")).alias("multiallelic"))


def length_hist(df: DataFrame) -> DataFrame:
    """Count and absolute sum of lengths in 23 bins for three families; inversions by ALT length. Empty bins have zeros."""
    a = variant_type_allele(df)
    family = F.when(F.col("type") == "Inversion", "inversion").when(F.col("type") == "Duplication", "duplication").otherwise("sv")
    a = a.withColumn("family", family).withColumn("v", F.when(F.col("family") == "inversion", F.col("alt_length")).otherwise(F.col("sv_len")))
    a = a.groupBy("family", "v").agg(F.count("*").alias("n"))  # bins are told of distinct lengths
    g = a.withColumn("bin", bin_of(F.col("v"), COUNT_EDGES)).where("bin is not null").groupBy("family", "bin").agg(F.sum("n").alias("n"), F.abs(F.sum(F.col("v") * F.col("n"))).alias("total"))
    dim = df.sparkSession.createDataFrame([(f, k, lo, hi) for f in ("sv", "inversion", "duplication") for k, lo, hi in bins(COUNT_EDGES)], "family string, bin int, lo long, hi long")
    return F.broadcast(dim).join(g, ["family", "bin"], "left").na.fill(0, ["n", "total"])  # 69 rows


def maf_missing(panel: DataFrame, site: tuple[str, ...] = ("site_id",)) -> DataFrame:
    """Per site: frequency of the second allele over ploidy times samples, missing excluded; share of samples missing; samples called.

    panel: site, gt (array<int>, null alleles are missing). Alleles are counted by group, so a site of very many samples is no group."""
    s = panel.groupBy(*site).agg(F.count("*").alias("n"), F.sum(F.when(F.exists("gt", lambda g: g.isNull()), 1).otherwise(0)).alias("miss"), F.max(F.size("gt")).alias("ploidy"))
    counts = panel.select(*site, F.explode("gt").alias("allele")).where("allele is not null").groupBy(*site, "allele").agg(F.count("*").alias("c"))
    k = F.row_number().over(Window.partitionBy(*site).orderBy(F.desc("c"), "allele"))
    second = counts.withColumn("k", k).where("k = 2").select(*site, "c")
    j = s.join(second, list(site), "left")
    return j.select(*site, (F.coalesce("c", F.lit(0)) / (F.col("ploidy") * F.col("n"))).alias("maf"), (F.col("miss") / F.col("n")).alias("missing_rate"), (F.col("n") - F.col("miss")).alias("called"))


def filter_maf(sites: DataFrame, stats: DataFrame, maf: float = 0.01, geno: float = 0.1, site: tuple[str, ...] = ("site_id",)) -> DataFrame:
    """SNPs with a frequency of maf or more, at most geno missing and more than one sample called; other types pass. Needs type."""
    j = sites.join(stats, list(site), "left")
    good = (F.col("maf") >= maf) & (F.col("missing_rate") <= geno) & (F.col("called") > 1)
    return j.where((F.col("type") != "SNP") | F.coalesce(good, F.lit(False)))


def _windows(lengths: DataFrame, step: int) -> DataFrame:
    return lengths.select("chrom", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("len") - 1, F.lit(0)), F.lit(step).cast("long"))).alias("start"))


def _window_sums(panes: DataFrame, windows: DataFrame, group: list[str], sums: list[str], size: int) -> DataFrame:
    """(group, start, sums) of windows [start, start + size): panes (group, at, sums) are counted up to both ends, and the ends subtracted. Rows in
    order are panes and twice the windows, whatever the size and step."""
    end = lambda at, sign: F.struct(at.alias("at"), F.lit(sign).cast("long").alias("sign"))
    bounds = windows.select(*group, "start", F.explode(F.array(end(F.col("start"), -1), end(F.col("start") + size, 1))).alias("b"))
    bounds = bounds.select(*group, "b.at", F.lit(0).alias("k"), "start", "b.sign", *[F.lit(0).cast("long").alias(s) for s in sums])
    own = panes.select(*group, F.col("at").cast("long").alias("at"), F.lit(1).alias("k"), *[F.lit(None).cast("long").alias(x) for x in ("start", "sign")], *[F.col(s).cast("long").alias(s) for s in sums])
    r = running(own.unionByName(bounds), group, ["at", "k", "start"], sums).where("sign is not null")
    return r.groupBy(*group, "start").agg(*[F.sum(F.col("sign") * F.col(f"{s}_upto")).alias(s) for s in sums])


def window_density(df: DataFrame, lengths: DataFrame, size: int, step: int, types: tuple[str, ...] = TYPES) -> DataFrame:
    """Sliding windows [start, start + size) of each chromosome, every step bases: variants, their summed lengths, and types as text.

    Variants are counted in panes, of which windows are made up; empty windows have zeros. A type that isn't among the given ones is an error."""
    width = math.gcd(size, step)
    strange = F.raise_error(F.concat(F.lit("window_density: type "), F.col("type"))).cast("long")
    n = F.when(F.col("type").isin(*types) | F.col("type").isNull(), F.lit(1).cast("long")).otherwise(strange)
    kinds = [f"t{k}" for k in range(len(types))]
    panes = df.groupBy("chrom", (F.floor(F.col("pos") / width) * width).alias("at")).agg(
        F.sum(n).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("total"), *[F.count(F.when(F.col("type") == t, 1)).alias(k) for k, t in zip(kinds, types, strict=True)])
    w = _window_sums(panes, _windows(lengths, step), ["chrom"], ["n", "total", *kinds], size)
    held = F.array_compact(F.array(*[F.when(F.col(k) > 0, F.lit(t)) for k, t in zip(kinds, types, strict=True)]))
    return w.select("chrom", "start", "n", "total", F.array_join(F.array_sort(held), ",").alias("types"))


def window_groups(genotypes: DataFrame, groups: DataFrame, lengths: DataFrame, size: int, step: int) -> DataFrame:
    """Sliding windows as in window_density with the sample groups that have a variant in them: non-reference genotypes as text, group:n.

    genotypes: chrom, pos, sample, gt; groups: sample, grp. Samples without a group count for none. A chromosome's windows are counted for each of its groups."""
    width = math.gcd(size, step)
    g = genotypes.where(F.exists("gt", lambda a: a > 0)).join(groups, "sample")
    panes = g.groupBy("chrom", "grp", (F.floor(F.col("pos") / width) * width).alias("at")).agg(F.count("*").alias("n"))
    wins = _windows(lengths, step)
    each = wins.join(panes.select("chrom", "grp").distinct(), "chrom")
    v = _window_sums(panes, each, ["chrom", "grp"], ["n"], size).where("n > 0")
    text = F.concat("grp", F.lit(":"), F.col("n").cast("string"))
    v = v.groupBy("chrom", "start").agg(F.array_join(F.array_sort(F.collect_list(text)), ",").alias("groups"), F.sum("n").alias("n"))  # an entry a group
    return wins.join(v, ["chrom", "start"], "left").select("chrom", "start", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("groups", F.lit("")).alias("groups"))


def places(df: DataFrame) -> DataFrame:
    """Adds `place`, each record's place on its chromosome by position, then site_id, from 1."""
    from varspan.sources.text import ranked

    d = ranked(df, "chrom", "pos", "site_id")
    first = d.groupBy("chrom").agg(F.min("rank").alias("first"))  # a row a chromosome
    return d.join(first, "chrom").withColumn("place", F.col("rank") - F.col("first") + 1).drop("rank", "first")


def check_sorted(df: DataFrame, order: str = "ord") -> DataFrame:
    """Rows whose position drops within a run of one chromosome, in file order. Rows get their places by range partitions and meet the
    one before by its place."""
    from varspan.sources.text import ranked

    d = ranked(df.select(order, "chrom", "pos"), order)
    before = d.select((F.col("rank") + 1).alias("rank"), F.col("chrom").alias("p_chrom"), F.col("pos").alias("before"))
    return d.join(before, "rank").where((F.col("p_chrom") == F.col("chrom")) & (F.col("pos") < F.col("before"))).select(order, "chrom", "pos", "before")


def _chains(last: bool):
    """For records of one block of a chromosome, one at each position: where the chain that begins with a record ends (last), or the
    records of the chain that begins at `entry`."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        pos, end = rows["pos"].to_numpy(), rows["end"].to_numpy()
        after = np.searchsorted(pos, end, "right")
        if last:
            out = end.copy()
            for k in range(len(pos) - 1, -1, -1):
                if after[k] < len(pos):
                    out[k] = out[after[k]]
            return rows[["chrom", "_b", "pos"]].assign(out=out)
        kept, k = [], int(np.searchsorted(pos, rows["entry"].iloc[0]))
        while k < len(pos):
            kept.append(k)
            k = int(after[k])
        return rows.iloc[kept][["id", "chrom", "pos", "end"]]

    return run


def _after(ends: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
    """For ends that reach into a block the first position in it after each, where there is one."""
    pos = np.sort(block["pos"].to_numpy())
    at = np.searchsorted(pos, ends["out"].to_numpy(), "right")
    ok = at < len(pos)
    return ends.loc[ok, ["chrom", "out"]].assign(inside=pos[at[ok]])


def nonoverlap_greedy(df: DataFrame) -> DataFrame:
    """Per chromosome a record is kept if it begins after the end of the last kept one. Needs id, chrom, pos, end (long).

    Of records at one position only the one with the least end, then id, can be kept, so a block of positions is a bounded group. In
    each block a chain leads from every record to where it leaves the block; the record that comes next is in a later block. Chains
    soon run together, so few records are ever entered from outside: those that the first record of a chromosome leads to are
    found by doubling. Each entered block then gives its chain."""
    from varspan.sources.text import checkpointed

    d = df.select("chrom", "pos", F.struct("end", "id").alias("r")).groupBy("chrom", "pos").agg(F.min("r").alias("r"))
    d = checkpointed(d.select("r.id", "chrom", "pos", "r.end", F.floor(F.col("pos") / BLOCK).alias("_b")))
    kinds = dict(d.dtypes)
    leaves = d.select("chrom", "_b", "pos", "end").groupBy("chrom", "_b").applyInPandas(_chains(True), f"chrom string, _b long, pos {kinds['pos']}, out {kinds['end']}")
    leaves = checkpointed(leaves)
    # the next record after an end: in a later block that the end reaches into, or else the first of the block after it
    heads = leaves.groupBy("chrom", "_b").agg(F.min("pos").alias("head"))  # a row a block
    w = Window.partitionBy("chrom").orderBy("_b")
    after = heads.select("chrom", "_b", F.lead("_b").over(w).alias("_nb"), F.lead("head").over(w).alias("_nhead")).where("_nb is not null")
    after = after.select("chrom", F.explode(F.sequence("_b", F.col("_nb") - 1)).alias("_eb"), "_nhead")
    ends = leaves.select("chrom", "out", "_b").withColumn("_eb", F.floor(F.col("out") / BLOCK)).groupBy("chrom", "out", "_eb").agg(F.max(F.col("_eb") > F.col("_b")).alias("on"))
    reach = ends.where("on").groupBy("chrom", "_eb").cogroup(leaves.groupBy("chrom", "_b")).applyInPandas(_after, f"chrom string, out {kinds['end']}, inside {kinds['pos']}")
    following = ends.join(after, ["chrom", "_eb"], "left").join(reach, ["chrom", "out"], "left").select("chrom", "out", F.coalesce("inside", "_nhead").alias("next"))
    first = heads.groupBy("chrom").agg(F.min("head").alias("pos"))
    targets = following.where("next is not null").select("chrom", F.col("next").alias("pos")).unionByName(first).distinct()
    jump = checkpointed(leaves.join(targets, ["chrom", "pos"], "left_semi").join(following, ["chrom", "out"], "left").select("chrom", "pos", "next"))
    entered = checkpointed(first)
    while True:
        more = entered.join(jump, ["chrom", "pos"]).where("next is not null").select("chrom", F.col("next").alias("pos"))
        grown = checkpointed(entered.unionByName(more).distinct())
        if grown.count() == entered.count():
            break
        entered = grown
        twice = jump.select("chrom", F.col("pos").alias("next"), F.col("next").alias("far"))
        jump = checkpointed(jump.join(twice, ["chrom", "next"], "left").select("chrom", "pos", F.col("far").alias("next")))
    entry = entered.select("chrom", F.floor(F.col("pos") / BLOCK).alias("_b"), F.col("pos").alias("entry"))
    return d.join(entry, ["chrom", "_b"]).groupBy("chrom", "_b").applyInPandas(_chains(False), f"id {kinds['id']}, chrom string, pos {kinds['pos']}, end {kinds['end']}")


def seq_count(reads: DataFrame, by: tuple[str, ...] = (), seqs: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Reads, bases and whole mean length; both mates' columns add up."""
    each = [F.length(s).cast("long") for s in seqs]
    return reads.groupBy(*by).agg(F.sum(sum(each[1:], each[0])).alias("bases"), (F.count("*") * len(seqs)).alias("reads")).withColumn("mean_length", F.floor(F.col("bases") / F.col("reads")))


def cohort_min(facts: DataFrame) -> DataFrame:
    return facts.agg(F.min("depth").alias("depth"), F.min("read_length").alias("read_length"))


def batch_assign(samples: DataFrame, size: int, name: str = "name") -> DataFrame:
    """Samples in name order, `size` to a batch."""
    from varspan.sources.text import ranked

    return ranked(samples, name).withColumn("batch", F.floor(F.col("rank") / size)).drop("rank")


def hash_share(idx: Column, seed: int) -> Column:
    """A number in [0, 2**32) that follows from an index and a seed alone, alike in every engine and for both mates."""
    return F.conv(F.substring(F.md5(F.concat(idx.cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("long")


def sample_frac(reads: DataFrame, fraction: float, seed: int = 11, idx: str = "idx") -> DataFrame:
    """A fraction of the reads; mates of one index go together."""
    return reads.where(hash_share(F.col(idx), seed) < int(fraction * 2**32))


def _first_by_hash(reads: DataFrame, want: Column, seed: int, idx: str) -> DataFrame:
    """The first reads by hash, then index, as many as `want` says (of `total`, the number of reads). Hash ranges are counted, whole ranges are kept by
    a filter, and only the range that holds the last place is ranked."""
    bits = 20
    place = F.shiftright(hash_share(F.col(idx), seed), 32 - bits)
    counts = reads.groupBy(place.alias("_r")).agg(F.count("*").alias("c"))
    whole = Window.orderBy("_r")
    upto = counts.select("_r", "c", F.sum("c").over(whole).alias("u"), F.sum("c").over(Window.partitionBy()).alias("total")).withColumn("want", want)  # 2**20 rows at most
    cut = upto.where("u >= want and u - c < want").select(F.col("_r").alias("_cut"), (F.col("want") - F.col("u") + F.col("c")).alias("_take"))
    d = reads.withColumn("_r", place).join(F.broadcast(cut), F.col("_r") <= F.col("_cut"))  # one row, or none
    last = d.where("_r = _cut").withColumn("_k", F.row_number().over(Window.partitionBy("_r").orderBy(hash_share(F.col(idx), seed), idx))).where("_k <= _take")
    some = d.where("_r < _cut").select(*reads.columns).unionByName(last.select(*reads.columns))
    return some


def sample_n(reads: DataFrame, n: int, seed: int = 11, idx: str = "idx") -> DataFrame:
    """A fixed number of reads, the first by hash; all if there are no more."""
    return _first_by_hash(reads, F.least(F.lit(n).cast("long"), F.col("total")), seed, idx)


def sample_exact(reads: DataFrame, fraction: float, seed: int = 11, idx: str = "idx") -> DataFrame:
    """floor(N * fraction) of the reads, the first by hash."""
    return _first_by_hash(reads, F.floor(F.col("total") * F.lit(fraction)), seed, idx)


def downsample(reads: DataFrame, plan: DataFrame, by: str, seed: int = 11, idx: str = "idx") -> DataFrame:
    """Reads of each sample cut to its plan's fraction, if that is under 1. plan: by, fraction; a row a sample."""
    j = reads.join(plan.select(by, "fraction"), by)
    return j.where((F.col("fraction") >= 1) | (hash_share(F.col(idx), seed) < F.floor(F.col("fraction") * 2**32))).drop("fraction")


def sort_variants(df: DataFrame) -> DataFrame:
    return df.orderBy("chrom", "pos")


def union_units(parts: list[DataFrame], ordered: bool = True) -> DataFrame:
    """Units to one table, sorted by chromosome and position; regions are only put together."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return sort_variants(out) if ordered else out
