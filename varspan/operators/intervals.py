"""Binned interval joins: sites go to their own and both neighbouring bins, calls stay in one; then the exact test."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspan.operators.order import LARGEST, running

#: Widest start tolerance of any class, and so the bin width.
WIDTH = 200
#: Bases in a piece of a contig.
CHUNK = 1 << 13
#: Calls of a bin that are one key.
HOT_BIN = 100_000
#: Pairs of a cluster that one task settles in one pass.
MOST_PAIRS = 100_000


def binned_join(calls: DataFrame, sites: DataFrame, width: int, call_pos: str = "pos", site_pos: str = "s_pos", chrom: str = "chrom", site_chrom: str = "s_chrom", most: int = HOT_BIN, keep: bool = False) -> DataFrame:
    """All (call, site) of a chromosome whose positions are within `width`, each once. The key is (chromosome, bin, salt), so a dense
    chromosome is many keys. Bins with more than `most` calls, found by a count, are dealt over salts, and their sites copied to each: calls of one
    place go to many tasks. At most one bin in `most` calls is such a bin, and their list is broadcast. keep: _bin and _salt stay, the call's."""
    c = calls.withColumn("_bin", F.floor(F.col(call_pos) / width))
    hot = c.groupBy(F.col(chrom).alias("_hchrom"), F.col("_bin").alias("_hbin")).agg(F.count("*").alias("_calls")).where(F.col("_calls") > most)
    hot = F.broadcast(hot.select("_hchrom", "_hbin", F.ceil(F.col("_calls") / most).alias("_salts")))
    dealt = lambda df, at: df.join(hot, (F.col(at) == F.col("_hchrom")) & (F.col("_bin") == F.col("_hbin")), "left").withColumn("_salts", F.coalesce("_salts", F.lit(1).cast("long"))).drop("_hchrom", "_hbin")
    c = dealt(c, chrom).withColumn("_salt", F.when(F.col("_salts") > 1, F.pmod(F.xxhash64(*calls.columns), F.col("_salts"))).otherwise(F.lit(0).cast("long"))).drop("_salts")
    b = F.floor(F.col(site_pos) / width)
    s = dealt(sites.withColumn("_bin", F.explode(F.sequence(b - 1, b + 1))), site_chrom)
    s = s.withColumn("_ssalt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))).drop("_salts").withColumnRenamed("_bin", "_sbin")
    # a list of sites is small on disk and large as rows, three to an allele: it is dealt out, not broadcast
    joined = c.join(s.hint("merge"), (F.col(chrom) == F.col(site_chrom)) & (F.col("_bin") == F.col("_sbin")) & (F.col("_salt") == F.col("_ssalt")))
    return joined.where(F.abs(F.col(call_pos) - F.col(site_pos)) <= width).drop("_sbin", "_ssalt", *(() if keep else ("_bin", "_salt")))


def same_variant(pos: Column, ref: Column, qry: Column, tpos: Column, tref: Column, tqry: Column) -> Column:
    """Whether a call fits a site, by the call's class: start, exclusive end and length ratios within tolerance."""
    # each test stands once, so that four of them side by side stay one small piece of generated code
    grows, shrinks = (ref <= 2) & (qry >= 3), (ref >= 3) & (qry <= 2)
    within = F.when((ref >= 50) | (qry >= 50), 200).when(grows | shrinks, 10).otherwise(1)
    near = F.greatest(F.abs(pos - tpos), F.abs((pos + ref) - (tpos + tref))) <= within
    any_ref = (ref < 50) & ((qry >= 50) | grows)  # insertions: the REF lengths may differ
    any_qry = (qry < 50) & ((ref >= 50) | shrinks)  # deletions: the ALT lengths may differ
    return near & (any_ref | (F.abs(ref - tref) / tref <= 0.25)) & (any_qry | (F.abs(qry - tqry) / tqry <= 0.25))


def window_of(ref: Column, qry: Column) -> Column:
    """Search window of a call, from its first haplotype."""
    return F.when((ref <= 49) & (qry <= 49), F.lit(10)).otherwise(F.lit(200))


#: Where a call's pairs are made.
PLACE = ("chrom", "_bin", "_salt")


def match_calls(calls: DataFrame, sites: DataFrame, key: tuple[str, ...] = ("call_id",), carry: tuple[str, ...] = ()) -> DataFrame:
    """(PLACE, key, carry, site_id, a0, a1): the site that a call takes, a row a call, and the allele there of each haplotype (null: none). carry: more
    columns of the calls. Else as match_sites.

    A call is in one bin, so its pairs are grouped where they are made: none is shuffled."""
    s = sites.select("site_id", F.col("chrom").alias("s_chrom"), F.col("pos").alias("s_pos"), "lens")
    own = [*dict.fromkeys([*key, *carry, "g0", "g1"])]
    c = calls.select(*dict.fromkeys([*own, "chrom", "pos", "ref_len", "h0", "h1"]))
    near = binned_join(c, s, WIDTH, keep=True).where(F.abs(F.col("pos") - F.col("s_pos")) <= window_of(F.col("ref_len"), F.col("h0")))

    def lowest(h: str, g: str) -> Column:
        fits = lambda q, k: same_variant(F.col("pos"), F.col("ref_len"), F.col(h), F.col("s_pos"), F.get("lens", F.lit(0)), q) & ((F.col(g) == 0) == (k == 0))
        return F.array_min(F.transform("lens", lambda q, k: F.when(fits(q, k), k)))

    at = near.select(*dict.fromkeys([*PLACE, *own]), "site_id", "s_pos", lowest("h0", "g0").alias("n0"), lowest("h1", "g1").alias("n1"))
    first = lambda n: F.min(F.when(F.col(n).isNotNull(), F.struct("s_pos", "site_id", "n0", "n1")))
    j = at.where("n0 is not null or n1 is not null").groupBy(*dict.fromkeys([*PLACE, *own])).agg(first("n0").alias("m0"), first("n1").alias("m1"))
    a1 = F.when(F.col("m0").isNull(), F.col("m1.n1")).when(F.col("g0") == F.col("g1"), F.col("m0.n0")).otherwise(F.col("m0.n1"))
    return j.select(*dict.fromkeys([*PLACE, *key, *carry]), F.coalesce("m0.site_id", "m1.site_id").alias("site_id"), F.col("m0.n0").alias("a0"), a1.alias("a1"))


def match_sites(calls: DataFrame, sites: DataFrame, key: tuple[str, ...] = ("call_id",)) -> DataFrame:
    """(key, hap, site_id, allele): the site and allele that each haplotype takes.

    calls: key, chrom, pos, ref_len, h0, h1 (haplotype lengths), g0, g1 (alleles); sites: site_id, chrom, pos, lens (REF length,
    then each ALT's). Lowest position wins, then site_id, then allele. A second haplotype may use only the first's site."""
    haps = F.explode(F.array(*[F.struct(F.lit(k).alias("hap"), F.col(f"a{k}").alias("allele")) for k in (0, 1)])).alias("m")
    return match_calls(calls, sites, key).select(*key, "site_id", haps).select(*key, "m.hap", "site_id", "m.allele").where("allele is not null")


def matched_haplotypes(pairs: DataFrame, c: dict[str, Column], t: dict[str, Column]) -> DataFrame:
    """Pairs of a call and a truth row, each with pos, ref, h0, h1, g0, g1, that have a haplotype in common, with n_hap (haplotypes
    matched) and first (whether the call's first is). A truth haplotype is used once."""

    def fit(i: int, k: int) -> Column:
        ok = same_variant(c["pos"], c["ref"], c[f"h{i}"], t["pos"], t["ref"], t[f"h{k}"])
        return F.coalesce(ok & ((c[f"g{i}"] == 0) == (t[f"g{k}"] == 0)), F.lit(False))

    d = pairs.withColumns({f"_f{i}{k}": fit(i, k) for i in (0, 1) for k in (0, 1)}).where("_f00 or _f01 or _f10 or _f11")
    second = F.when(F.col("_f00"), F.col("_f11")).when(F.col("_f01"), F.col("_f10")).otherwise(F.col("_f10") | F.col("_f11"))
    first = F.col("_f00") | F.col("_f01")
    return d.withColumns({"n_hap": first.cast("int") + second.cast("int"), "first": first}).drop("_f00", "_f01", "_f10", "_f11")


def _sides(calls: DataFrame, truth: DataFrame, run: tuple[str, ...]) -> tuple[DataFrame, DataFrame, dict, dict]:
    c = calls.select(*run, "call_id", "chrom", F.col("pos").alias("c_pos"), F.col("ref_len").alias("c_ref"), F.col("h0").alias("c_h0"), F.col("h1").alias("c_h1"), F.col("g0").alias("c_g0"), F.col("g1").alias("c_g1"))
    t = truth.select("site_id", F.col("chrom").alias("t_chrom"), F.col("pos").alias("t_pos"), F.col("ref_len").alias("t_ref"), F.col("h0").alias("t_h0"), F.col("h1").alias("t_h1"), F.col("g0").alias("t_g0"), F.col("g1").alias("t_g1"))
    col = lambda p: {k: F.col(f"{p}_{k}") for k in ("pos", "ref", "h0", "h1", "g0", "g1")}
    return c, t, col("c"), col("t")


def match_exact(calls: DataFrame, truth: DataFrame, run: tuple[str, ...] = ()) -> DataFrame:
    """(run, call_id, site_id, n_hap) of calls at a truth row's position with a haplotype that fits."""
    c, t, cc, tc = _sides(calls, truth, run)
    j = c.join(t, (F.col("chrom") == F.col("t_chrom")) & (F.col("c_pos") == F.col("t_pos")))
    return matched_haplotypes(j, cc, tc).select(*run, "call_id", "site_id", "n_hap")


def _settled_together(run: tuple[str, ...]):
    """Calls of whole clusters in order, each taking its first unused truth row."""

    def settle(pairs: pd.DataFrame) -> pd.DataFrame:
        pairs = pairs.sort_values(["call_id", "late", "t_pos", "site_id"])
        used, calls, kept = set(), set(), []
        for k, row in enumerate(zip(*(pairs[c] for c in (*run, "call_id", "site_id")), strict=True)):
            call, site = row[:-1], (*row[:-2], row[-1])
            if call not in calls and site not in used:
                calls.add(call)
                used.add(site)
                kept.append(k)
        return pairs.iloc[kept][[*run, "call_id", "site_id", "n_hap"]]

    return settle


def clusters(pairs: DataFrame, run: tuple[str, ...] = ()) -> DataFrame:
    """Adds `cluster`, the first base of each pair's cluster on its chromosome: pairs whose spans (lo, hi) meet, directly or by others between.
    A span begins a cluster if it lies beyond the furthest end so far, which partitions carry on."""
    spans = pairs.groupBy(*run, "chrom", "lo").agg(F.max("hi").alias("hi"))
    group = [*run, "chrom"]
    far = running(spans, group, ["lo"], ["hi"], "max")
    first = far.withColumn("cut", F.when(F.col("hi_before").isNull() | (F.col("lo") > F.col("hi_before")), F.col("lo")))
    named = running(first.select(*group, "lo", F.coalesce("cut", F.lit(-LARGEST + 1)).alias("cut")), group, ["lo"], ["cut"], "max")
    named = named.select(*group, "lo", F.greatest("cut", "cut_before").alias("cluster"))
    return pairs.join(named, [*group, "lo"])


def match_truth(calls: DataFrame, truth: DataFrame, run: tuple[str, ...] = (), rounds: int | None = None, most: int = MOST_PAIRS) -> DataFrame:
    """(run, call_id, site_id, n_hap): each call, in order of call_id, takes its first unused truth row.

    A call's list is fixed: truth rows that fit its first haplotype by position, then those that fit its second. Pairs fall into clusters of
    touching spans, which don't concern each other: those of up to `most` pairs are settled in one pass, many in a task. The pairs of larger
    ones go through rounds: a call whose first row no earlier call lists takes it, and both leave; what is settled is written once. The
    loop ends when no pair is left; it is an error if that takes more than `rounds`, where given."""
    from varspan.sources.text import checkpointed

    c, t, cc, tc = _sides(calls, truth, run)
    near = binned_join(c.withColumnRenamed("c_pos", "pos"), t, WIDTH, "pos", "t_pos", "chrom", "t_chrom").withColumnRenamed("pos", "c_pos")
    near = near.where(F.abs(F.col("c_pos") - F.col("t_pos")) <= window_of(F.col("c_ref"), F.col("c_h0")))
    pairs = matched_haplotypes(near, cc, tc).select(
        *run, "chrom", F.least("c_pos", "t_pos").alias("lo"), F.greatest("c_pos", "t_pos").alias("hi"), "call_id", "site_id", "n_hap", (~F.col("first")).alias("late"), "t_pos")
    pairs = clusters(checkpointed(pairs), run)
    key = [*run, "chrom", "cluster"]
    sizes = pairs.groupBy(*key).agg(F.count("*").alias("size"))
    pairs = checkpointed(pairs.join(sizes, key))
    small, left = pairs.where(F.col("size") <= most), pairs.where(F.col("size") > most)
    facts = pairs.agg(F.sum((F.col("size") <= most).cast("long")).alias("n"), F.max("size").alias("top")).first()
    # clusters of a task: about `most` pairs together
    bucket = F.pmod(F.xxhash64(*key), F.lit(1 + (facts.n or 0) // max(most, 1)))
    kinds = ", ".join(f"{x} {k}" for x, k in pairs.select(*run, "call_id", "site_id", "n_hap").dtypes)
    done = small.select(*run, "call_id", "site_id", "n_hap", "late", "t_pos", bucket.alias("_b")).groupBy("_b").applyInPandas(_settled_together(run), kinds)
    if (facts.top or 0) <= most:
        return done
    done_parts, left, n = [done], left.select(*run, "call_id", "site_id", "n_hap", F.struct("late", "t_pos", "site_id").alias("rank")), 0
    while True:
        earliest = left.groupBy(*run, "site_id").agg(F.min("call_id").alias("earliest"))
        wish = left.groupBy(*run, "call_id").agg(F.min_by(F.struct("site_id", "n_hap"), "rank").alias("b")).select(*run, "call_id", "b.site_id", "b.n_hap")
        got = checkpointed(wish.join(earliest, [*run, "site_id"]).where("call_id = earliest").select(*run, "call_id", "site_id", "n_hap"))
        done_parts.append(got)
        left = left.join(got.select(*run, "call_id"), [*run, "call_id"], "left_anti").join(got.select(*run, "site_id"), [*run, "site_id"], "left_anti")
        left = checkpointed(left)
        if not left.limit(1).count():
            break
        n += 1
        if n == rounds:
            raise RuntimeError(f"match_truth: not settled after {rounds} rounds")
    out = done_parts[0]
    for part in done_parts[1:]:
        out = out.unionByName(part)
    return out


def nearby_small(sv: DataFrame, small: DataFrame, length: int = 100) -> DataFrame:
    """Per SV (id, chrom, start, end) the small variants (chrom, start, end) that end in [start - length, start] or begin in [end, end + length].

    Counts up to the bounds, taken in one order of bounds and variants, are subtracted from each other; no pair is made. Variants at one place
    are counted first."""
    points = lambda side, at: small.groupBy("chrom", F.col(at).cast("long").alias("at")).agg(F.count("*").alias("w")).select(F.lit(side).alias("side"), "chrom", "at", F.lit(1).alias("k"), "w", *[F.lit(None).cast("long").alias(x) for x in ("start", "end", "sign")])
    places = sv.select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")).distinct()
    # a lower bound stands before the variants of its place, an upper one after them
    bound = lambda side, at, upper: F.struct(F.lit(side).alias("side"), at.alias("at"), F.lit(2 * upper).alias("k"), F.lit(2 * upper - 1).cast("long").alias("sign"))
    start, end = F.col("start"), F.col("end")
    bounds = places.select("chrom", "start", "end", F.explode(F.array(bound(0, start - length, 0), bound(0, start, 1), bound(1, end, 0), bound(1, end + length, 1))).alias("b"))
    bounds = bounds.select("b.side", "chrom", "b.at", "b.k", F.lit(0).cast("long").alias("w"), "start", "end", "b.sign")
    both = points(0, "end").unionByName(points(1, "start")).unionByName(bounds)
    counted = running(both, ["side", "chrom"], ["at", "k", "start", "end"], ["w"]).where("sign is not null")
    n = counted.groupBy("chrom", "start", "end").agg(F.sum(F.col("sign") * F.col("w_upto")).alias("n"))
    keys = [F.col("v.chrom").eqNullSafe(F.col("p.chrom")), F.col("v.start") == F.col("p.start"), F.col("v.end") == F.col("p.end")]
    return sv.alias("v").join(n.alias("p"), keys, "left").select("v.id", F.coalesce("p.n", F.lit(0).cast("long")).alias("n"))


def nearby_bin(n: Column) -> Column:
    """Bins 0, 1, 2, 4, 6, 8; all other counts are `more`."""
    return F.when(n.isin(0, 1, 2, 4, 6, 8), n.cast("string")).otherwise("more")


def _cut(chunk: int):
    """Contigs in pieces: each piece is copied once out of the contig, which an array function would copy whole for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chrom, seq in zip(b.column("chrom").to_pylist(), b.column("seq"), strict=True):
                bases = seq.as_buffer()
                n = 1 if bases is None else max(1, -(-bases.size // chunk))
                for i in range(0, n, 1000):
                    ks = range(i, min(n, i + 1000))
                    parts = [None if bases is None else bases[k * chunk : (k + 1) * chunk].to_pybytes() for k in ks]
                    yield pa.RecordBatch.from_arrays([pa.array([chrom] * len(ks), pa.string()), pa.array(ks, pa.int64()), pa.array(parts, pa.binary())], ["c_chrom", "chunk", "_bases"])

    return run


def chunked(contigs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Contigs as (c_chrom, chunk, _bases): pieces of `chunk` bases as binary, where a place is found without a walk."""
    return contigs.select("chrom", "seq").mapInArrow(_cut(chunk), "c_chrom string, chunk long, _bases binary")


def ref_lookup(df: DataFrame, contigs: DataFrame, start: Column, length: Column, name: str = "bases_at", chunk: int = CHUNK) -> DataFrame:
    """Adds the reference bases of [start, start + length), 1-based, as far as the contig goes; null for unknown chromosomes. contigs: chrom and
    seq, or pieces of `chunk` bases (chrom, piece, bases), as sources.text.scan_contigs gives them.

    Each row asks for the pieces that its span covers, with its numbers alone; what they give is put together by row and joined
    back. A span of any length is found; bases are one byte each."""
    d = df.withColumns({"_at": start.cast("long"), "_n": F.greatest(length.cast("long"), F.lit(0).cast("long"))})
    at = F.greatest(F.col("_at"), F.lit(1).cast("long"))
    end = F.col("_at") + F.col("_n")  # exclusive
    span = F.struct(at.alias("at"), end.alias("end"))
    asked = d.select("chrom", span.alias("span")).where("span.end > span.at").distinct()
    first, last = F.floor((F.col("span.at") - 1) / chunk), F.floor((F.col("span.end") - 2) / chunk)
    asked = asked.select("chrom", "span", F.explode(F.sequence(first, last)).alias("_chunk"))
    whole = "seq" in contigs.columns
    pieces = chunked(contigs, chunk) if whole else contigs.select(F.col("chrom").alias("c_chrom"), F.col("piece").alias("chunk"), F.col("bases").alias("_bases"))
    # sizes of contigs and of what is found say little of their bases, which deflate well: neither is broadcast
    j = asked.join(pieces.hint("merge"), (F.col("chrom") == F.col("c_chrom")) & (F.col("_chunk") == F.col("chunk")))
    lo = F.greatest(F.col("span.at") - 1 - F.col("_chunk") * chunk, F.lit(0))
    hi = F.least(F.col("span.end") - 1 - F.col("_chunk") * chunk, F.lit(chunk))
    part = F.decode(F.substring("_bases", (lo + 1).cast("int"), (hi - lo).cast("int")), "UTF-8")
    parts = j.select("chrom", "span", "_chunk", part.alias("part")).groupBy("chrom", "span").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_chunk", "part"))), lambda p: p["part"]), "").alias("_found"))  # as many as a span has
    known = (contigs if whole else contigs.where("piece = 0")).select(F.col("chrom").alias("k_chrom"))  # a name a contig
    out = d.withColumn("_span", span).join(parts.select(F.col("chrom").alias("p_chrom"), F.col("span").alias("p_span"), "_found").hint("merge"), (F.col("chrom") == F.col("p_chrom")) & (F.col("_span") == F.col("p_span")), "left")
    out = out.join(known, F.col("chrom") == F.col("k_chrom"), "left")
    return out.withColumn(name, F.when(F.col("k_chrom").isNotNull(), F.coalesce("_found", F.lit("")))).drop("_at", "_n", "_span", "p_chrom", "p_span", "_found", "k_chrom")
