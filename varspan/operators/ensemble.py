"""Genotypes of several callers combined: last writer, depth statistics, vote, most similar sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varspan.functions.variant import short_number


def last_writer(matches: DataFrame, key: tuple[str, ...], order: str = "ord") -> DataFrame:
    """Several calls of one caller on one site: the last takes the haplotype slot."""
    value = [c for c in matches.columns if c not in key]
    return matches.groupBy(*key).agg(F.max_by(F.struct(*value), order).alias("v")).select(*key, "v.*")


def caller_depth(calls: DataFrame, by: tuple[str, ...] = ("caller",), depth: str = "depth") -> DataFrame:
    """Mean, population variance and standard deviation of depth sums, over all rows before any filter."""
    return calls.groupBy(*by).agg(F.avg(depth).alias("mean"), F.var_pop(depth).alias("variance"), F.stddev_pop(depth).alias("sd"))


def with_z(cube: DataFrame, stats: DataFrame, by: tuple[str, ...] = ("caller",)) -> DataFrame:
    """Adds z = (depth - mean) / sd of the caller; null where sd is 0."""
    j = cube.join(F.broadcast(stats), list(by))  # a row for each caller
    return j.withColumn("z", F.try_divide(F.col("depth") - F.col("mean"), F.col("sd")))


def taken(matches: DataFrame, by: tuple[str, ...], place: tuple[str, ...] = (), depths: tuple[str, str] = ("depth", "depth")) -> DataFrame:
    """(site_id, by, x, y): of the calls of one caller that take a first haplotype (x) or a second one (y) of a site the last, by position, then
    call_id: pos, call_id, allele, depth; null where none does. matches: call_id, by, pos, site_id, a0, a1 (alleles of the haplotypes), and their depths.

    place: columns that matches are partitioned by, where the last calls are found first. What is left is dealt out once, by site, for all that follows."""
    last = lambda k: F.max(F.when(F.col(f"a{k}").isNotNull(), F.struct("pos", "call_id", F.col(f"a{k}").alias("allele"), F.col(depths[k]).cast("double").alias("depth"))))
    own = matches.groupBy(*place, "site_id", *by).agg(last(0).alias("x"), last(1).alias("y")).select("site_id", *by, "x", "y")
    return own.repartition("site_id").groupBy("site_id", *by).agg(F.max("x").alias("x"), F.max("y").alias("y"))


def slots(taken: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(site_id, by, hap, allele, call_id, depth) of taken(): a row for each haplotype that a call takes."""
    haps = F.explode(F.array(*[F.struct(F.lit(k).alias("hap"), F.col(v).alias("v")) for k, v in enumerate("xy")])).alias("m")
    return taken.select("site_id", *by, haps).where("m.v is not null").select("site_id", *by, "m.hap", "m.v.allele", "m.v.call_id", "m.v.depth")


def cube(taken: DataFrame, sites: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(site_id, by, gt, depth, sv_len) of taken(): a haplotype that nobody took is 0, depths of the two add up, and the length is that of
    the last allele other than 0 at the site. sites: site_id, lens (REF length, then each ALT's)."""
    j = taken.join(sites.select("site_id", "lens").hint("merge"), "site_id")
    x, y = (F.coalesce(F.col(f"{v}.allele"), F.lit(0)) for v in "xy")
    depth = F.coalesce(F.col("x.depth") + F.col("y.depth"), "x.depth", "y.depth")
    last = F.when(y != 0, y).otherwise(x)
    return j.select("site_id", *by, F.concat_ws("|", x.cast("string"), y.cast("string")).alias("gt"), depth.alias("depth"), (F.get("lens", last) - F.get("lens", F.lit(0))).alias("sv_len"))


def merged_lines(voted: DataFrame, cube_: DataFrame | None, stats: DataFrame, base: DataFrame, key: tuple[str, ...], as_named: bool = False, by: tuple[str, ...] = ("caller",)) -> DataFrame:
    """(key, line) of sites with a chosen caller: the site's first eight columns, FORMAT, and the chosen genotype, caller, normalised
    depth, the caller's mean depth and the depth, numbers cut to five characters. The values stand in this order under the FORMAT
    GT:SO:DP:ADP:NDP, as in merged files that the callers' users have; with as_named each stands under its own name: depth, mean, normalised.
    base: site_id, fixed (text); cube_ has z. Without cube_, voted has z and depth, as vote gives them where asked. stats: by (a caller, or a caller of a sample), mean."""
    c = voted.where("chosen is not null").withColumnRenamed("chosen", "caller")
    if cube_ is not None:
        c = c.select(*key, "caller").hint("merge").join(cube_.select(*key, "caller", "gt", "z", "depth"), [*key, "caller"])
    c = c.join(F.broadcast(stats.select(*by, "mean")), list(by)).join(base.select("site_id", "fixed").hint("merge"), "site_id")  # a row a caller
    numbers = [short_number(F.col(x)) for x in (("depth", "mean", "z") if as_named else ("z", "mean", "depth"))]
    value = F.concat_ws(":", F.replace("gt", F.lit("|"), F.lit("/")), "caller", *numbers)
    return c.select(*key, F.concat_ws("\t", "fixed", F.lit("GT:SO:DP:ADP:NDP"), value).alias("line"))


def depth_rank(cube: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Place of each caller at a site by |z|; null z comes last, ties by caller name."""
    w = Window.partitionBy(*key).orderBy(F.abs("z").asc_nulls_last(), "caller")
    return cube.withColumn("rank", F.row_number().over(w))


def vote(cube: DataFrame, key: tuple[str, ...], n_callers: int, mode: str = "all", more: tuple[str, ...] = ()) -> DataFrame:
    """One caller for each site, or none: key, n, f, chosen and the chosen genotype and length, and more columns of the chosen caller.

    cube: key, caller, gt (text), z, sv_len. f is the size of the largest group of equal genotypes, best the first caller by name in a group of
    that size, near the caller with the smallest |z|; the length is that of the last caller's genotype."""
    w = Window.partitionBy(*key)
    cube = cube.repartition(key[0])  # one exchange for both windows and the groups, and none for a cube that is dealt out by site
    g = cube.withColumn("same", F.count("*").over(Window.partitionBy(*key, "gt"))).withColumn("f", F.max("same").over(w))
    far = F.struct(F.col("z").isNull(), F.abs("z"), F.col("caller"))
    s = g.groupBy(*key).agg(
        F.count("*").alias("n"), F.max("f").alias("f"), F.min(F.when(F.col("same") == F.col("f"), F.col("caller"))).alias("best"),
        F.min_by("caller", far).alias("near"), F.max_by("sv_len", "caller").alias("len"),
        F.max(F.when(F.col("caller") == "Paragraph", 1).otherwise(0)).alias("paragraph"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("caller", F.struct("gt", *more))))).alias("held"),  # one entry a caller
    )
    many, near, best, none = F.col("f") >= 2, F.col("near"), F.col("best"), F.lit(None).cast("string")
    if mode == "specific":
        chosen = F.when(many, best).otherwise(near)
    else:
        short = F.when(F.lit(n_callers == 1), best).when(F.lit(n_callers == 2) & (F.col("paragraph") == 1), near).when(~many, none).otherwise(best)
        long = F.when(F.lit(n_callers == 1), best).when(~many, near).otherwise(best)
        chosen = F.when(F.lit(n_callers >= 2) & (F.col("n") < 2), none).when(F.abs("len") <= 49, short).otherwise(long)
    of = F.element_at("held", F.col("chosen"))
    return s.withColumn("chosen", chosen).select(*key, "n", "f", "len", "chosen", *[of[c].alias(c) for c in ("gt", *more)])


def similar_sample(voted: DataFrame, panel: DataFrame, sample: str = "sample_id", site: str = "site_id") -> DataFrame:
    """For each voted sample the panel sample whose non-reference genotype equals the voted one most often, the lowest number on ties, and
    the share of voted sites; no row without a match. voted: sample, site, gt; panel: site, panel_sample, gt; each site once. Or panel: site, gts, an
    array with a genotype for each sample, numbered from 0.

    What is voted is written, as it is read twice. It meets the panel at each site, and equal genotypes are counted before they are shuffled."""
    from varspan.sources.text import checkpointed

    v = checkpointed(voted.where("gt is not null").select(sample, site, "gt"))
    both = v.join((panel if "gts" in panel.columns else panel.where("gt <> '0|0'")).withColumnRenamed("gt", "own").hint("merge"), site)
    if "gts" in panel.columns:
        both = both.where("gt <> '0|0'").select(sample, "gt", F.posexplode("gts").alias("panel_sample", "own"))
    # no filter on equal genotypes, which would become a key of the join and shuffle the panel once more
    n = both.groupBy(sample, "panel_sample").agg(F.count(F.when(F.col("gt") == F.col("own"), 1)).alias("n")).where("n > 0")
    top = n.groupBy(sample).agg(F.max(F.struct("n", (-F.col("panel_sample")).alias("k"))).alias("t"))
    total = v.groupBy(sample).agg(F.count("*").alias("total"))
    return top.join(total, sample).select(sample, (-F.col("t.k")).alias("panel_sample"), F.col("t.n").alias("n"), F.round(F.col("t.n") / F.col("total"), 6).alias("share"))


def high_conf(cube: DataFrame, panel: DataFrame, similar: DataFrame, key: tuple[str, ...], n_callers: int, sample: str = "sample_id", more: tuple[str, ...] = ()) -> DataFrame:
    """A second vote, by the specific rule, at sites where the panel sample most similar to the voted one is non-reference."""
    sites = panel.where("gt <> '0|0'").join(similar.select(sample, "panel_sample"), "panel_sample").select("site_id", sample)
    return vote(cube.join(sites, ["site_id", sample], "left_semi"), key, n_callers, "specific", more)
