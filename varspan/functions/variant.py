"""Columns of variant records: fields, genotypes, depths, types and lengths. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Closed length bins of the counts (23) and of the evaluation (25).
COUNT_EDGES = (-999999, -9999, -4999, -2499, -999, -499, -399, -299, -199, -99, -49, 0, 1, 50, 100, 200, 300, 400, 500, 1000, 2500, 5000, 10000, 1000000)
EVAL_EDGES = (-999999, -9999, -4999, -2499, -999, -499, -399, -299, -199, -99, -49, -19, 0, 1, 20, 50, 100, 200, 300, 400, 500, 1000, 2500, 5000, 10000, 1000000)

#: Types that variant_type tells.
TYPES = ("SNP", "InDel", "Inversion", "Duplication", "Deletion", "Insertion", "Other")


def bins(edges: tuple[int, ...]) -> list[tuple[int, int, int]]:
    """(number, lo, hi) of the closed bins that start at the edges; the last edge ends the last bin."""
    return [(k, lo, hi - 1) for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))]


def bin_of(length: Column, edges: tuple[int, ...]) -> Column:
    """Number of the bin that holds a length; null outside all."""
    below = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= length))
    return F.when((below > 0) & (below < len(edges)), below - 1)


def field(format_: Column, sample: Column, key: str) -> Column:
    """Value of a FORMAT key in a sample column; null if the key is absent."""
    at = F.array_position(F.split(format_, ":"), key)
    first = (format_ == key) | format_.startswith(key + ":")  # as GT is: nothing to split
    return F.when(first, F.substring_index(sample, ":", 1)).when(at > 0, F.get(F.split(sample, ":"), (at - 1).cast("int")))


def info_number(info: Column, key: str) -> Column:
    """KEY=<digits> of INFO as a number; null if absent."""
    return F.nullif(F.regexp_extract(info, f"{key}=([0-9]+)", 1), F.lit("")).cast("double")


def alleles(gt: Column) -> Column:
    """Allele numbers of a genotype text; `.` and bad numbers are null."""
    # split at one character: a class of characters would be compiled anew for each sample; a `.` that is cast is an exception caught
    return F.transform(F.split(F.translate(gt, "|", "/"), "/"), lambda x: F.when(x != ".", x.try_cast("int")))


def gt_parse(format_: Column, sample: Column) -> Column:
    """struct(gt, missing): alleles with `.` as 0, and how many were missing, counted before that; no GT is 0/0."""
    a = alleles(F.coalesce(field(format_, sample, "GT"), F.lit("0/0")))
    return F.struct(F.transform(a, lambda x: F.coalesce(x, F.lit(0))).alias("gt"), F.size(F.filter(a, lambda x: x.isNull())).cast("long").alias("missing"))


def gt_phase(gt: Column) -> Column:
    """`a|b` of a genotype; `.`, 0, 0/0 and unknown ones are 0|0."""
    return F.when(gt.isNull() | gt.isin(".", "0", "0/0", "./.", ".|.", "0|0") | ~gt.rlike(r"^[0-9]+[/|][0-9]+$"), F.lit("0|0")).otherwise(F.replace(gt, F.lit("/"), F.lit("|")))


def gt_strict(format_: Column, sample: Column) -> Column:
    """Alleles of one sample; any missing or bad allele makes the whole genotype 0/0."""
    a = alleles(F.coalesce(field(format_, sample, "GT"), F.lit("0/0")))
    return F.when(F.exists(a, lambda x: x.isNull()), F.array(F.lit(0), F.lit(0))).otherwise(a)


def gt_diploid(gt: Column) -> Column:
    """Phased and diploid: a lone `.` is 0|0 as it is split, haploid a is a|0, more than two alleles are cut to two."""
    a = F.transform(F.split(F.when(gt == ".", F.lit(".|.")).when(gt == "0", F.lit("0|0")).otherwise(gt), r"[/|]"), lambda x: F.when(x == ".", F.lit("0")).otherwise(x))
    return F.when(F.size(a) == 1, F.concat(a[0], F.lit("|0"))).otherwise(F.array_join(F.slice(a, 1, 2), "|"))


def diploid_alleles(gt: Column) -> Column:
    """The two allele numbers of gt_diploid(); `.` is 0, a bad number null."""
    a = F.transform(F.split(F.translate(gt, "|", "/"), "/"), lambda x: F.when(x == ".", F.lit(0)).otherwise(x.try_cast("int")))
    return F.slice(F.concat(a, F.array(F.lit(0))), 1, 2)


def depths(format_: Column, sample: Column) -> Column:
    """Depth list of a sample: key DP, else MAC, else KC; -1 is 0; absent or bad is [0, 0]; one value serves both alleles."""
    text = F.coalesce(*[field(format_, sample, k) for k in ("DP", "MAC", "KC")])
    d = F.transform(F.split(text, ","), lambda x: x.try_cast("double"))
    bad = text.isNull() | F.exists(d, lambda x: x.isNull())
    fixed = F.transform(d, lambda x: F.when(x == -1, F.lit(0.0)).otherwise(x))
    return F.when(bad, F.array(F.lit(0.0), F.lit(0.0))).otherwise(fixed)


def score(info: Column, format_: Column, sample: Column, key: str) -> Column:
    """ROC score by `FORMAT.<k>` or `INFO.<k>`; 0 without the key."""
    where, name = key.split(".", 1)
    value = info_number(info, name) if where == "INFO" else field(format_, sample, name).try_cast("double")
    return F.coalesce(value, F.lit(0.0))


def variant_type(ref_len: Column, qry_len: Column) -> Column:
    """SNP, InDel, Inversion, Duplication, Deletion, Insertion or Other, by lengths."""
    d, ratio, big = qry_len - ref_len, qry_len / ref_len, (ref_len > 49) & (qry_len > 49)
    return (
        F.when((ref_len == 1) & (qry_len == 1), "SNP")
        .when(d.between(-49, 49) & (ref_len <= 49) & (qry_len <= 49), "InDel")
        .when(d.between(-2, 2) & big, "Inversion")
        .when(ratio.between(1.8, 2.2) & big, "Duplication")
        .when(d < 0, "Deletion")
        .when(d > 0, "Insertion")
        .otherwise("Other")
    )


def allele_lengths(id_: Column, ref: Column, alts: Column) -> Column:
    """struct(ref_len, lens): the REF length and that of each ALT. Symbolic alleles are sized from SVSIZE; the last one's REF length
    counts. IDs with Duplication and a REF of one or two bases: REF takes the ALT's length and the ALT twice that."""
    n = F.length(ref).cast("long")

    def one(alt: Column) -> Column:
        size = F.nullif(F.regexp_extract(alt, r"SVSIZE=(\d+)", 1), F.lit("")).cast("long")
        sized, own = alt.contains(">") & size.isNotNull(), F.length(alt).cast("long")
        ins, dele, dup = alt.contains("<INS"), alt.contains("<DEL"), alt.contains("<DUP")
        r = F.when(sized & ((dele & ~ins) | (dup & ~ins)), size).otherwise(n)
        q = F.when(sized & ins & ~dele, size).when(sized & dele & ~ins, n).when(sized & dup, size * 2).otherwise(own)
        twice = id_.contains("Duplication") & (r <= 2)
        return F.struct(F.when(twice, q).otherwise(r).alias("r"), F.when(twice, q * 2).otherwise(q).alias("q"), (alt.contains(">") | twice).alias("sets"))

    each = F.transform(alts, one)
    last = F.element_at(F.filter(each, lambda x: x["sets"]), -1)
    named = F.struct(F.coalesce(F.when(F.size(F.filter(each, lambda x: x["sets"])) > 0, last["r"]), n).alias("ref_len"), F.transform(each, lambda x: x["q"]).alias("lens"))
    # most records have neither symbols nor such an ID, and nothing to search their bases for
    return F.when(F.exists(alts, lambda a: a.contains(">")) | id_.contains("Duplication"), named).otherwise(F.struct(n.alias("ref_len"), F.transform(alts, lambda a: F.length(a).cast("long")).alias("lens")))


def hap_lengths(lengths: Column, gt: Column) -> Column:
    """Length of each haplotype of a genotype; one allele counts twice; an allele beyond the ALTs is null."""
    both = F.when(F.size(gt) == 1, F.concat(gt, gt)).otherwise(gt)
    return F.transform(both, lambda g: F.when(g == 0, lengths["ref_len"]).otherwise(F.get(lengths["lens"], g - 1)))


def sv_length(ref_len: Column, hap: Column, gt: Column) -> Column:
    """Haplotype minus REF length of the last non-zero haplotype; 0 without one."""
    own = F.filter(F.arrays_zip(hap.alias("h"), gt.alias("g")), lambda x: x["g"] != 0)
    return F.when(F.size(own) > 0, F.element_at(own, -1)["h"] - ref_len).otherwise(F.lit(0).cast("long"))


def clean_sequence(seq: Column) -> Column:
    """Upper-cased; what isn't A, T, G, C or N becomes N."""
    return F.regexp_replace(F.upper(seq), "[^ATGCN]", "N")


def short_number(x: Column) -> Column:
    """A number as text, cut to five characters; null is nan."""
    return F.coalesce(F.substring(F.format_string("%.6f", x), 1, 5), F.lit("nan"))
