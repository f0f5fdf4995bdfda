"""Operators on hand-made rows, and those without an oracle against a plain scan."""

import random
import re

from pyspark.sql import functions as F

from varspan.functions import variant as V
from varspan.operators import convert as C
from varspan.operators import intervals as I
from varspan.operators import sites as S
from varspan.sources import text as T

LINE = "chr1\t{pos}\tv\tA\t{alt}\t.\tPASS\tX=a#b;END=9\t{fmt}\t{s}"


def records(spark, rows):
    df = spark.createDataFrame([(k, LINE.format(**{"pos": 5, "alt": "T", "fmt": "GT:DP", "s": "0/1:3"} | r)) for k, r in enumerate(rows)], "ord long, line string")
    return T.records(df)


def test_fields(spark):
    rows = [{"s": "./.:7"}, {"s": "1:-1"}, {"fmt": "MAC:GT", "s": "4,5:.|1"}, {"fmt": "KC", "s": "x"}, {"s": "0/1"}]
    r = records(spark, rows).withColumn("s", F.get("samples", F.lit(0)))
    g = r.select("ord", V.gt_parse(F.col("format"), F.col("s")).alias("g"), V.depths(F.col("format"), F.col("s")).alias("d"), V.gt_strict(F.col("format"), F.col("s")).alias("m"), "qual", "info").orderBy("ord").collect()
    assert [tuple(x.g) for x in g] == [([0, 0], 2), ([1], 0), ([0, 1], 1), ([0, 0], 0), ([0, 1], 0)]
    assert [x.d for x in g] == [[7.0], [0.0], [4.0, 5.0], [0.0, 0.0], [0.0, 0.0]]
    assert g[2].m == [0, 0] and g[0].qual == 0.0 and g[0].info == "X=a#b;END=9"


def test_gt_diploid_and_phase(spark):
    df = spark.createDataFrame([(".",), ("0",), ("1",), ("0/1/2",), ("1/.",), ("2|1",)], "g string")
    got = df.select(V.gt_diploid(F.col("g")).alias("d"), V.gt_phase(F.col("g")).alias("p")).collect()
    assert [x.d for x in got] == ["0|0", "0|0", "1|0", "0|1", "1|0", "2|1"]
    assert [x.p for x in got] == ["0|0", "0|0", "0|0", "0|0", "0|0", "2|1"]


def test_few_columns_fail(spark):
    import pytest

    with pytest.raises(Exception, match="fewer than 9 columns"):
        T.records(spark.createDataFrame([(0, "chr1\t5")], "ord long, line string")).collect()


def test_gzip_vcf_round_trip(spark, tmp_path):
    path = f"{tmp_path}/x.vcf.gz"
    T.write_lines(T.vcf_line(records(spark, [{"pos": 30}, {"pos": 4}])), path, header=["##x", "#CHROM"])
    assert [r.pos for r in T.scan_vcf(spark, path).orderBy("ord").collect()] == [4, 30]


def test_trim_renumbers(spark):
    df = spark.createDataFrame([(["A", "C", "G"], [[0, 3], [1, 1]])], "alts array<string>, gts array<array<int>>")
    assert tuple(C.trim_alleles(df).first()) == (["A", "G"], [[0, 2], [1, 1]])


def truth_scan(calls, truth):
    """The sequential rule: calls in order, each takes its first unused truth row."""

    def fit(c, h, t, k):
        p, r, q = c["pos"], c["ref_len"], c[f"h{h}"]
        if (c[f"g{h}"] == 0) != (t[f"g{k}"] == 0):
            return False
        near = lambda w: abs(p - t["pos"]) <= w and abs(p + r - t["pos"] - t["ref_len"]) <= w
        rr, qq = abs(r - t["ref_len"]) / t["ref_len"] <= 0.25, abs(q - t[f"h{k}"]) / t[f"h{k}"] <= 0.25
        if r >= 50 and q < 50:
            return near(200) and rr
        if r < 50 and q >= 50:
            return near(200) and qq
        if r >= 50:
            return near(200) and rr and qq
        if r == 1 and q == 1:
            return near(1) and rr and qq
        if r >= 3 and q <= 2:
            return near(10) and rr
        if r <= 2 and q >= 3:
            return near(10) and qq
        return near(1) and rr and qq

    used, out = set(), {}
    order = sorted(truth, key=lambda t: (t["pos"], t["site_id"]))
    for c in sorted(calls, key=lambda c: c["call_id"]):
        width = 10 if c["ref_len"] <= 49 and c["h0"] <= 49 else 200
        near = [t for t in order if abs(t["pos"] - c["pos"]) <= width]
        for t in [t for h in (0, 1) for t in near if any(fit(c, h, t, k) for k in (0, 1))]:
            if t["site_id"] in used:
                continue
            k0 = next((k for k in (0, 1) if fit(c, 0, t, k)), None)
            out[c["call_id"]] = (t["site_id"], (k0 is not None) + any(fit(c, 1, t, k) for k in (0, 1) if k != k0))
            used.add(t["site_id"])
            break
    return out


def test_match_truth_is_sequential(spark):
    rng = random.Random(3)

    def row(key, i):
        kind = rng.choice([(1, 1), (1, 60), (80, 1), (5, 1)])
        r, q = (max(1, x + (rng.randrange(-x // 6, x // 6 + 1) if x > 5 else 0)) for x in kind)
        g0, g1 = rng.choice([(0, 1), (1, 1)])
        return {key: i, "chrom": "chr1", "pos": rng.randrange(900), "ref_len": r, "h0": q if g0 else r, "h1": q, "g0": g0, "g1": g1}

    calls, truth = [row("call_id", i) for i in range(120)], [row("site_id", i) for i in range(60)]
    got = I.match_truth(spark.createDataFrame(calls), spark.createDataFrame(truth)).collect()
    assert {r.call_id: (r.site_id, r.n_hap) for r in got} == truth_scan(calls, truth)


def test_match_truth_is_no_result_before_it_settles(spark):
    import pytest

    row = {"chrom": "chr1", "ref_len": 1, "h0": 60, "h1": 60, "g0": 1, "g1": 1}
    calls, truth = [{"call_id": i, "pos": 500} | row for i in range(4)], [{"site_id": i, "pos": 500 + i} | row for i in range(4)]
    frames = spark.createDataFrame(calls), spark.createDataFrame(truth)
    with pytest.raises(RuntimeError, match="not settled after 1 rounds"):
        I.match_truth(*frames, rounds=1, most=0)
    assert {r.call_id: r.site_id for r in I.match_truth(*frames, most=0).collect()} == {i: i for i in range(4)}


def test_nonoverlap_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 50)
    rng = random.Random(5)
    rows = [(i, "chr1", p, p + rng.choice([0, 3, 40, 120])) for i, p in enumerate(rng.choices(range(2000), k=200))]
    kept, last = [], -1
    for i, _, p, e in sorted(rows, key=lambda r: (r[2], r[3], r[0])):
        if p > last:
            kept.append(i)
            last = e
    df = spark.createDataFrame(rows, "id long, chrom string, pos long, end long")
    assert sorted(r.id for r in S.nonoverlap_greedy(df).collect()) == sorted(kept)


def test_check_sorted(spark):
    rows = [(0, "a", 5), (1, "a", 4), (2, "a", 9), (3, "a", 8), (4, "b", 1), (5, "b", 1)]
    assert sorted(r.ord for r in S.check_sorted(spark.createDataFrame(rows, "ord long, chrom string, pos long")).collect()) == [1, 3]


def test_binned_join_is_the_range_join(spark):
    rng = random.Random(1)
    a = [(i, "c", rng.randrange(-50, 3000)) for i in range(80)]
    b = [(i, "c", rng.randrange(-50, 3000)) for i in range(80)]
    got = I.binned_join(spark.createDataFrame(a, "i long, chrom string, pos long"), spark.createDataFrame(b, "j long, s_chrom string, s_pos long"), 37)
    assert sorted((r.i, r.j) for r in got.collect()) == sorted((x[0], y[0]) for x in a for y in b if abs(x[2] - y[2]) <= 37)


def fastq(names, seq):
    return "".join(f"@{n}\n{seq(n)}\n+\n{'I' * len(seq(n))}\n" for n in names)


def test_mates_of_several_files(spark, tmp_path):
    import pytest

    seq = lambda n: "ACGT" * (1 + int(n[1:]) % 7) + n
    files = {"a": ["r1", "r2", "r3"], "b": [], "c": ["r4", "r5"]}
    for side in ("one", "two"):
        (tmp_path / side).mkdir()
        for f, names in files.items():
            (tmp_path / side / f"{f}_{side}.fq").write_text(fastq(names[: 2 if side == "two" else 3], lambda n: seq(n)[::-1] if side == "two" else seq(n)))
    got = T.scan_fastq(spark, str(tmp_path / "one"), str(tmp_path / "two")).collect()
    assert sorted((r.name, r.seq, r.seq2) for r in got) == [(n, seq(n), seq(n)[::-1]) for n in ("r1", "r2", "r4", "r5")]
    (tmp_path / "two" / "d_two.fq").write_text("")
    with pytest.raises(ValueError, match="3 and 4 files"):
        T.scan_fastq(spark, str(tmp_path / "one"), str(tmp_path / "two"))


def test_scan_fastq_query_runs_over_several_files(spark, monkeypatch):
    from varspan.plans import record_queries as R

    seen, plain = [], T.scan_fastq
    monkeypatch.setattr(T, "scan_fastq", lambda *a: seen.append(plain(*a)) or seen[-1])
    sf = "/root/testdata/sf0.001"
    assert R.QUERIES["scan_fastq"](spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert seen[0].select("file").distinct().count() > 1
    assert seen[0].where("seq2 <> reverse(seq)").count() == 0


def test_scan_fastq_shuffles_texts_once_and_writes_gzip(spark, monkeypatch):
    from varspan.plans import record_queries as R

    seen, plain = [], T.scan_fastq
    monkeypatch.setattr(T, "scan_fastq", lambda s, *paths: seen.extend(paths) or plain(s, *paths))
    df = R.QUERIES["scan_fastq"](spark, "/root/testdata/sf0.001")
    files = [f for p in seen for f in spark.read.text(p).inputFiles()]
    assert len(files) > 2 and all(f.endswith(".gz") for f in files)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    of_texts = [x for x in plan.splitlines() if re.search(r"Join |Aggregate ", x) and "seq" in x]
    assert len(of_texts) == 1 and "Aggregate" in of_texts[0]
    assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_lookup_over_pieces_of_a_contig(spark):
    seq = "".join(random.Random(2).choices("ACGT", k=1000))
    rows = [(k, "chr1" if k % 9 else "chrX", p, n) for k, (p, n) in enumerate([(1, 1), (1, 0), (16, 2), (17, 16), (1, 1000), (990, 50), (500, 333), (1000, 1), (-3, 10), (33, 32)])]
    df = spark.createDataFrame(rows, "k long, chrom string, pos long, n long")
    contigs = spark.createDataFrame([("chr1", seq, 1000)], "chrom string, seq string, len long")
    got = {r.k: r.bases for r in I.ref_lookup(df, contigs, F.col("pos"), F.col("n"), "bases", chunk=16).collect()}
    assert got == {k: None if c == "chrX" else seq[max(p - 1, 0) : max(p - 1 + n, 0)] for k, c, p, n in rows}


def test_rank_is_the_place_in_the_order(spark):
    rows = [(k * 37 % 101 // 2, k) for k in range(300)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(7)
    got = {(r.a, r.b): r["rank"] for r in T.ranked(df, "a", "b").collect()}
    assert got == {r: k for k, r in enumerate(sorted(rows))}
    assert T.ranked(df.limit(0), "a", "b").count() == 0


def test_short_lines_are_told_by_convert(spark):
    lines = spark.createDataFrame([(0, "chr1\t5"), (1, LINE.format(pos=400, alt="TC", fmt="GT", s="0/1")), (2, LINE.format(pos=400, alt="T", fmt="GT", s="1/0")), (3, LINE.format(pos=900, alt="T", fmt="GT", s="0/0"))], "ord long, line string")
    contigs = spark.createDataFrame([("chr1", "A" * 2000, 2000)], "chrom string, seq string, len long")
    got = {r.ord: (r.reject_reason, r.line) for r in C.convert(T.records(lines, strict=False), contigs, 10).collect()}
    assert got[0] == ("columns", None) and got[3] == ("no_alt", None)
    assert got[1][1] == "chr1\t399\tv\tAA\tATC\t.\tPASS\tX=a#b;END=400\tGT\t0|1" and got[2][1] == "chr1\t400\tv\tA\tT\t.\tPASS\tX=a#b;END=400\tGT\t1|0"


def test_no_machine_local_folder_on_a_cluster():
    from types import SimpleNamespace as N

    import pytest

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        T.shared_folder(N(conf=N(get=lambda *_: ""), sparkContext=N(master="spark://host:7077")))


def test_stages_compile_whole(spark):
    """Generated code over 64 KB would make a stage fall back to slow paths without a word; here it is an error."""
    from varspan.plans import catalog

    assert spark.conf.get("spark.sql.codegen.fallback") == "false"  # for all tests
    for name in ("match_exact", "match_sites", "match_truth", "roc_table", "eval_summary", "eval_hist", "length_hist", "evaluate_vcf"):
        catalog.QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()  # all columns
