"""Whole commands on small hand-made files: results, and what is an error."""

import pytest
from pyspark.sql import functions as F

from varspan.functions import variant as V
from varspan.operators import flows
from varspan.sources import text as T

HEAD = "##fileformat=VCFv4.2\n##contig=<ID=old,length=1>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{names}\n"


def vcf(path, rows, names="s1"):
    path.write_text(HEAD.format(names=names.replace(" ", "\t")) + "".join("\t".join(r.split()) + "\n" for r in rows))
    return str(path)


def lines(spark, path):
    return [r.line for r in T.lines_of(spark, str(path)).orderBy("ord").collect()]


def test_convert_is_written_in_order_with_fresh_contigs(spark, tmp_path):
    (tmp_path / "r.fa").write_text(">chr2\n" + "ACGT" * 300 + "\n>chr1\n" + "TTGCA" * 200 + "\n")
    rows = ["chr2 900 b A C . PASS END=1 GT 0/1", "chr1 800 a A G . PASS . GT 1/1", "chr1 12 c T G . PASS . GT 1/1", "chr3 500 d A C . PASS . GT 0/1"]
    audit = flows.convert_files(spark, vcf(tmp_path / "in.vcf", rows), str(tmp_path / "r.fa"), str(tmp_path / "out"))
    assert {r.ord: r.reject_reason for r in audit.collect()} == {3: None, 4: None, 5: "near_start", 6: "unknown_chrom"}
    got = lines(spark, tmp_path / "out")
    assert got[:4] == ["##fileformat=VCFv4.2", "##contig=<ID=chr1,length=1000>", "##contig=<ID=chr2,length=1200>", HEAD.splitlines()[2].format(names="s1")]
    assert [x.split("\t")[:5] for x in got[4:]] == [["chr1", "800", "a", "A", "G"], ["chr2", "900", "b", "T", "C"]]


def test_delly_keeps_header_order_and_plain_alleles(spark, tmp_path):
    (tmp_path / "r.fa").write_text(">chr1\nACGTTGCA\n")
    rows = ["chr1 3 x N <DUP> . PASS END=5 GT 0/1", "chr1 1 y N <INV> . PASS SVTYPE=INV;END=4 GT 0/1", "chr1 2 z N <INS> . PASS END=3 GT 0/1", "chr1 2 w N GG . PASS END=3 GT 0/1", "chr1 2 v N <DEL> . LowQual END=3 GT 0/1", "chr1 2 u N N[chr2:5[ . PASS END=3 GT 0/1"]
    flows.delly_files(spark, vcf(tmp_path / "in.vcf", rows), str(tmp_path / "r.fa"), str(tmp_path / "out"))
    got = lines(spark, tmp_path / "out")
    assert got[:3] == HEAD.format(names="s1").splitlines()
    assert [x.split("\t")[2:5] for x in got[3:]] == [["x", "GTT", "GTTGTT"], ["y", "ACGT", "TGCA"], ["w", "CG", "GG"]]


BASE = ["chr1 100 a A C . PASS . GT 0/1 0/0", "chr1 500 b A ACG . PASS . GT 1/1 0/1", "chr2 50 c A G . PASS . GT 0/0 0/1"]


def test_merge_votes_and_names_the_similar_sample(spark, tmp_path):
    base = vcf(tmp_path / "base.vcf", BASE, "p1 p2")
    one = vcf(tmp_path / "one.vcf", ["chr1 100 x A C . PASS . GT:DP 0/1:10", "chr1 500 y A ACG . PASS . GT:DP 0/1:20", "chr2 50 z A G . PASS . GT:DP 0/1:30"], "s")
    two = vcf(tmp_path / "two.vcf", ["chr1 100 x A C . PASS . GT:DP 0/1:5", "chr1 500 y A ACG . PASS . GT:DP 0/1:5", "chr2 50 z A G . LowQual . GT:DP 0/1:5"], "s")
    three = vcf(tmp_path / "three.vcf", ["chr1 100 x A C . PASS . GT:DP 1/1:5", "chr1 500 y A ACG . PASS . GT:DP 0/1:4,2", "chr2 50 z A G . PASS . GT:DP 0/1:6"], "other s".split()[1])
    files = {"one": one, "two": two, "three": three}
    similar = flows.merge_files(spark, base, files, "s", str(tmp_path / "out"), second=str(tmp_path / "second")).first()
    got = lines(spark, tmp_path / "out")
    assert got[2:6] == list(T.MERGE_FORMATS) and got[6].endswith("FORMAT\ts")
    body = [x.split("\t") for x in got[7:]]
    assert [(x[0], x[1], x[8], x[9].split(":")[:2]) for x in body] == [("chr1", "100", "GT:SO:DP:ADP:NDP", ["0/1", "one"]), ("chr1", "500", "GT:SO:DP:ADP:NDP", ["0/1", "one"]), ("chr2", "50", "GT:SO:DP:ADP:NDP", ["0/1", "one"])]
    assert body[1][9] == "0/1:one:2.449:20.00:40.00"  # normalised, mean, depth of both haplotypes
    assert (similar.panel_sample, similar["name"], similar.n) == (1, "p2", 2)
    assert [x.split("\t")[1] for x in lines(spark, tmp_path / "second") if x[0] != "#"] == ["500", "50"]
    flows.merge_files(spark, base, files, "s", str(tmp_path / "named"), as_named=True)
    assert [x for x in lines(spark, tmp_path / "named") if x[0] != "#"][1].endswith("0/1:one:40.00:20.00:2.449")


@pytest.mark.parametrize("what, message", [("chromosome", "chromosome chrX is not in"), ("sample", "no sample s"), ("order", "not sorted at chr1:100"), ("mode", "mode none")])
def test_merge_errors(spark, tmp_path, what, message):
    base = vcf(tmp_path / "base.vcf", [BASE[1], BASE[0], BASE[2]] if what == "order" else BASE, "p1 p2")
    one = vcf(tmp_path / "one.vcf", [("chrX" if what == "chromosome" else "chr1") + " 100 x A C . PASS . GT:DP 0/1:10"], "t" if what == "sample" else "s")
    with pytest.raises(Exception, match=message):
        flows.merge_files(spark, base, {"one": one}, "s", str(tmp_path / "out"), "none" if what == "mode" else "all")


def test_evaluation_by_position_by_tolerance_and_of_haploid_calls(spark, tmp_path):
    truth = vcf(tmp_path / "t.vcf", ["chr1 100 a A C . PASS . GT 0/1", "chr1 500 b A ACG . PASS . GT 1/1", "chr1 900 c A " + "C" * 80 + " . . . GT 0/1"], "t")
    calls = vcf(tmp_path / "c.vcf", ["chr1 100 x A C . PASS . GT:GQ 0/1:9", "chr1 500 y A ACG . PASS . GT:GQ 0/1:7", "chr1 950 z A " + "C" * 80 + " . PASS . GT:GQ 1/0:5", "chrX 7 w A C . PASS . GT:GQ 0/1:3"], "s")
    parts = lambda p: sorted((r.part, r.value.split("\t")[2]) for r in spark.read.schema("value string, part string").text(f"{p}/records").collect())
    flows.evaluate_files(spark, truth, calls, str(tmp_path / "a"), score="FORMAT.GQ")
    assert parts(tmp_path / "a") == [("failcall", "c"), ("genotype", "x"), ("miscall", "w"), ("miscall", "z"), ("misgenotype", "y")]
    flows.evaluate_files(spark, truth, calls, str(tmp_path / "b"), "recall", "FORMAT.GQ", "recall")
    assert parts(tmp_path / "b") == [("genotype", "x"), ("miscall", "w"), ("misgenotype", "y"), ("misgenotype", "z")]  # the reference haplotype is an SNP, and too far
    roc = {(r["class"], r.score): (r.tp, r.fp, r.fn) for r in spark.read.parquet(f"{tmp_path}/b/roc").collect()}
    assert roc["all", 5.0] == (3, 0, 0) and roc["all", 3.0] == (3, 1, 0) and roc["ins", 5.0] == (1, 0, 0)
    haploid = vcf(tmp_path / "h.vcf", ["chr1 100 x A C . q . GT:COV 1:5,7", "chr1 500 y A ACG . q . GT:COV 1:0,9"], "s")
    flows.evaluate_files(spark, truth, haploid, str(tmp_path / "g"), "gramtools")
    assert parts(tmp_path / "g") == [("failcall", "c"), ("genotype", "x"), ("genotype", "y")]
    with pytest.raises(ValueError, match="model none"):
        flows.evaluate_files(spark, truth, calls, str(tmp_path / "x"), "none")


def test_query_inputs_on_files(spark):
    """FASTA files of the queries hold the contigs and come from pieces; their VCF files are gzip, as their lines deflate a hundredfold."""
    from varspan.plans import flow_queries as Q
    from varspan.plans.views import view

    small = "/root/testdata/sf0.001"
    got = {}
    for r in sorted(T.scan_contigs(spark, Q._fasta(spark, small), 1000).collect(), key=lambda r: (r.chrom, r.piece)):
        got[r.chrom] = got.get(r.chrom, "") + bytes(r.bases).decode()
    assert got == {r.chrom: r.seq for r in view(spark, small, "v_contigs").collect()}
    lines = view(spark, small, "v_truth_lines")
    files = spark.read.text(Q._vcf(spark, lines, "t")).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)


def test_parts_of_an_evaluation_as_gzip(spark):
    line = lambda k, pos, gt: (k, "\t".join(["chr1", str(pos), f"v{k}", "A", "C", ".", "PASS", ".", "GT", gt]))
    from varspan.plans import flow_queries as Q

    truth, calls = (Q._vcf(spark, spark.createDataFrame(rows, "ord long, line string"), "s") for rows in ([line(1, 5, "0/1"), line(2, 9, "1/1")], [line(1, 5, "0/1"), line(2, 7, "1/1")]))
    found = []
    for compressed in (False, True):
        out = T.shared_folder(spark)
        flows.evaluate_files(spark, truth, calls, out, compressed=compressed)
        df = spark.read.schema("value string, part string").text(f"{out}/records")
        assert all(f.endswith(".gz") == compressed for f in df.inputFiles())
        found.append(sorted((r.part, r.value) for r in df.collect()))
    assert found[0] == found[1] == sorted([("genotype", line(1, 5, "0/1")[1]), ("miscall", line(2, 7, "1/1")[1]), ("failcall", line(2, 9, "1/1")[1])])


def test_samples_merged_together_are_those_merged_alone(spark, tmp_path):
    base = vcf(tmp_path / "base.vcf", [*BASE[:2], "chr1 500 d A ACGT . PASS . GT 0/1 1/1", BASE[2]], "p1 p2")
    rows = lambda k: [f"chr1 100 x A C . PASS . GT:DP 0/1:1{k} 0/0:7", f"chr1 500 y A ACGT . PASS . GT:DP 1/1:{k},2 0/1:4{k}", "", f"chr2 50 z A G . {'LowQual' if k == 2 else 'PASS'} . GT:DP ./.:3 1|0:{k}"]
    files = {f"c{k}": vcf(tmp_path / f"c{k}.vcf", rows(k), "s t" if k != 1 else "s t") for k in range(3)}
    alone = {s: flows.merge_files(spark, base, files, s, str(tmp_path / f"alone-{s}"), second=str(tmp_path / f"second-{s}")).collect() for s in "st"}
    outs, seconds = {s: str(tmp_path / f"out-{s}") for s in "st"}, {s: str(tmp_path / f"again-{s}") for s in "st"}
    together = flows.merge_samples(spark, base, files, outs, seconds=seconds).collect()
    assert {r.sample: (r.panel_sample, r["name"], r.n, r.share) for r in together} == {s: tuple(r[0]) for s, r in alone.items()}
    for s in "st":
        assert lines(spark, outs[s]) == lines(spark, tmp_path / f"alone-{s}") and lines(spark, seconds[s]) == lines(spark, tmp_path / f"second-{s}")
        assert [x for x in lines(spark, outs[s]) if x[0] != "#"]
    with pytest.raises(ValueError, match="c0: no sample u"):
        flows.merge_samples(spark, base, files, {"s": str(tmp_path / "x"), "u": str(tmp_path / "y")})


def test_lines_of_files_are_not_shuffled(spark, tmp_path):
    """Whatever the size of the files: what tells a line its number is a row a split and a row a file, and is broadcast."""
    files = {k: vcf(tmp_path / f"{k}.vcf", ["chr1 100 x A C . PASS . GT:DP 0/1:10"], "s") for k in ("a", "b")}
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (T.lines_of(spark, files["a"]), flows._callers(spark, files, ["s"]))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert not [p for p in plans if "SortMergeJoin" in p]


def test_files_of_callers_from_one_pass(spark):
    """Each caller's file has its header first and is sorted, and holds the lines that the view has."""
    from varspan.plans import flow_queries as Q
    from varspan.plans.views import view

    small = "/root/testdata/sf0.001"
    rows = view(spark, small, "v_call_lines").collect()
    files = Q._caller_vcfs(spark, small)
    want = {c: [] for c in files}
    for r in sorted(rows, key=lambda r: (r.line.split("\t")[0], int(r.line.split("\t")[1]), r.ord)):
        *fixed, value = r.line.split("\t")
        other = "0/0" + value[value.index(":"):]
        want[r.caller].append("\t".join([*fixed, *((other, value) if r.sample_id else (value, other))]))
    for c, path in files.items():
        got = lines(spark, path)
        assert [x[:6] for x in got[:3]] == ["##file", "##cont", "#CHROM"] and got[2].endswith("FORMAT\ts0\ts1")
        assert want[c] and got[3:] == want[c]


def test_odd_calls_are_told_as_common_ones(spark, tmp_path):
    """Haploid, triploid, missing and bad genotypes, lists of depths, several and symbolic ALTs."""
    fields = ["0/1:7", "1:4", "0:4", ".:4", "./1:4", "1|.:4", "1/x:4", "0/0/2:3,5,7", "1/2/.:3", "2|1:3,5", "1/1:-1", "1/0:-1,4", "1/1:x", "1/1:", "1/1"]
    alts = ["ACG", "ACG,A", "<DEL:SVSIZE=9>", "ACGTA,ACGT,AC"]
    rows = [f"chr1 {10 + k} {'Duplication' if k % 3 == 0 else 'v'} A {alts[k % 4]} . {'LowQ' if k % 7 == 6 else 'PASS'} . GT:DP {f}" for k, f in enumerate(fields * 4)]
    got = {r.pos: r for r in flows._callers(spark, {"c": vcf(tmp_path / "c.vcf", rows, "s")}, ["s"]).collect()}
    r = T.records(spark.createDataFrame([(k, "\t".join(x.split())) for k, x in enumerate(rows)], "ord long, line string"))
    s = F.get("samples", F.lit(0))
    r = r.select("pos", "filter", V.gt_strict(F.col("format"), s).alias("gt"), V.depths(F.col("format"), s).alias("depths"), V.allele_lengths(F.col("id"), F.col("ref"), F.col("alts")).alias("l"))
    for x in r.withColumn("hap", V.hap_lengths(F.col("l"), F.col("gt"))).collect():
        y, last = got[x.pos], min(1, len(x.gt) - 1)
        assert (y.g0, y.g1, y.d0, y.d1, y.depth) == (x.gt[0], x.gt[last], x.depths[0], x.depths[min(1, len(x.depths) - 1)], sum(x.depths))
        assert y.counts == (x.filter == "PASS" and any(x.gt))
        if y.counts:
            assert (y.ref_len, y.h0, y.h1) == (x.l.ref_len, *x.hap[:2])
    assert len(got) == len(rows)
