"""Laws that hold whatever the tables: bins partition, matched and missed truth add up, ROC counts only grow, matching moves along."""

from conftest import SMALL
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from varspan.functions.variant import COUNT_EDGES, EVAL_EDGES, bins
from varspan.operators import intervals as I
from varspan.plans import catalog, table_queries


@given(st.integers(-999_999, 999_999))
def test_bins_partition(n):
    for edges in (COUNT_EDGES, EVAL_EDGES):
        assert sum(lo <= n <= hi for _, lo, hi in bins(edges)) == 1


def test_matched_and_missed_are_all(spark):
    q = catalog.QUERIES
    runs = table_queries.calls(spark, SMALL).select(*table_queries.RUN).distinct().count()
    n = table_queries.truth(spark, SMALL).count()
    assert q["use_once"](spark, SMALL).count() + q["fail_calls"](spark, SMALL).count() == runs * n


def test_roc_grows(spark):
    w = Window.partitionBy("caller", "sample_id", "class").orderBy(F.desc("score"))
    r = catalog.QUERIES["roc_table"](spark, SMALL).select((F.col("tp") < F.lag("tp").over(w)).alias("a"), (F.col("fp") < F.lag("fp").over(w)).alias("b"))
    assert r.where("a or b").count() == 0


def test_matching_moves_with_positions(spark):
    c, t = table_queries.calls(spark, SMALL), table_queries.truth(spark, SMALL)
    move = lambda df: df.withColumn("pos", F.col("pos") + 1_000_003)
    rows = lambda a, b: sorted(tuple(r) for r in I.match_exact(a, b, table_queries.RUN).collect())
    assert rows(c, t) == rows(move(c), move(t))
