"""Operators: dedupe, majority, global rank / ntile, quality, stats, series."""

from __future__ import annotations

import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.operators import quality as Q
from marketlake.operators import stats as ST
from marketlake.operators.dedupe import dedupe_by_key, dedupe_rows, majority_row
from marketlake.functions.numeric import half_up_ratio
from marketlake.operators import rank
from marketlake.operators import series as series_module
from marketlake.operators.rank import global_ntile, global_row_number, ntile_expr
from marketlake.operators.series import add_lags, add_rolling_means, chronological_split, series_features


def test_dedupe_rows_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "k int, v string")
    assert dedupe_rows(df).count() == 2


def test_dedupe_by_key_deterministic_winner(spark):
    df = spark.createDataFrame([("o1", "b", 2), ("o1", "a", 9), ("o1", None, 5), ("o2", "z", 1)],
                               "k string, v string, n int")
    got = {r["k"]: (r["v"], r["n"]) for r in dedupe_by_key(df, ["k"]).collect()}
    assert got == {"o1": (None, 5), "o2": ("z", 1)}  # NULLs first, like the oracle


def test_majority_city(spark):
    rows = [("z1", "a")] * 3 + [("z1", "b")] + [("z2", "c"), ("z2", "b")]
    df = spark.createDataFrame(rows, "zip string, city string")
    got = {r["zip"]: (r["city"], r["cnt"]) for r in majority_row(df, "zip", ["city"], {}).collect()}
    assert got == {"z1": ("a", 3), "z2": ("b", 1)}  # tie -> smallest name



def test_ntile_n7(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 8)], "rn long")
    got = [r[0] for r in df.select(ntile_expr(F.col("rn"), 7, 5)).collect()]
    assert got == [1, 1, 2, 2, 3, 4, 5]


def test_global_rank_matches_plain_window_with_heavy_ties(spark):
    rnd = random.Random(7)
    # first column: one value holds a third of the rows; unique tie-break second
    rows = [(0 if i % 3 == 0 else rnd.randint(1, 50), f"id{i:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string")
    ours = global_row_number(df, ["a", "b"], name="rn")
    ref = df.withColumn("rn_ref", F.row_number().over(Window.orderBy("a", "b")))
    j = ours.join(ref, ["a", "b"])
    assert j.filter(F.col("rn") != F.col("rn_ref")).count() == 0
    assert j.count() == 3000


def test_global_rank_descending_and_ntile(spark):
    rows = [(i % 17, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "v int, k int")
    ours = global_ntile(df, 5, ["v", "k"], "q")
    ref = df.withColumn("q_ref", F.ntile(5).over(Window.orderBy("v", "k")))
    assert ours.join(ref, ["v", "k"]).filter("q != q_ref").count() == 0
    desc = global_row_number(df, ["v", "k"], name="rn", descending=True)
    ref2 = df.withColumn("rn_ref", F.row_number().over(Window.orderBy(F.desc("v"), F.desc("k"))))
    assert desc.join(ref2, ["v", "k"]).filter("rn != rn_ref").count() == 0


def test_global_rank_empty(spark):
    df = spark.createDataFrame([], "a int")
    assert global_row_number(df, ["a"]).count() == 0


def test_checks_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (3, " y")], "a int, b string")
    rules = Q.null_rules(["a", "b"]) + Q.untrimmed_rules(["b"])
    got = {r["rule"]: (r["n_rows"], r["n_bad"]) for r in Q.checks(df, rules).collect()}
    assert got == {"null:a": (3, 1), "null:b": (3, 1), "untrimmed:b": (3, 1)}


def test_key_cardinality_nulls_hot_value_no_expand(spark):
    rows = [("hot", "p1")] * 300 + [(f"c{i}", f"p{i % 7}") for i in range(40)] + [(None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    out = Q.key_cardinality(df, ["a", "b"])
    assert out.columns == ["n_rows", "n_distinct_a", "n_distinct_b"]
    assert tuple(out.first()) == (341, 41, 7)  # NULL is not a distinct value
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()


def test_profile_and_fd(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", None)], "z string, c string")
    prof = {r["column_name"]: (r["non_null"], r["n_null"]) for r in Q.profile(df).collect()}
    assert prof == {"z": (3, 0), "c": (2, 1)}
    assert [r["z"] for r in Q.fd_violations(df, "z", F.col("c")).collect()] == ["1"]


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    got = {r["bin"]: r["n"] for r in ST.equal_width_histogram(df, "v", 5).collect()}
    assert got == {1: 1, 3: 1, 5: 1}  # 5 is in [4, 6); the maximum 10 is in bin 5


def test_correlation_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.0, 0.0)],
                               "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in ST.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == 1.0 and got[("b", "a")] == 1.0 and got[("a", "a")] == 1.0
    assert got[("a", "c")] == -1.0  # only the two complete rows count


def test_rolling_and_lags(spark):
    df = spark.createDataFrame([("c", i, float(i)) for i in range(1, 5)], "k string, t int, v double")
    out = add_rolling_means(add_lags(df, "k", "t", "v", [1]), "k", "t", "v", [3]).orderBy("t")
    assert [r["v_roll3"] for r in out.collect()] == [None, None, 2.0, 3.0]
    assert [r["v_lag1"] for r in out.collect()] == [None, 1.0, 2.0, 3.0]
    split = chronological_split(df, "k", "t")
    assert [r["is_train"] for r in split.orderBy("t").collect()] == [1, 1, 1, 0]


def test_chronological_split_without_key_uses_global_rank(spark):
    rows = [(t,) for t in random.Random(7).sample(range(100_000), 20_000)]
    df = spark.createDataFrame(rows, "t long")
    got = {r["t"]: r["is_train"] for r in chronological_split(df, None, "t").collect()}
    cut = sorted(t for (t,) in rows)[int(0.8 * len(rows)) - 1]
    assert got == {t: int(t <= cut) for (t,) in rows}
    plan = chronological_split(df, None, "t")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_global_rank_rejects_nulls_and_numbers_ties(spark):
    with pytest.raises(Exception, match="NULL in the order columns"):
        global_row_number(spark.createDataFrame([(1,), (None,)], "a int"), ["a"])
    out = global_row_number(spark.createDataFrame([(1,), (1,), (2,)], "a int"), ["a"])
    assert sorted((r.a, r.rn) for r in out.collect()) == [(1, 1), (1, 2), (2, 3)]


def test_global_rank_plan_is_free_of_row_data(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for n in (2, 50, 30_000):
        out = global_row_number(spark.range(n), ["id"])
        assert [r.rn for r in out.orderBy("id").limit(3).collect()] == list(range(1, min(n, 3) + 1))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    # neither bounds nor offsets are literals: the plan of 30 000 rows is as short as that of 2
    texts = [global_row_number(spark.range(n), ["id"])._jdf.queryExecution().optimizedPlan().toString() for n in (2, 30_000)]
    assert abs(len(texts[0]) - len(texts[1])) < 50


@pytest.mark.parametrize("block", [4, 4096])
def test_line_numbers_follow_groups_and_lines(spark, monkeypatch, block):
    monkeypatch.setattr(rank, "LINE_BLOCK", block)
    rnd = random.Random(5)
    # group 3 has more lines than all others; line numbers repeat
    rows = [(g, line, f"p{rnd.randrange(10**6):06d}") for g in range(1, 40) for line in [*range(1, 3), 2]] + [(3, i, "x") for i in range(5, 205)]
    got = rank.line_numbers(spark.createDataFrame(rows, "g long, line int, p string").repartition(5), "g", "line", ["p"], "sk").collect()
    assert [(r.g, r.line, r.p) for r in sorted(got, key=lambda r: r.sk)] == sorted(rows)
    assert sorted(r.sk for r in got) == list(range(1, len(rows) + 1))


def test_long_series_is_many_tasks_and_equals_the_plain_window(spark):
    """One series of a million rows beside short ones and a NULL series."""
    n = 1_000_000
    df = spark.range(n).select(F.lit("long").alias("k"), F.col("id").alias("t"), ((F.col("id") * 7919) % 1000).alias("v")) \
        .union(spark.range(500).select((F.col("id") % 7).cast("string"), F.col("id"), F.when(F.col("id") % 11 > 0, F.col("id")))) \
        .union(spark.range(5).select(F.lit(None).cast("string"), F.col("id"), F.col("id")))
    out = series_features(df, "k", "t", "v", lags=[1, 14], rolling=[7])
    w = Window.partitionBy("k").orderBy("t")
    frame = w.rowsBetween(-6, 0)
    ref = df.select("*", F.lag("v", 1).over(w).alias("v_lag1"), F.lag("v", 14).over(w).alias("v_lag14"),
                    F.when(F.count("v").over(frame) == 7, F.sum("v").over(frame).cast("double") / 7).alias("v_roll7"))
    digest = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64(*d.columns).cast("decimal(38,0)"))).first())
    assert digest(out) == digest(ref)
    spread = out.where("k = 'long'").groupBy(F.spark_partition_id()).count()
    runs = series_module.numbered(df, ["k", "t"], "_nr").where("k = 'long'").select(F.expr("(_nr - 1) div 100000")).distinct().count()
    assert runs > 8 and spread.count() > 1


@pytest.mark.parametrize("current", [True, False])
def test_halo_reaches_over_every_border(spark, current):
    rows = [(k, t, float(t * t)) for k in "ab" for t in range(40)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(4)
    whole = series_features(df, "k", "t", "v", lags=[3], rolling=[5], include_current=current).collect()
    for block in (1, 5, 6, 7, 79, 80):
        cut = series_features(df, "k", "t", "v", lags=[3], rolling=[5], include_current=current, block=block).collect()
        assert sorted(map(str, cut)) == sorted(map(str, whole))


def test_rank_and_ratio_past_two_billion(spark):
    row = spark.range(1).select(ntile_expr(F.lit(3_000_000_000).cast("long"), 3_000_000_001, 4).alias("q"),
                                half_up_ratio(F.lit("15000000000000000").cast("decimal(38,0)"), F.lit(10**12), 6, num_scale=2).alias("v")).first()
    assert row.q == 4 and row.v == 150.0
