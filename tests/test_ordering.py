import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from trolley.operators.ordering import dense_rank_values, running_totals


def _window_reference(df):
    w = Window.partitionBy("g").orderBy("k")
    return df.select(
        "g", "k", F.row_number().over(w).alias("rank"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cv"),
        F.count(F.lit(1)).over(Window.partitionBy("g")).alias("group_rows"),
    )


def _same(spark, df, got, exp):
    cols = ["g", "k", "rank", "cv", "group_rows"]
    assert sorted(map(repr, got.select(*cols).collect())) == sorted(map(repr, exp.select(*cols).collect()))


def test_running_totals_equals_window_with_hot_group(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        g = 0 if i % 3 == 0 else rng.randrange(1, 40)  # group 0 holds a third of all rows
        rows.append((g, i * 7 + rng.randrange(7), rng.randrange(100)))
    df = spark.createDataFrame(rows, "g int, k long, v int").repartition(8)
    got = running_totals(df, [F.col("k")], ["g"], {"cv": F.col("v")})
    _same(spark, df, got, _window_reference(df))


def test_running_totals_large_keys_nulls_and_null_values(spark):
    """Ids beyond 2^53, a NULL group, a NULL order key and NULL values: the plain window's result."""
    rows = [(None if i % 5 == 0 else i % 3, (1 << 60) + i * (1 << 41) if i % 7 else None, i if i % 4 else None) for i in range(1, 60)]
    seen, uniq = set(), []
    for r in rows:
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            uniq.append(r)
    df = spark.createDataFrame(uniq, "g int, k long, v int")
    got = running_totals(df, [F.col("k")], ["g"], {"cv": F.col("v")})
    _same(spark, df, got, _window_reference(df))


def test_running_totals_empty(spark):
    df = spark.createDataFrame([], "g int, k long, v int")
    assert running_totals(df, [F.col("k")], ["g"], {"cv": F.col("v")}).count() == 0


def test_basket_orders_null_user_and_date(spark):
    """No row is lost, and the positions are those of a plain window."""
    import datetime

    from trolley.sources.basket import basket_orders

    day = datetime.date(2020, 1, 1)
    rows = [((1 << 41) * i, None if i % 6 == 0 else i % 2, None if i == 3 else day + datetime.timedelta(days=i)) for i in range(1, 21)]
    src = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate date")
    got = {r["order_id"]: r["order_number"] for r in basket_orders(src).collect()}
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    exp = {r["o_orderkey"]: r["n"] for r in src.withColumn("n", F.row_number().over(w)).collect()}
    assert got == exp


def test_running_totals_global_descending(spark):
    rows = [(float(x) / 10.0, x % 3) for x in range(200)]
    df = spark.createDataFrame(rows, "s double, v int")
    got = running_totals(df, [F.col("s").desc()], sums={"cv": F.col("v")})
    out = sorted((r["s"], r["rank"], r["cv"], r["cv_total"]) for r in got.collect())
    desc = sorted(rows, key=lambda t: -t[0])
    acc = 0
    expect = []
    for i, (s, v) in enumerate(desc):
        acc += v
        expect.append((s, i + 1, acc, sum(x[1] for x in rows)))
    assert out == sorted(expect)


def test_dense_rank_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "x string")
    got = {r["x"]: r["r"] for r in dense_rank_values(df, "x", "r").collect()}
    assert got == {"a": 1, "b": 2, "c": 3}
