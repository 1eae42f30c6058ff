from trolley.operators import audits, splits


def test_null_counts_typed_nan(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a"), (None, float("nan"), None), (3, None, "c")], "i int, d double, s string"
    )
    r = audits.null_counts(df).first()
    assert (r["i"], r["d"], r["s"]) == (1, 2, 1)
    filled = df.fillna(0)
    r2 = audits.null_counts(filled).first()
    assert (r2["i"], r2["d"], r2["s"]) == (0, 0, 1)


def test_duplicate_keys_and_unmatched(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (3, 99)], "user_id int, product_id int")
    dups = audits.duplicate_keys(df, ["user_id", "product_id"]).collect()
    assert [(r["user_id"], r["product_id"], r["cnt"]) for r in dups] == [(1, 10, 2)]
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    prods = spark.createDataFrame([(10,), (20,)], "product_id int")
    miss = audits.unmatched(df, {"user_id": users, "product_id": prods}).collect()
    assert [(r["user_id"], r["product_id"]) for r in miss] == [(3, 99)]


def test_key_split_is_disjoint_and_complete(spark):
    df = spark.range(2000).selectExpr("id AS user_id", "id % 7 AS product_id")
    a, b = splits.split(df, [0.8, 0.2], seed=2021, keys=["user_id", "product_id"])
    na, nb = a.count(), b.count()
    assert na + nb == 2000 and 1400 < na < 1800
    assert a.join(b, ["user_id", "product_id"]).count() == 0
    again = splits.split(df, [0.8, 0.2], seed=2021, keys=["user_id", "product_id"])[0].count()
    assert again == na
