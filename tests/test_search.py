"""Adaptive search: densities and proposals against brute force, results that do not depend on the layout."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from trolley.operators import evaluate, models, tuning
from trolley.operators.search import DRAWS, Density, Trial, canonical, parzen_search, prior_draw, propose

SPACE = {"x": ("uniform", -1.0, 3.0), "k": ("quniform", 2, 20, 2)}


def integral(f, a, b, n=4000):
    h = (b - a) / n
    return sum(f(a + (i + 0.5) * h) for i in range(n)) * h


def test_densities_against_numeric_integrals():
    rng = random.Random(1)
    for n in (0, 1, 2, 7):
        d = Density([rng.uniform(-1, 3) for _ in range(n)], -1.0, 3.0)
        assert integral(d.at, -1, 3) == pytest.approx(1.0, abs=1e-4)
        assert d.mass(0.2, 1.1) == pytest.approx(integral(d.at, 0.2, 1.1), abs=1e-4)
        assert all(-1 <= d.draw(rng) <= 3 for _ in range(200))


def test_proposals_have_the_highest_density_ratio():
    rng = random.Random(2)
    trials = [Trial(i, prior_draw(SPACE, rng), rng.random()) for i in range(13)]
    pending = [prior_draw(SPACE, rng)]
    got = propose(SPACE, trials, pending, random.Random(5))
    ranked = sorted(trials, key=lambda t: -t.score)
    replay = random.Random(5)
    for name, (_, lo, hi, *step) in SPACE.items():
        good = Density([t.params[name] for t in ranked[:4]], lo, hi)
        other = Density([t.params[name] for t in ranked[4:]] + [p[name] for p in pending], lo, hi)
        best, value = -1.0, None
        for _ in range(DRAWS):
            x = good.draw(replay)
            if step:
                x = round(x / step[0]) * step[0]
                a, b = max(lo, x - step[0] / 2), min(hi, x + step[0] / 2)
                r = integral(good.at, a, b, 400) / integral(other.at, a, b, 400)
            else:
                r = good.at(x) / other.at(x)
            if r > best * (1 + 1e-9):
                best, value = r, x
        assert got[name] == value


def test_better_than_draws_on_a_smooth_score():
    def score(p):
        return -((p["x"] - 1.7) ** 2) - ((p["k"] - 14) / 10) ** 2

    found, drawn = [], []
    for seed in range(20):
        found.append(max(t.score for t in parzen_search(lambda b: [score(p) for p in b], SPACE, 25, seed, 9, 8)))
        rng = random.Random(seed)
        drawn.append(max(score(prior_draw(SPACE, rng)) for _ in range(25)))
    assert statistics.mean(found) > statistics.mean(drawn)
    again = [parzen_search(lambda b: [score(p) for p in b], SPACE, 25, 3) for _ in range(2)]
    assert again[0] == again[1] and len(again[0]) == 25


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(900).select(
        F.col("id").alias("user_id"),
        *[F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(20)).cast("double").alias(f"c{i}") for i in range(4)],
    )
    noisy = F.col("c0") + F.col("c1") + F.pmod(F.xxhash64(F.lit(9), "user_id"), F.lit(12)) > 26
    return models.assemble(df.withColumn("reordered", noisy.cast("int")), [f"c{i}" for i in range(4)])


def test_search_does_not_depend_on_the_layout(rows):
    options = {"trials": 5, "rounds": 2, "startup": 3, "batch": 2, "parallelism": 2}
    one, two = (tuning.adaptive_search(df, ["user_id"], **options) for df in (rows.coalesce(1), rows.repartition(5, "c3")))
    assert one.trials == two.trials and len(one.trials) == 5
    table = one.table(rows.sparkSession).collect()
    assert sum(r["is_best"] for r in table) == 1 and max(r["metric"] for r in table) == one.best.score > 0


def test_keyed_validation_does_not_depend_on_the_layout(rows):
    est = models.gbt(maxIter=2, subsamplingRate=0.7, seed=3)
    ev = evaluate.MulticlassClassificationEvaluator(labelCol="reordered", metricName="accuracy")
    got = []
    for df in (rows.coalesce(1), rows.repartition(5, "c3")):
        tvs = tuning.train_validation(est, tuning.grid(est, {"maxDepth": [1, 3]}), ev, 0.7, 11, 2, keys=["user_id"])
        m = tvs.fit(df)
        got.append((m.validationMetrics, m.bestModel.toDebugString.split("\n", 1)[1]))
        assert len(tuning.tuning_results(m).collect()) == 2
    assert got[0] == got[1]


def test_an_empty_part_is_an_error(rows):
    from trolley.operators import splits

    part = splits.split(rows, [0.8, 0.2], seed=7, keys=["user_id"])[0]
    with pytest.raises(ValueError, match="same keys and seed"):
        tuning.adaptive_search(part, ["user_id"], trials=1, rounds=1, seed=7)


def test_canonical_layout(rows):
    one, two = (
        canonical(df, ["user_id"]).select("user_id", F.spark_partition_id()).collect()
        for df in (rows.coalesce(1), rows.repartition(6))
    )
    assert one == two and len(one) == 900
