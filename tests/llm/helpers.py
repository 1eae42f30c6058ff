"""Small fixtures that every operator's tests share."""

import random

SYLLABLES = "the of and ing ion er est al con pre sub tri mar lon vek tas rim pol".split()


def words(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n))


def awkward_docs(spark, seed=1, n=40):
    """Documents with NULLs in every column, empty and long texts, repeated rows and clashing extra columns."""
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.randint(1, 120)), "en", f"s{i % 3}", 0, i, "x") for i in range(n)]
    rows += [(100, None, "en", "s0", None, 1, "x"), (101, "", None, "s1", 0, None, None), (102, " \n\t ", "en", None, 0, 1, "x")]
    rows += [(103, words(rng, 30_000), "en", "s0", 0, 1, "x"), (None, "no key here at all", "en", "s1", 0, 1, "x")]
    rows += [rows[0], rows[0], (104, rows[1][1], "en", "s2", 0, 1, "x"), (105, "naïve Ünïcode words 漢字 🙂", "fr", "s2", 0, 1, "x")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, size long, n string"
    ).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
