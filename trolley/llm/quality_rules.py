"""Quality rules learnt as a decision list by sequential covering; all of it DataFrame operations.

Statistics of every document are plain column expressions. A decision list is an ordered list of rules "if all of
these thresholds hold, the document is of low quality"; it is learnt from the statistics of the labelled documents:

1. grow: a rule starts empty and takes, one after the other, the threshold on a statistic that gains most (FOIL's
   information gain) among the rows it still covers. Thresholds are the edges of fixed bins, so a step is one
   aggregation to a histogram (statistics x bins x classes: a few hundred rows, whatever the number of documents);
2. prune: on rows kept apart (another hash fold) the last conditions are dropped as long as that does not lower
   the rule's worth (covered bad minus covered good, over covered);
3. cover: the rows the rule covers are set aside and the next rule is learnt, until no rule is precise enough.

The list becomes one chained ``when``. No Python runs on rows.

Defined cases: NULL and empty texts have statistics 0 and fail the base rule; no usable labels give an empty list
(every document that passes the base rule is kept); repeated rows get equal results; very long
texts are counted whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import learnable, store

# Fixed by the contract: the base rule.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_COVER = 5  # bad documents a rule must cover
MIN_RULE_PRECISION = 0.9
BINS = 40

#: Ratios the rules may test, with the upper edge of their bins (the last bin is open).
RATIOS = {
    "symbol_share": ("n_symbols / word_chars", 0.8),
    "symbols_per_word": ("n_symbols / n_words", 4.0),
    "dup_line_share": ("n_dup_lines / n_lines", 1.0),
    "repeat_share": ("n_repeat_words / n_words", 1.0),
    "mean_word": ("word_chars / n_words", 20.0),
    "upper_share": ("n_upper / word_chars", 1.0),
    "distinct_share": ("n_distinct_words / n_words", 1.0),
    "mark_share": ("n_marks / n_words", 4.0),
}


def _count_of(chars: str) -> Column:
    """How many of the characters a text holds."""
    return (F.length("text") - F.length(F.translate("text", chars, ""))).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each whole text (NULL text: none).

    The steps are separate projections, so that each array is made once.
    """
    t = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    t = t.withColumn("w", words).withColumn("lines", lines)
    t = t.select(
        "doc_id",
        "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACES, "")).cast("long").alias("word_chars"),
        _count_of(SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        _count_of("!?").alias("n_marks"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct_words"),
    )
    window = F.when(
        F.size("w") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("w") - WINDOW),
            lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]),
        ),
    )
    t = t.withColumn("h", window).withColumn("any", F.size(F.array_distinct("h")) < F.size("h")).drop("w")
    # Only texts with a window found twice: windows sorted by hash, equal neighbours are the repeated ones.
    pairs = F.when(
        F.col("any"), F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    )
    t = t.withColumn("s", pairs).drop("h", "any")
    repeated = F.filter(
        F.transform(
            "s",
            lambda x, i: F.when(
                (F.get("s", i - 1)["h"] == x["h"]) | (F.get("s", i + 1)["h"] == x["h"]), x["i"]
            ),
        ),
        lambda x: x.isNotNull(),
    )
    t = t.withColumn("p", F.array_sort(repeated)).drop("s")
    # Words under the windows that start at the sorted places p: each adds what the next one does not cover again.
    covered = F.aggregate(
        F.transform("p", lambda x, i: F.least(F.coalesce(F.get("p", i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return t.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("p")


def ratio(name: str) -> Column:
    """One of RATIOS as a column; 0 where its divisor is 0."""
    a, b = RATIOS[name][0].split(" / ")
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        r = ratio(self.feature)
        return r >= self.threshold if self.above else r < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def _histogram(rows: DataFrame) -> dict[tuple[str, int], list[int]]:
    """(statistic, bin) → [bad, good] counts: one aggregation with map-side sums."""
    each = F.array(
        *[
            F.struct(
                F.lit(n).alias("f"),
                F.least(F.floor(ratio(n) / (hi / BINS)).cast("int"), F.lit(BINS)).alias("b"),
            )
            for n, (_, hi) in RATIOS.items()
        ]
    )
    g = rows.select("y", F.explode(each).alias("e")).groupBy("e.f", "e.b", "y").agg(F.count(F.lit(1)).alias("n"))
    out: dict[tuple[str, int], list[int]] = {}
    for r in g.collect():  # at most statistics x bins x 2 rows
        out.setdefault((r["f"], r["b"]), [0, 0])[r["y"]] += r["n"]
    return out


def _best(hist: dict[tuple[str, int], list[int]]) -> tuple[float, Condition | None, int, int]:
    """(gain, condition, bad, good) of the condition with the highest FOIL gain."""
    bad = sum(v[0] for (f, _), v in hist.items() if f == "mean_word")
    good = sum(v[1] for (f, _), v in hist.items() if f == "mean_word")
    best: tuple[float, Condition | None, int, int] = (0.0, None, bad, good)
    if not bad or not good:
        return best
    now = math.log2(bad / (bad + good))
    for f, (_, hi) in RATIOS.items():
        low = [0, 0]
        for b in range(BINS):
            v = hist.get((f, b), (0, 0))
            low = [low[0] + v[0], low[1] + v[1]]
            for above, (p, n) in ((False, low), (True, (bad - low[0], good - low[1]))):
                if p < MIN_COVER or p + n == bad + good:
                    continue
                gain = p * (math.log2(p / (p + n)) - now)
                if gain > best[0] + 1e-9:
                    best = (gain, Condition(f, above, round((b + 1) * hi / BINS, 6)), p, n)
    return best


def _worth(rows: DataFrame, rule: Rule) -> list[tuple[int, int]]:
    """(bad, good) covered by each beginning of the rule, by one aggregation."""
    cols = []
    for k in range(1, len(rule) + 1):
        hit = _all(rule[:k])
        cols += [F.count(F.when(hit & (F.col("y") == y), 1)).alias(f"c{k}_{y}") for y in (0, 1)]
    r = rows.agg(*cols).first()
    return [(r[f"c{k}_0"], r[f"c{k}_1"]) for k in range(1, len(rule) + 1)]


def learn(stats: DataFrame) -> list[Rule]:
    """The decision list from labelled statistics (columns of ``statistics`` and y; y = 0 is bad)."""
    rows = stats.where(~base_failed())
    fold = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(3)) == 0
    grow, prune = rows.where(~fold), rows.where(fold)
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        rule: Rule = ()
        left, bad, good = grow, 0, 0
        while len(rule) < MAX_CONDITIONS:
            _, cond, p, n = _best(_histogram(left))
            if cond is None:
                break
            rule, bad, good = (*rule, cond), p, n
            left = left.where(cond.column())
            if good == 0:
                break
        if not rule:
            break
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in _worth(prune, rule)]
        k = max(range(len(worth)), key=lambda i: (worth[i], -i))
        if max(worth) > -1.0:
            rule = rule[: k + 1]
        p, n = _worth(grow, rule)[-1]
        if p < MIN_COVER or p < MIN_RULE_PRECISION * (p + n):
            break
        rules.append(rule)
        grow, prune = grow.where(~_all(rule)), prune.where(~_all(rule))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: true if the document is kept."""
    out = None
    for r in rules:
        out = F.when(_all(r), F.lit(False)) if out is None else out.when(_all(r), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def quality_rules(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Statistics, base_failed and kept of every document. The statistics are stored once and read twice."""
    stats = store(statistics(docs), "rules-statistics")
    train = store(stats.join(learnable(labels, label), "doc_id"), "rules-train")
    rules = learn(train)
    return stats.select("*", base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))
