"""Quality rules: an ordered list of threshold conjunctions learned from labels.

Sequential covering. One rule at a time is grown on two thirds of the labelled
rows by the condition with the best information gain, pruned from its end on
the other third, and kept if it is pure enough there; the rows it covers leave
the training set. Every step is one Spark aggregate of counts by feature and
bin over all labelled rows; the driver sees those counts only. The rules become
one `CASE WHEN` over statistics of a text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpflow.functions.text import once
from dumpflow.llm.stages import written
from dumpflow.llm.text import WORD, let, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FURTHER = ("n_chars_all", "n_lines", "n_distinct", "n_upper", "n_digits", "n_marks", "n_letterless")
#: Quantiles of a feature over the labelled rows; cut points lie between them.
SHARES = (0.002, 0.005, 0.01, 0.02, 0.035, *(i / 20 for i in range(1, 20)), 0.965, 0.98, 0.99, 0.995, 0.998)
WORDS = "__quality_words"


@dataclass(frozen=True)
class Condition:
    """`feature > cut` if `above`, else `feature <= cut`."""

    feature: str
    cut: float
    above: bool

    def column(self, value: Column) -> Column:
        return value > self.cut if self.above else value <= self.cut


def _repeated(w: Column) -> Column:
    """Words inside a window of three words that the text has twice or more."""
    grams = F.sort_array(F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")),
    ))

    def starts(s: Column) -> Column:
        same = lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])
        return F.sort_array(F.filter(
            F.transform(s, lambda x, j: F.when(F.coalesce(same(x, j), F.get(s, j - 1)["h"] == x["h"], F.get(s, j + 1)["h"] == x["h"]), x["i"])),
            lambda i: i.isNotNull(),
        ))

    # Sorted starts cover three words each, less what the next one covers again.
    covered = let(let(grams, starts), lambda at: F.aggregate(
        F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW)))),
        F.lit(0), lambda total, n: total + n,
    ))
    return F.when(F.size(w) >= WINDOW, covered).otherwise(0)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows with the counts that rules read, one pass over each whole text.

    A NULL text counts as an empty one. Columns of `docs` stay, except those
    that bear the name of a count, which are replaced.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda line: line.rlike(WORD))
    rows = once(docs.drop(*BASE, *FURTHER), WORDS, words_of(F.col(text)))
    w = F.col(WORDS)
    found = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.length(value) - F.length(F.translate(value, SYMBOLS, "")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": let(w, _repeated),
        "n_chars_all": F.length(value),
        "n_lines": F.size(lines),
        "n_distinct": F.size(F.array_distinct(w)),
        "n_upper": F.regexp_count(value, F.lit(r"\p{Lu}")),
        "n_digits": F.regexp_count(value, F.lit(r"[0-9]")),
        "n_marks": F.length(value) - F.length(F.translate(value, "!?", "")),
        "n_letterless": F.size(F.filter(w, lambda x: ~x.rlike(r"\p{L}"))),
    }
    return rows.select("*", *(c.cast("bigint").alias(n) for n, c in found.items())).drop(WORDS)


def features() -> dict[str, Column]:
    """Ratios of the counts of `statistics`; 0 where there is nothing to divide by."""
    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))

    return {
        "words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "distinct_words": share("n_distinct", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
        "upper_case": share("n_upper", "n_chars_all"),
        "digits": share("n_digits", "n_chars_all"),
        "marks_per_word": share("n_marks", "n_words"),
        "letterless_words": share("n_letterless", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _covers(rule: list[Condition], bins: dict[tuple[str, float], Column]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & (bins[c.feature, c.cut] if c.above else ~bins[c.feature, c.cut])
    return out


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    """Information gain of the rows that a condition leaves, as bits over its bad rows."""
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(all_bad / (all_bad + all_good)))


def learn(labelled: DataFrame, label: str = "quality", max_rules: int = 8, max_conditions: int = 4,
          min_precision: float = 0.95, min_bad: int = 5) -> list[list[Condition]]:
    """Rules that reject, in order, from rows of `statistics` with a 0/1 label (0: bad).

    Rows without a label, and rows that fail the base limits anyway, do not
    count. Every other labelled row does. A rule must cover `min_bad` bad rows
    and be bad in `min_precision` of the rows of each part that it covers.
    Without bad rows the list is empty.
    """
    value = features()
    rows = labelled.where(F.col(label).isin(0, 1) & ~base_failed())
    cuts = rows.agg(*(F.percentile_approx(c, list(SHARES), 10_000).alias(n) for n, c in value.items())).first()
    if cuts is None or cuts[0] is None:
        return []
    # Halfway between neighbouring quantiles, so that a rule keeps its distance from rows on either side.
    quantiles = {name: sorted(set(cuts[name])) for name in value}
    points = {name: [(a + b) / 2 for a, b in pairwise(x)] for name, x in quantiles.items()}
    binned = written(rows.select(
        (F.col(label) == 0).alias("bad"),
        (F.pmod(F.xxhash64(*(F.col(n) for n in BASE)), F.lit(3)) < 2).alias("grow"),
        # The bin is the number of cut points below the value.
        *(sum((F.when(c > t, 1).otherwise(0) for t in points[n]), F.lit(0)).cast("tinyint").alias(n) for n, c in value.items()),
    ), "quality-bins")
    above = {(n, t): F.col(n) > i for n in value for i, t in enumerate(points[n])}
    tally = (F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
    rules: list[list[Condition]] = []
    left = binned
    while len(rules) < max_rules:
        rule: list[Condition] = []
        while len(rule) < max_conditions:
            counts = (
                left.where(F.col("grow") & _covers(rule, above))
                .select("bad", F.explode(F.map_from_arrays(
                    F.array(*map(F.lit, value)), F.array(*map(F.col, value)))).alias("feature", "bin"))
                .groupBy("feature", "bin").agg(*tally).collect()
            )
            step = _best(counts, points)
            if step is None:
                break
            rule.append(step[0])
            if step[1] == 0:  # nothing good is left
                break
        rule = _pruned(rule, left, above, min_precision, min_bad)
        if not rule:
            break
        rules.append(rule)
        left = left.where(~_covers(rule, above))
    return rules


def _best(counts, points) -> tuple[Condition, int] | None:
    """The condition with the most gain, and the good rows it leaves."""
    table: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counts:
        table.setdefault(r["feature"], {})[r["bin"]] = (r["bad"], r["good"])
    best = (0.0, "", 0.0, False, 0)
    for name in sorted(table):
        bins = table[name]
        all_bad, all_good = (sum(v[k] for v in bins.values()) for k in (0, 1))
        for i, cut in enumerate(points[name]):
            bad, good = (sum(v[k] for b, v in bins.items() if b > i) for k in (0, 1))
            for is_above, b, g in ((True, bad, good), (False, all_bad - bad, all_good - good)):
                best = max(best, (_gain(b, g, all_bad, all_good), name, cut, is_above, g))
    return (Condition(*best[1:4]), best[4]) if best[0] > 1e-9 else None


def _pruned(rule, left, above, min_precision, min_bad) -> list[Condition]:
    """The prefix of the rule that judges the pruning rows best, or nothing."""
    if not rule:
        return []
    prefixes = [rule[:k] for k in range(len(rule), 0, -1)]
    found = left.agg(*(
        F.count_if((F.col("grow") if grow else ~F.col("grow")) & (F.col("bad") if bad else ~F.col("bad")) & _covers(p, above)).alias(f"{k}{grow:d}{bad:d}")
        for k, p in enumerate(prefixes) for grow in (True, False) for bad in (True, False)
    )).first()
    fit = []
    for k, p in enumerate(prefixes):
        (bad, good), (bad_grown, good_grown) = ((found[f"{k}{g}1"], found[f"{k}{g}0"]) for g in (0, 1))
        pure = all(b >= min_precision * (b + g) for b, g in ((bad, good), (bad_grown, good_grown)))
        if pure and bad + bad_grown >= min_bad:
            fit.append(((bad - good) / max(1, bad + good), -len(p), p))
    return max(fit, key=lambda x: x[:2])[2] if fit else []


def verdict(rules: list[list[Condition]]) -> Column:
    """Number of the first rule that rejects, from 1; 0: none does."""
    value, out = features(), F
    for k, rule in enumerate(rules, 1):
        hit = F.lit(True)
        for c in rule:
            hit = hit & c.column(value[c.feature])
        out = out.when(hit, F.lit(k))
    return out.otherwise(F.lit(0)) if rules else F.lit(0)


def judge(stats: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """Rows of `statistics` with `base_failed`, `rule` and `kept`."""
    rows = stats.withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def with_labels(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of labelled documents; a repeated label of one document counts once."""
    return stats.select("doc_id", *BASE, *FURTHER).join(labels.select("doc_id", "quality").distinct(), "doc_id")
