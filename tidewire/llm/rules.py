"""Quality rules as a learned decision list over text statistics, in Spark expressions only.

Statistics come from one pass over the texts.  Sequential covering then learns an ordered list of
conjunctions of thresholds from labelled rows: a rule grows on two thirds of the rows not yet covered, one
threshold at a time by information gain, is pruned on the other third to the prefix with the best
balance, and is accepted if it is precise enough there.  Rows that no rule covers are kept.  Thresholds
are quantiles of each statistic, so a learning step is one aggregation over the labelled statistics.

Defined cases: null text has no words; ratios over no words are 0; a doc_id labelled twice counts by its lowest
label; labels other than 0 and 1 and null ids are ignored; without labels of both kinds there are no
rules; repeated rows are judged alike; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import dataclasses
import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.storage import stage

SPACES = " \t\n\x0b\x0c\r"
SPACE_PATTERN = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

QUANTILES = 32
MAX_RULES, MAX_CONDITIONS = 12, 4
#: Share of the rows covered on the pruning third that must be of low quality.
MIN_PRECISION, MIN_COVERED = 0.9, 4

STATISTICS = (
    "n_words", "mean_word", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "distinct_ratio", "upper_ratio", "mark_ratio", "digit_ratio", "words_per_line",
)


# --- statistics ---------------------------------------------------------------------------


def words(text: Column) -> Column:
    """Words between ASCII white space, in order."""
    return F.filter(F.split(text, SPACE_PATTERN), lambda w: w != "")


def count_of(text: Column, characters: str) -> Column:
    """How many of the given characters a text has."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _repeated_words() -> Column:
    """Words inside a three-word window that occurs twice or more, from columns ``words`` and ``windows``.

    Equal hashes are only a reason to look closer: windows are then sorted with their places, and the
    places of equal neighbors cover up to three words each, less where they overlap.
    """
    places = F.sequence(F.lit(1), F.size("words") - 2)
    sorted_windows = F.array_sort(
        F.transform(places, lambda i: F.struct(F.concat_ws(" ", F.element_at("words", i), F.element_at("words", i + 1), F.element_at("words", i + 2)).alias("w"), i.alias("i")))
    )

    def starts(s: Column) -> Column:
        equal = lambda x, k: ((k > 0) & (F.get(s, k - 1)["w"] == x["w"])) | ((k < F.size(s) - 1) & (F.get(s, k + 1)["w"] == x["w"]))
        return F.array_sort(F.transform(F.filter(s, equal), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, k: F.when(k < F.size(p) - 1, F.least(F.get(p, k + 1) - x, F.lit(3))).otherwise(F.lit(3))), F.lit(0), lambda a, x: a + x
        )

    # One-element arrays hand an intermediate result to the next step without computing it again.
    once = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))
    exact = once(once(sorted_windows, starts), covered)
    return F.when(F.size(F.array_distinct("windows")) < F.size("windows"), exact).otherwise(F.lit(0))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed and the ratios that rules are made of."""
    text = F.col("text")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    split = plain.withColumns({"words": words(text), "lines": F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))})
    windows = F.when(
        F.size("words") > 3,
        F.transform(F.sequence(F.lit(1), F.size("words") - 2), lambda i: F.xxhash64(F.element_at("words", i), F.element_at("words", i + 1), F.element_at("words", i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = split.withColumn("windows", windows).select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words().cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("words")).alias("__distinct"),
        F.size("lines").alias("__lines"),
        count_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("__upper"),
        count_of(text, "!?").alias("__marks"),
        count_of(text, "0123456789").alias("__digits"),
    )
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        per("word_chars", "n_words").alias("mean_word"),
        per("n_symbols", "n_words").alias("symbol_ratio"),
        per("n_dup_lines", "__lines").alias("dup_line_ratio"),
        per("n_repeat_words", "n_words").alias("repeat_ratio"),
        per("__distinct", "n_words").alias("distinct_ratio"),
        per("__upper", "word_chars").alias("upper_ratio"),
        per("__marks", "n_words").alias("mark_ratio"),
        per("__digits", "word_chars").alias("digit_ratio"),
        per("n_words", "__lines").alias("words_per_line"),
    )


# --- decision list --------------------------------------------------------------------------


@dataclasses.dataclass(frozen=True)
class Condition:
    """``statistic <= threshold`` or ``statistic > threshold``."""

    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold!r}"


@dataclasses.dataclass(frozen=True)
class Rule:
    """A conjunction that marks a text as of low quality; the counts are those on the pruning third."""

    conditions: tuple[Condition, ...]
    low: int
    high: int

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, [c.column() for c in self.conditions])

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions))


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional expression: false at the first rule that covers a text, else true."""
    if not rules:
        return F.lit(True)
    chain = F.when(rules[0].column(), F.lit(False))
    for rule in rules[1:]:
        chain = chain.when(rule.column(), F.lit(False))
    return chain.otherwise(F.lit(True))


def as_sql(rules: list[Rule]) -> str:
    """The same expression as text."""
    return "CASE " + "".join(f"WHEN {r} THEN false " for r in rules) + "ELSE true END" if rules else "true"


def _gain(low: int, high: int, low_before: int, high_before: int) -> float:
    if not low:
        return 0.0
    return low * (math.log2(low / (low + high)) - math.log2(low_before / (low_before + high_before)))


def _best_condition(rows: DataFrame, cuts: dict[str, list[float]]) -> Condition | None:
    """The threshold with the largest gain over the given rows; one aggregation by statistic and quantile."""

    def place(statistic: str) -> Column:
        below = F.filter(F.array(*map(F.lit, cuts[statistic])), lambda x: F.col(statistic) > x)
        return F.struct(F.lit(statistic).alias("statistic"), F.size(below).alias("bin"))

    places = F.array(*map(place, cuts))
    counts = rows.select("low", F.explode(places).alias("p")).groupBy("p.statistic", "p.bin").agg(F.sum("low").alias("low"), F.count("*").alias("n")).collect()
    by: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counts:
        by.setdefault(r["statistic"], {})[r["bin"]] = (r["low"], r["n"] - r["low"])
    best, top = None, 1e-9
    for statistic in sorted(by):
        bins = by[statistic]
        low_all, high_all = (sum(v[k] for v in bins.values()) for k in (0, 1))
        if not low_all or not high_all:
            return None
        low = high = 0
        for place, threshold in enumerate(cuts[statistic]):
            low, high = low + bins.get(place, (0, 0))[0], high + bins.get(place, (0, 0))[1]
            for above, p, n in ((False, low, high), (True, low_all - low, high_all - high)):
                if (gain := _gain(p, n, low_all, high_all)) > top:
                    best, top = Condition(statistic, above, threshold), gain
    return best


def learn(stats: DataFrame, labels: DataFrame, *, max_rules: int = MAX_RULES, min_precision: float = MIN_PRECISION) -> list[Rule]:
    """Decision list from the statistics of labelled rows that pass the base rules."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter("quality in (0, 1) and doc_id is not null")
        .groupBy("doc_id").agg((1 - F.min("quality")).alias("low"))
    )
    rows = stats.filter(~F.col("base_failed")).join(known, "doc_id")
    rows = stage(rows.select("low", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("pruning"), *[F.col(s).cast("double").alias(s) for s in STATISTICS]), "quality-labelled")
    shares = [i / QUANTILES for i in range(1, QUANTILES)]
    quantiles = rows.agg(*[F.percentile_approx(s, F.array(*map(F.lit, shares)), F.lit(10_000)).alias(s) for s in STATISTICS]).first()
    cuts = {s: sorted(set(quantiles[s] or [])) for s in STATISTICS}
    cuts = {s: c for s, c in cuts.items() if c}
    rules: list[Rule] = []
    left = rows
    while cuts and len(rules) < max_rules:
        grown: list[Condition] = []
        growing = left.filter(~F.col("pruning"))
        while len(grown) < MAX_CONDITIONS and (found := _best_condition(growing, cuts)):
            grown.append(found)
            growing = growing.filter(found.column())
        if not grown:
            break
        prefixes = [reduce(lambda a, b: a & b, [c.column() for c in grown[: k + 1]]) for k in range(len(grown))]
        sums = left.filter("pruning").agg(*[F.count_if(p & (F.col("low") == v)) for p in prefixes for v in (1, 0)]).first()
        counts = [(sums[2 * k], sums[2 * k + 1]) for k in range(len(grown))]
        best = max(range(len(grown)), key=lambda k: ((counts[k][0] - counts[k][1]) / max(sum(counts[k]), 1), counts[k][0], -k))
        low, high = counts[best]
        if low + high < MIN_COVERED or low < min_precision * (low + high):
            break
        rules.append(Rule(tuple(grown[: best + 1]), low, high))
        left = left.filter(~rules[-1].column())
    return rules


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of every document with base_failed and kept."""
    stats = stage(statistics(docs), "quality-statistics")
    rules = learn(stats, labels)
    return stats.withColumn("kept", ~F.col("base_failed") & verdict(rules))
