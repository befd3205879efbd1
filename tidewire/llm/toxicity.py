"""Toxicity by maximum-scoring segments.

Training: on labelled rows, every word and its beginnings get a log-odds ratio of their rates in toxic and
clean texts with an informative Dirichlet prior (proportional to the rate over both).  The variance
counts documents, not occurrences, so a word repeated in one text proves little.  Features with a large
z-score form the lexicon; every other word costs ``DRIFT``.

Scoring: a word scores as its longest lexicon feature, the m-th use since the running total was last at its lowest an m-th of it.
No maximal-scoring segment reaches across such a place, so uses before it don't weaken what follows.  One linear scan finds all
maximal-scoring segments.  With lambda from sum(p(s) * exp(lambda * s)) = 1 over clean texts, a segment of score S in a text of n
words has the extreme-value statistic lambda * S - ln n.  The largest, plus what further significant
segments add, is the evidence; a logistic curve fitted on labelled rows outside the counted ones turns it
into a score from 0 to 1.

The model is fitted on at most ``MAX_TRAINING`` labelled rows (chosen by a hash of doc_id); all rows are scored.
Labels, language, source and doc_id are no inputs of a score.

Defined cases: null or empty text has no words and scores as such; a null doc_id counts as empty text for the
held-out rule; labels other than 0 and 1 are ignored; a doc_id labelled twice counts as toxic if any
label says so; without labels of both kinds every score is 0; an empty table gives no rows; further
columns are ignored.

Plan: two passes over the labelled sample, one over the table; the only join is documents with labels on
doc_id.  The driver receives the lexicon, a score histogram and an evidence histogram, all bounded by the sample.
"""

from __future__ import annotations

import dataclasses
import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.storage import stage

from .tables import BoundedTable, plain_names, release

#: Labelled rows that the model is fitted on at most.
MAX_TRAINING = 20_000
#: Folds of crc32(doc_id); the first is held out, the last fits the curve, the others are counted.
FOLDS = 5
#: Cost of a word outside the lexicon.
DRIFT = 0.15
#: What a lexicon feature needs: z-score and size of its log-odds ratio.
MIN_Z, MIN_EFFECT = 4.0, 2.0
MIN_DOCUMENTS = 5
PRIOR = 500.0
CLIP = 6.0
PREFIXES = (4, 5, 6)
#: Evidence is rounded to this for the fit, and limited to this range.
BIN, RANGE = 0.25, 12.0
_DOUBLES = T.ArrayType(T.DoubleType())
_SCANNED = [T.StructField("__n", T.LongType()), T.StructField("__top", T.DoubleType()), T.StructField("__further", _DOUBLES), T.StructField("__hits", _DOUBLES)]
_LETTERS = regex.compile(r"[\p{L}\p{N}]+")


@dataclasses.dataclass(frozen=True)
class Model:
    """Lexicon and curve; ``usable`` is false where labels of one kind are missing."""

    lexicon: dict[str, float] = dataclasses.field(default_factory=dict)
    scale: float = 1.0
    intercept: float = 0.0
    slope: float = 0.0

    @property
    def usable(self) -> bool:
        return self.slope > 0


def features(word: str) -> list[str]:
    """Features of a word, longest first: the word itself, then its beginnings."""
    return [word, *(f"{word[:k]}*" for k in reversed(PREFIXES) if len(word) > k)]


def plain(word: bytes) -> str:
    """Letters and digits of a word in lower case."""
    return "".join(_LETTERS.findall(word.decode().lower()))


# --- scan -----------------------------------------------------------------------------


def segments(scores: list[tuple[int, float]], drift: float) -> list[float]:
    """Scores of all maximal-scoring segments; ``scores`` has (position, score) of the words that cost no drift.

    Linear: each candidate keeps the running total before and at its end and merges with the nearest
    earlier candidate that starts lower, as long as that one ends lower too.
    """
    kept: list[tuple[float, float, int]] = []  # total before, total at the end, nearest earlier one that starts lower
    total, at = 0.0, -1
    for position, score in scores:
        total -= drift * (position - at - 1)
        at = position
        before, total = total, total + score
        if score <= 0:
            continue
        start, end = before, total
        while True:
            k = len(kept) - 1
            while k >= 0 and kept[k][0] >= start:
                k = kept[k][2]
            if k < 0 or kept[k][1] >= end:
                kept.append((start, end, k))
                break
            start = kept[k][0]
            del kept[k:]
    return [end - start for start, end, _ in kept]


class _Scorer:
    def __init__(self, lexicon: dict[str, float]):
        self._lexicon = lexicon
        self._table = BoundedTable(self._score, 100_000)

    def _score(self, word: bytes) -> float:
        text = plain(word)
        return next((self._lexicon[f] for f in features(text) if f in self._lexicon), 0.0) if text else 0.0

    def hits(self, text: str, drift: float) -> tuple[int, list[tuple[int, float]]]:
        """Number of words, and (position, score) of those in the lexicon; repeats count less until the total is at a new low."""
        words = text.encode().split()
        found = np.fromiter(map(self._table.__getitem__, words), np.float64, len(words))
        uses: Counter[bytes] = Counter()
        hits = []
        total, low, at = 0.0, 0.0, -1
        for place in np.flatnonzero(found).tolist():
            total -= drift * (place - at - 1)
            at = place
            if total <= low:
                low = total
                uses.clear()
            uses[words[place]] += 1
            score = float(found[place]) / uses[words[place]]
            total += score
            hits.append((place, score))
        return len(words), hits


def _scan(batches: Iterator[pa.RecordBatch], lexicon: dict[str, float], drift: float, keep_text: bool) -> Iterator[pa.RecordBatch]:
    scorer = _Scorer(lexicon)
    for batch in batches:
        lengths, tops, further, values = [], [], [], []
        for text in batch.column("text"):
            n, hits = scorer.hits(text.as_py() or "", drift)
            lengths.append(n)
            found = sorted(segments(hits, drift), reverse=True)
            tops.append(found[0] if found else 0.0)
            further.append(found[1:])
            values.append([s for _, s in hits])
        added = [pa.array(lengths, pa.int64()), pa.array(tops, pa.float64()), pa.array(further, pa.list_(pa.float64())), pa.array(values, pa.list_(pa.float64()))]
        kept = [c for c in batch.schema.names if keep_text or c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *added], [*kept, "__n", "__top", "__further", "__hits"])
    release()


def scan(rows: DataFrame, lexicon: dict[str, float], *, drift: float = DRIFT, keep_text: bool = False) -> DataFrame:
    """Adds __n (words), __top (best segment), __further (other segments) and __hits; without ``keep_text`` the text goes."""
    kept = [f for f in rows.schema.fields if keep_text or f.name != "text"]
    schema = T.StructType([*kept, *_SCANNED])
    return rows.mapInArrow(functools.partial(_scan, lexicon=lexicon, drift=drift, keep_text=keep_text), schema)


def evidence(scale: float) -> Column:
    """Extreme-value statistic of the best segment plus what further significant ones add."""
    size = F.log(F.greatest("__n", F.lit(1)).cast("double"))
    added = F.aggregate(
        F.transform("__further", lambda s, k: F.greatest(F.lit(scale) * s - size - F.log((k + 2).cast("double")), F.lit(0.0))), F.lit(0.0), lambda a, x: a + x
    )
    value = F.lit(scale) * F.col("__top") - size + added
    return F.greatest(F.least(value, F.lit(RANGE)), F.lit(-RANGE))


# --- training ---------------------------------------------------------------------------


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, list[int]] = {}
    names = ["feature", "toxic_uses", "clean_uses", "toxic_docs", "clean_docs"]

    def flush() -> pa.RecordBatch:
        columns = list(zip(*found.values(), strict=True)) if found else [[]] * 4
        out = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *(pa.array(c, pa.int64()) for c in columns)], names)
        found.clear()
        return out

    table = BoundedTable(plain, 100_000)
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            uses: Counter[str] = Counter()
            for word, n in Counter(map(table.__getitem__, (text.as_py() or "").encode().split())).items():
                if word:
                    uses[""] += n
                    for feature in features(word):
                        uses[feature] += n
            side = 0 if toxic else 1
            for feature, n in uses.items():
                counts = found.setdefault(feature, [0, 0, 0, 0])
                counts[side] += n
                counts[side + 2] += 1
            if len(found) > 100_000:
                yield flush()
    if found:
        yield flush()
    release()


def _lexicon(rows: DataFrame) -> dict[str, float]:
    """Log-odds of the features that tell toxic from clean texts; the empty feature counts all words."""
    counted = rows.select(F.col("toxic").cast("int").alias("toxic"), F.col("text").cast("string").alias("text")).mapInArrow(
        _count, "feature string, toxic_uses long, clean_uses long, toxic_docs long, clean_docs long"
    )
    sums = counted.groupBy("feature").agg(*[F.sum(c).cast("double").alias(c) for c in counted.columns[1:]])
    sums = stage(sums.filter((F.col("feature") == "") | (F.col("toxic_docs") + F.col("clean_docs") >= MIN_DOCUMENTS)), "toxicity-counts")
    whole = sums.filter("feature = ''").first()
    if whole is None or not whole["toxic_uses"] or not whole["clean_uses"]:
        return {}
    t, c = whole["toxic_uses"], whole["clean_uses"]
    prior = F.lit(PRIOR / (t + c)) * (F.col("toxic_uses") + F.col("clean_uses"))
    odds = {side: F.log((F.col(f"{side}_uses") + prior) / (F.lit(n + PRIOR) - F.col(f"{side}_uses") - prior)) for side, n in (("toxic", t), ("clean", c))}
    doc_prior = F.lit(0.5)
    spread = F.sqrt(1 / (F.col("toxic_docs") + doc_prior) + 1 / (F.col("clean_docs") + doc_prior))
    scored = sums.filter("feature <> ''").select("feature", (odds["toxic"] - odds["clean"]).alias("delta"), spread.alias("spread"))
    chosen = scored.filter(F.abs("delta") >= F.greatest(MIN_Z * F.col("spread"), F.lit(MIN_EFFECT))).select("feature", F.greatest(F.least("delta", F.lit(CLIP)), F.lit(-CLIP)).alias("delta"))
    return {r["feature"]: r["delta"] for r in chosen.collect()}


def _scale(histogram: list[tuple[float, int]], words: int, drift: float) -> float:
    """The positive lambda with sum(p * exp(lambda * s)) = 1; one best hit is added so that it exists."""
    scores = [(s, n) for s, n in histogram if n] + [(CLIP, 1)]
    total = max(words, 1) + 1
    rest = total - sum(n for _, n in scores)

    def excess(x: float) -> float:
        return sum(n * math.exp(x * s) for s, n in scores) / total + rest / total * math.exp(-x * drift) - 1

    low, high = 1e-3, 20.0
    if excess(low) > 0:  # clean texts drift upward; the smallest scale keeps their segments insignificant
        return low
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if excess(middle) > 0 else (middle, high)
    return low


def _curve(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope of the logistic curve through (evidence, clean, toxic) counts."""
    x = np.array([b[0] for b in bins])
    clean, toxic = (np.array([b[k] for b in bins], float) for k in (1, 2))
    n = clean + toxic
    w = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    ridge = np.diag([1e-3, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (toxic - n * p) - ridge @ w
        curvature = (design * (n * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(curvature, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_TRAINING, drift: float = DRIFT) -> Model:
    """Fit on labelled rows outside the held-out fold."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("toxic in (0, 1) and doc_id is not null").filter(fold() != 0)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    share = max_rows / max(known.count(), 1)
    if share < 1:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(known, "doc_id")
    rows = stage(rows.select("toxic", fold().alias("fold"), "text"), "toxicity-training")
    lexicon = _lexicon(rows.filter(F.col("fold") != FOLDS - 1))
    if not lexicon:
        return Model()
    seen = stage(scan(rows.filter(F.col("fold") == FOLDS - 1).select("toxic", "text"), lexicon, drift=drift), "toxicity-curve")
    clean = seen.filter("toxic = 0")
    words = clean.agg(F.sum("__n")).first()[0] or 0
    histogram = [(r[0], r[1]) for r in clean.select(F.explode("__hits").alias("s")).groupBy(F.round("s", 1)).count().collect()]
    scale = _scale(histogram, words, drift)
    at = (F.round(evidence(scale) / BIN) * BIN).alias("x")
    bins = [(r["x"], r["clean"], r["toxic"]) for r in seen.groupBy(at).agg(F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic")).collect()]
    if not any(b[1] for b in bins) or not any(b[2] for b in bins):
        return Model()
    intercept, slope = _curve(bins)
    return Model(lexicon, scale, intercept, max(slope, 0.0))


def _chance(model: Model) -> Column:
    return 1 / (1 + F.exp(-(F.lit(model.intercept) + F.lit(model.slope) * evidence(model.scale)))) if model.usable else F.lit(0.0)


def score(docs: DataFrame, model: Model, *, drift: float = DRIFT) -> DataFrame:
    """doc_id, held_out, score, predicted and passages (significant segments) of every document."""
    rows = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model.lexicon, drift=drift)
    size = F.log(F.greatest("__n", F.lit(1)).cast("double"))
    passages = (F.lit(model.scale) * F.col("__top") > size).cast("int") + F.size(F.filter("__further", lambda s: F.lit(model.scale) * s > size))
    chance = _chance(model)
    return rows.select("doc_id", (fold() == 0).alias("held_out"), chance.alias("score"), (chance >= 0.5).cast("int").alias("predicted"), passages.alias("passages"))


def clean_documents(docs: DataFrame, model: Model, *, drift: float = DRIFT) -> DataFrame:
    """The documents that the model doesn't predict to be toxic, all columns kept."""
    plain = plain_names(docs, "doc_id", "text")
    scanned = scan(plain, model.lexicon, drift=drift, keep_text=True)
    return scanned.filter(_chance(model) < 0.5).select(*plain.columns).toDF(*docs.columns)
