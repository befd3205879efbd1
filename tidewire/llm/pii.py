"""Personal data by bootstrapped contextual extraction, in Spark expressions only.

Base patterns find e-mail and network addresses, card and phone numbers; these are the seeds.  The words around an
instance are its lexical patterns: one to three words before it, one to three behind it, and one on both sides.  Patterns and
instances form a graph that is scored in rounds:

* A pattern's trust for a kind is the share of its occurrences in the corpus, around anything at all, that are trusted
  instances of the kind; it needs ``MIN_SEEDS`` different ones.
* An instance is trusted as much as its best pattern; patterns of less than ``MIN_TRUST`` make nobody trusted.
* Instances that are trusted anew induce patterns in the next round, until a round adds none.

Candidates are words with a digit or an at sign that no base span touches; groups of digits one after another are one candidate.
An occurrence with a trusted pattern around it becomes a span.

Base patterns are matched leftmost without overlaps, a kind at a time; matches that fail their check are dropped.  Places
come from the texts between matches, so no text leaves its row; all offsets are code points.

Defined cases: null text is empty; an empty text has no spans; a null doc_id stays null; repeated rows are searched
alike; an empty table gives no rows; further columns are ignored by ``find`` and kept by ``redact``.

Plan: one pass for spans and contexts; the graph holds one row per pattern and instance, patterns as 64-bit hashes; one pass counts
the word groups of the corpus that are patterns of enough different instances.  They are looked up in a broadcast table up to
``MAX_BROADCAST`` of them, and beyond that counted first and joined then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.storage import stage

from .tables import plain_names

KINDS = ("email", "ip", "card", "phone")
# The base patterns, possessive where that can't change a match, so that long runs take linear time.
BASE = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
_DIGITS = "[(+]*+[0-9][0-9().+/-]*+"
#: What may be an identifier: groups of digits one after another, or a word with a digit or an at sign.
TOKEN = (
    f"(?<![^\\x20\\x09-\\x0D])(?:{_DIGITS}(?![^\\x20\\x09-\\x0D])(?:\\x20{_DIGITS}(?![^\\x20\\x09-\\x0D]))*+"
    f"(?:\\x20{_DIGITS}(?=[,;:!?]++(?![^\\x20\\x09-\\x0D])))?+|[^\\x20\\x09-\\x0D0-9@]*+[0-9@][^\\x20\\x09-\\x0D]*+)"
)
WORD = "[^\\x20\\x09-\\x0D]+"

#: Different trusted instances a pattern needs, and the trust from which patterns and instances count.
MIN_SEEDS, MIN_TRUST = 3, 0.6
#: Most words of a pattern on one side.
WORDS = 3
#: Most patterns in a broadcast table (8 bytes each, some 16 MB with the table around them).
MAX_BROADCAST = 500_000
_SPAN = "array<struct<start:int,kind:int,end:int,left:array<string>,right:array<string>,token:string>>"
_CHUNK = 64


# --- matches and their places -----------------------------------------------------------------


def _once(value: Column, then) -> Column:
    """Hand an intermediate result on without computing it again."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _starts(lengths: Column) -> Column:
    """Running sums before each element of an array, by chunks."""
    add = lambda a, x: a + x
    total = lambda a: F.aggregate(a, F.lit(0), add)
    chunk = lambda i: F.floor(i / _CHUNK).cast("int")
    sums = F.transform(F.sequence(F.lit(0), chunk(F.size(lengths) - 1)), lambda c: total(F.slice(lengths, c * _CHUNK + 1, _CHUNK)))
    heads = _once(sums, lambda s: F.transform(s, lambda x, c: total(F.slice(s, F.lit(1), c))))
    return _once(heads, lambda h: F.transform(lengths, lambda x, i: F.get(h, chunk(i)) + total(F.slice(lengths, chunk(i) * _CHUNK + 1, i % _CHUNK))))


def matches(text: Column, pattern: str) -> Column:
    """Matches as an array of (found, start, before, after): the texts between this match and its neighbors."""
    empty = F.array().cast("array<struct<found:string,start:int,before:string,after:string>>")

    def placed(gaps: Column, found: Column) -> Column:
        lengths = F.transform(found, lambda m, i: F.length(m) + F.length(F.get(gaps, i)))
        return _once(
            _once(lengths, _starts),
            lambda s: F.transform(
                found,
                lambda m, i: F.struct(
                    m.alias("found"), (F.get(s, i) + F.length(F.get(gaps, i))).cast("int").alias("start"), F.get(gaps, i).alias("before"), F.get(gaps, i + 1).alias("after")
                ),
            ),
        )

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = _once(found, lambda m: F.when(F.size(m) > 0, _once(F.split(text, pattern), lambda g: placed(g, m))).otherwise(empty))
    return both


def _valid(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(found, "\\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(9, 15)


def _context(kind: int, m: Column) -> Column:
    """Place and neighboring words of a match, the nearest first; none where another match or the text's edge is next to it."""
    before, after = (F.translate(m[side], "\t\n\x0b\x0c\r", "     ") for side in ("before", "after"))
    word = lambda w: w != ""
    # Some spaces between the words are more than one; six times as many parts hold the words of nearly all texts.
    last = F.slice(F.reverse(F.filter(F.split(F.lower(F.substring_index(F.rtrim(before), " ", -6 * WORDS)), " "), word)), 1, WORDS)
    rest = F.when(F.instr(after, " ") > 0, F.substr(after, F.instr(after, " "))).otherwise("")
    first = F.slice(F.filter(F.split(F.lower(F.substring_index(F.ltrim(rest), " ", 6 * WORDS)), " "), word), 1, WORDS)
    return F.struct(
        m["start"].alias("start"), F.lit(kind).alias("kind"), (m["start"] + F.length(m["found"])).alias("end"),
        last.alias("left"), first.alias("right"), F.lower(m["found"]).alias("token"),
    )


def _of_kind(text: Column, number: int) -> Column:
    kind = KINDS[number]
    good = F.filter(matches(text, BASE[kind]), lambda m: _valid(kind, m["found"]))
    # A quick look first: most texts have none.
    signs = {"email": F.contains(text, F.lit("@")), "ip": text.rlike("[0-9]\\.[0-9]"), "card": text.rlike("[0-9][\\x20-]?[0-9]"), "phone": F.contains(text, F.lit("+"))}
    may = signs[kind]
    empty = F.array().cast(_SPAN)
    return F.when(may, F.transform(good, lambda m: _context(number, m))).otherwise(empty)


def base_spans(docs: DataFrame, *further: str) -> DataFrame:
    """Further columns, row, base (spans in order with their contexts) and tokens (possible identifiers with theirs)."""
    text = F.col("__text")
    rows = docs.select(*further, F.col("doc_id").cast("long").alias("__doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    tokens = F.when(text.rlike("[0-9@]"), F.transform(matches(text, TOKEN), lambda m: _context(-1, m)))
    return rows.select(
        *further,
        F.monotonically_increasing_id().alias("row"),
        F.array_sort(F.concat(*[_of_kind(text, k) for k in range(len(KINDS))])).alias("base"),
        F.coalesce(tokens, F.array().cast(_SPAN)).alias("tokens"),
    )


# --- the graph -----------------------------------------------------------------------------------


def _group(*words: Column) -> Column:
    """Names a group of words one after another."""
    return F.xxhash64(F.lit(len(words)), *words)


def _around(first: Column, last: Column) -> Column:
    """Names two words with anything between them."""
    return F.xxhash64(F.lit(0), first, last)


def _patterns() -> Column:
    """The patterns of a span: (pattern, words) with the name of the word group that the corpus is searched for."""
    found = []
    for side, name in enumerate(("left", "right")):
        for n in range(1, WORDS + 1):
            words = [F.get(name, i) for i in (range(n - 1, -1, -1) if name == "left" else range(n))]
            group = F.when(F.size(name) >= n, _group(*words))
            found.append(F.struct(F.xxhash64(F.lit(side), group).alias("pattern"), group.alias("words")))
    both = F.when((F.size("left") > 0) & (F.size("right") > 0), _around(F.get("left", F.lit(0)), F.get("right", F.lit(0))))
    found.append(F.struct(F.xxhash64(F.lit(2), both).alias("pattern"), both.alias("words")))
    return F.filter(F.array(*found), lambda p: p["words"].isNotNull())


def _marked(rows: DataFrame) -> DataFrame:
    """All base spans and candidates, one a row; ``covered`` candidates are touched by a base span."""
    spans = rows.select("row", F.explode(F.concat("base", "tokens")).alias("s")).select("row", "s.*")
    # Both windows only look back, which takes one pass; a base span comes before a candidate with the same start.
    forth, back = Window.partitionBy("row").orderBy("start", F.desc("kind")), Window.partitionBy("row").orderBy(F.desc("start"), "kind")
    is_base = F.col("kind") >= 0
    reached = F.max(F.when(is_base, F.col("end"))).over(forth.rowsBetween(Window.unboundedPreceding, -1))
    coming = F.min(F.when(is_base, F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    touched = F.coalesce(reached > F.col("start"), F.lit(False)) | F.coalesce(coming < F.col("end"), F.lit(False))
    kept = spans.withColumn("covered", touched).filter("kind >= 0 or not covered")
    return stage(kept.select("row", "start", "kind", "end", "token", _patterns().alias("patterns")), "pii-marked")


def _occurrences(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """words and occurrences: how often each wanted word group stands in the corpus."""
    lowered = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    tokens = F.filter(F.split(lowered, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def groups(w: Column) -> Column:
        at = lambda i, k: F.get(w, i + k)
        inside = lambda i, k, name: F.when(i + k < F.size(w), name)
        each = lambda i: F.array(
            *[inside(i, n - 1, _group(*[at(i, k) for k in range(n)])) for n in range(1, WORDS + 1)], inside(i, 2, _around(at(i, 0), at(i, 2)))
        )
        return F.when(F.size(w) > 0, F.flatten(F.transform(F.sequence(F.lit(0), F.size(w) - 1), each)))

    every = texts.select(F.explode(_once(tokens, groups)).alias("words"))
    if wanted.count() <= MAX_BROADCAST:
        return every.join(F.broadcast(wanted), "words", "left_semi").groupBy("words").agg(F.count("*").alias("occurrences"))
    counted = every.groupBy("words").agg(F.count("*").alias("occurrences"))
    return counted.join(wanted.hint("merge"), "words", "left_semi")


def graph(rows: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged spans, edges (pattern, token, uses, occurrences, seed) and seeds (token, kind).  ``texts`` has the column ``text``."""
    marked = _marked(rows)
    edges = marked.select("token", F.explode("patterns").alias("p")).groupBy("p.pattern", "p.words", "token").agg(F.count("*").alias("uses"))
    edges = stage(edges, "pii-edges")
    # A pattern of fewer instances can never be trusted.
    able = edges.groupBy("pattern", "words").agg(F.sum("uses").alias("all_uses"), F.count("*").alias("n")).filter(F.col("n") >= MIN_SEEDS)
    able = stage(able.drop("n"), "pii-able")
    found = _occurrences(texts, stage(able.select("words").distinct(), "pii-words"))
    # An instance of several words, or one that is part of a word, can stand where the corpus has no such group.
    total = F.greatest(F.coalesce("occurrences", F.lit(0)), "all_uses").alias("occurrences")
    counted = stage(able.join(found, "words", "left").select("pattern", total), "pii-occurrences")
    known = stage(edges.drop("words").join(counted, "pattern"), "pii-graph")
    seeds = marked.filter("kind >= 0").select("token", "kind").distinct()
    return marked, known, stage(seeds.withColumn("belief", F.lit(1.0)), "pii-seeds")


def trusted_patterns(known: DataFrame, seeds: DataFrame) -> DataFrame:
    """Rounds over the graph: pattern, kind and trust of every pattern that ends up trusted."""
    trusted, number = seeds, None
    while True:
        support = known.join(trusted, "token").groupBy("pattern", "kind").agg(
            F.count("*").alias("instances"), F.sum(F.col("uses") * F.col("belief")).alias("good"), F.max("occurrences").alias("occurrences")
        )
        trust = F.least(F.col("good") / F.col("occurrences"), F.lit(1.0))
        patterns = stage(support.withColumn("trust", trust).filter((F.col("instances") >= MIN_SEEDS) & (F.col("trust") >= MIN_TRUST)).select("pattern", "kind", "trust"), "pii-patterns")
        reached = known.join(patterns, "pattern").groupBy("token", "kind").agg(F.max("trust").alias("belief"))
        more = trusted.union(reached.join(seeds, ["token", "kind"], "left_anti").select("token", "kind", "belief"))
        # Beliefs only rise: an instance keeps the best of all rounds.
        trusted = stage(more.groupBy("token", "kind").agg(F.max("belief").alias("belief")), "pii-trusted")
        before, number = number, trusted.count()
        if number == before:
            return patterns


def trusted_tokens(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Candidates that trusted patterns surround: row, start, end, kind."""
    marked, known, seeds = graph(rows, texts)
    patterns = trusted_patterns(known, seeds)
    candidates = marked.filter("kind < 0").select("row", "start", "end", F.explode("patterns.pattern").alias("pattern"))
    best = F.max(F.struct("trust", (-F.col("kind")).alias("order"))).alias("best")
    chosen = candidates.join(patterns, "pattern").groupBy("row", "start", "end").agg(best)
    return chosen.select("row", "start", "end", (-F.col("best.order")).alias("kind"))


def _named(s: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))


def all_spans(docs: DataFrame, *further: str) -> DataFrame:
    """Further columns, row, base and spans (base and found, by start, then kind)."""
    rows = stage(base_spans(docs, *further), "pii-spans")
    found = trusted_tokens(rows, docs).groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("found"))
    place = lambda name: F.transform(name, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    joined = rows.drop("tokens").join(found, "row", "left").withColumn("base", place("base"))
    return joined.withColumn("spans", F.when(F.col("found").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", place("found"))))).drop("found")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_<kind> and base_sha256 of the base spans, and all spans as text."""
    rows = all_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    counts = [F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    joined = lambda name: F.array_join(F.transform(name, _named), ",")
    return rows.select("doc_id", *counts, F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def _reached(ends: Column) -> Column:
    """The largest of all earlier elements of an array (0 before the first), by chunks."""
    chunk = lambda i: F.floor(i / _CHUNK).cast("int")
    most = lambda a: F.coalesce(F.array_max(a), F.lit(0))
    tops = F.transform(F.sequence(F.lit(0), chunk(F.size(ends) - 1)), lambda c: most(F.slice(ends, c * _CHUNK + 1, _CHUNK)))
    heads = _once(tops, lambda t: F.transform(t, lambda x, c: most(F.slice(t, F.lit(1), c))))
    return _once(heads, lambda h: F.transform(ends, lambda x, i: F.greatest(F.get(h, chunk(i)), most(F.slice(ends, chunk(i) * _CHUNK + 1, i % _CHUNK)))))


def _masked(text: Column, spans: Column) -> Column:
    """The text with its spans replaced, cut once at all borders; a span that begins inside an earlier one goes with it."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    part = 1024  # code points: a place in a text is found by counting from its start, so texts are cut into short parts first

    def joined(parts: Column, before: Column) -> Column:
        of = lambda i: F.floor(i / part).cast("int")

        def piece(a: Column, b: Column) -> Column:
            one = F.substr(F.get(parts, of(a)), a % part + 1, b - a)
            middle = F.array_join(F.slice(parts, of(a) + 2, F.greatest(of(b) - of(a) - 1, F.lit(0))), "")
            more = F.concat(F.substr(F.get(parts, of(a)), a % part + 1, F.lit(part)), middle, F.substr(F.coalesce(F.get(parts, of(b)), F.lit("")), F.lit(1), b % part))
            return F.when(b <= a, "").when(of(a) == of(b), one).otherwise(more)

        masked = F.transform(spans, lambda s, i: F.when(s["start"] >= F.get(before, i), F.concat(piece(F.get(before, i), s["start"]), F.get(names, s["kind"]))).otherwise(""))
        return F.concat(F.array_join(masked, ""), piece(F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text)))

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{part}}}"), F.lit(0))
    reached = _once(F.transform(spans, lambda s: s["end"]), _reached)
    return _once(cut, lambda parts: _once(reached, lambda before: joined(parts, before)))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; other columns are kept."""
    plain = plain_names(docs, "doc_id", "text", "n_chars").withColumn("place", F.monotonically_increasing_id())
    rows = stage(plain, "pii-documents")
    spans = all_spans(rows, "place").select("place", "spans").filter(F.size("spans") > 0)
    text = F.col("text").cast("string")
    known = rows.join(spans, "place", "left").withColumn("clean", F.when(F.col("spans").isNull(), text).otherwise(_masked(text, F.col("spans"))))
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return known.select(*[new.get(c, F.col(c)).alias(c) for c in plain.columns[:-1]]).toDF(*docs.columns)
