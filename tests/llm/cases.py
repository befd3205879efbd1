"""Small tables with the awkward cases that every operator has to stand."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977} x{i}" for i in range(30_000))
TEXTS = [
    None, "", " \n\t ", "one", "One two three four five six seven", "one two three four five six seven", "a b c a b c a b c", "same text here", "same text here",
    "same text here", "line one\nline one\nline two", "ünï çödé ß 漢字  x y", "x" * 5000, LONG, "THE the The", "it's 12 o'clock; don't <|endoftext|> stop",
    "mail a.b@c.de, 10.0.0.1 or +1 (234) 555-6789 card 4111 1111 1111 1111", "!!! ### $$$ |||", "\x1c\x85 odd \x0b spaces\x0cend", "same text here",
]
#: Names that operators use for columns of their own.
CLASHING = ["row", "fp", "n", "size", "number", "block", "words", "lines", "start", "slots", "times", "score", "low", "kept", "shard", "end", "found", "tokens", "base", "toxic", "fold", "__row", "__id", "__spans", "__clean", "__n", "__ranges", "dotted.name", "c0", "a`b"]


def rows() -> list[tuple]:
    """doc_id, text and source; two null ids, repeated rows and a source with a third of all."""
    made = [(None if i in (3, 7) else i * 10, t, None if i % 7 == 0 else "hot" if i % 3 == 0 else f"s{i % 4}") for i, t in enumerate(TEXTS)]
    return made + made[4:6]


def documents(spark: SparkSession, given: list[tuple] | None = None) -> DataFrame:
    """The table ``documents`` with further columns of clashing names."""
    given = rows() if given is None else given
    data = [(i, t, None if k % 2 else "en", s, len(t) if t else None) for k, (i, t, s) in enumerate(given)]
    table = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    return table.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


def no_documents(spark: SparkSession) -> DataFrame:
    return documents(spark, []).limit(0)


def words(text: str | None) -> list[str]:
    """Words between ASCII white space."""
    return [w.decode() for w in (text or "").encode().split()]
