"""Mixing sources to target weights, in Spark expressions only.

Targets share the corpus by weight; what lies above three times a source's size is shared anew among the others.
Each source's words, in the order of doc_id, are packed into blocks of fixed length.  The mix has slots for
whole blocks.  First the counts of each source in each output shard are drawn: a multinomial draw, conditioned on each source's
total so that the totals meet their targets.  The slots of a shard are made from its counts: with the sums of earlier shards' counts they
number a source's slots, and its k-th slot takes block ``permutation(epoch, k mod blocks)`` of epoch ``k div blocks``.
Blocks are joined by that index.

The permutations are swap-or-not shuffles: bijections of any range 0 .. n-1 that need no table, so slots are
computed where they are and a rerun gives the same mix.

Defined cases: null text has no words; null sources form one source, the last; documents without words take
nothing; null ids come first in their source; repeated rows are documents of their own; without words
every target is 0; an empty table gives no rows; further columns are ignored by ``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.storage import stage

from .running import ordered
from .tables import plain_names

WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_USES = 3
#: Words in a block, blocks in an output shard.
BLOCK = 32
SHARD_SLOTS = 65_536
SEED = 20
ROUNDS = 24
_CHUNK = 16_384


def permuted(index: Column, size: Column, *keys: Column) -> Column:
    """Place of ``index`` in a pseudorandom permutation of 0 .. size-1 chosen by ``keys`` (swap-or-not shuffle)."""

    def one_round(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), r, *keys), size) - x, size)
        swap = F.pmod(F.xxhash64(F.lit(SEED + 1), r, F.greatest(x, partner), *keys), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), one_round)


def water_level(sources: DataFrame, total: int) -> float:
    """The level at which min(most, level * weight) shares ``total`` out; columns ``most`` and ``weight``."""
    capped, level = None, 0.0
    while True:
        over = F.lit(False) if capped is None else F.col("most") <= F.lit(level) * F.col("weight")
        at = sources.agg(F.sum(F.when(over, F.col("most")).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))), F.count_if(over)).first()
        if not at[1] or at[2] == capped:
            return level
        capped, level = at[2], (total - at[0]) / at[1]


def _sized(docs: DataFrame, *further: str) -> DataFrame:
    return docs.select(
        *further,
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").isNull().alias("no_source"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
    )


def plan(rows: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK, most_uses: int = MOST_USES) -> DataFrame:
    """One row per source: number, source_size, target, blocks, slots and the first of them, from ``source`` and ``size``."""
    sizes = rows.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"), F.min("size_before").alias("source_start"))
    numbered = ordered(sizes, ["no_source", "source"], label="mixing-sources").withColumnRenamed("row", "number")
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod("number", F.lit(len(weights))).cast("int"))
    weighted = numbered.withColumns({"weight": weight, "most": F.col("source_size") * most_uses})
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(weighted, total)
    target = F.least(F.col("most").cast("double"), F.lit(level) * F.col("weight"))
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = (
        weighted.withColumns({"target": target, "blocks": blocks})
        .withColumn("slots", F.least(F.round(share * F.col("blocks")).cast("long"), most_uses * F.col("blocks")))
        .select("number", "no_source", "source", "source_start", "source_size", "target", "blocks", "slots")
    )
    return ordered(planned, ["number"], ["slots"], label="mixing-plan").drop("row")


def _chunked(rows: DataFrame) -> DataFrame:
    """Rows with ``slots`` cut into chunks of (at, upto), dealt to many tasks: there are few of them, but each is worth many slots."""
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(_CHUNK).cast("long")))
    # A count of partitions of its own: few and short as the chunks are, adaptive execution would put them into one task.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = rows.filter("slots > 0").withColumn("at", at).withColumn("upto", F.least(F.col("at") + _CHUNK, F.col("slots")) - 1)
    return chunks.repartition(tasks, "number", "at")


def shard_counts(planned: DataFrame) -> DataFrame:
    """Slots of each source (``number``) in each output ``shard``: every slot draws its shard, all alike.

    A source's counts over the shards are multinomial; a shard's counts over the sources are so too, under the condition
    that each source's total is that of the plan.
    """
    every = planned.agg(F.sum("slots")).first()[0] or 0
    shards = max(-(-every // SHARD_SLOTS), 1)
    each = _chunked(planned).select("number", F.explode(F.sequence("at", "upto")).alias("k"))
    shard = F.pmod(F.xxhash64(F.lit(SEED + 2), "number", "k"), F.lit(shards).cast("long"))
    return each.groupBy("number", shard.alias("shard")).agg(F.count("*").alias("slots"))


def slots(planned: DataFrame) -> DataFrame:
    """Every slot of the mix, made from the counts: output shard, source number, epoch and block index.

    A source's slots are numbered through its shards, so a shard has those from the sum of its earlier shards' counts on.
    """
    counts = ordered(shard_counts(planned), ["number", "shard"], ["slots"], label="mixing-counts")
    of = planned.select("number", "blocks", F.col("slots_before").alias("start"))
    drawn = counts.join(of, "number").withColumn("first", F.col("slots_before") - F.col("start"))
    each = _chunked(drawn).select("number", "shard", "blocks", F.explode(F.sequence(F.col("first") + F.col("at"), F.col("first") + F.col("upto"))).alias("k"))
    epoch = F.expr("k div blocks")
    block = permuted(F.col("k") % F.col("blocks"), F.col("blocks"), F.col("number"), epoch)
    return each.select("number", "shard", epoch.alias("epoch"), block.alias("block"))


def pieces(rows: DataFrame, planned: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """Words ``first`` .. ``last`` of document ``row`` lie in ``block`` of source ``number``."""
    of = planned.select("number", F.col("no_source").alias("n"), F.col("source").alias("s"), "source_start")
    start = rows.join(of, (F.col("no_source") == F.col("n")) & F.col("source").eqNullSafe(F.col("s"))).select(
        "row", "size", "number", (F.col("size_before") - F.col("source_start")).alias("start")
    )
    spread = start.filter("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
    return spread.select(
        "row", "number", "block",
        F.greatest(F.col("block") * block - F.col("start"), F.lit(0)).alias("first"),
        (F.least((F.col("block") + 1) * block - F.col("start"), F.col("size")) - 1).alias("last"),
    )


def uses(rows: DataFrame, planned: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """The pieces that the mix takes, how often, and the output shards in order: blocks joined with the slots by index."""
    drawn = slots(planned).groupBy("number", "block").agg(F.count("*").alias("times"), F.array_sort(F.collect_list("shard")).alias("shards"))
    # Sizes after an explode are underestimated; the hint keeps the slots from being broadcast.
    return pieces(rows, planned, block=block).join(drawn.hint("merge"), ["number", "block"])


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target of its source and taken words of every document."""
    rows = ordered(_sized(docs), ["no_source", "source", "doc_id", "size"], ["size"], label="mixing-rows")
    planned = plan(rows, weights=weights, block=block)
    taken = uses(rows, planned, block=block).groupBy("row").agg(F.sum((F.col("last") - F.col("first") + 1) * F.col("times")).alias("taken"))
    of = planned.select(F.col("no_source").alias("n"), F.col("source").alias("s"), "source_size", "target")
    return (
        rows.join(of, (F.col("no_source") == F.col("n")) & F.col("source").eqNullSafe(F.col("s")))
        .join(taken, "row", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed_documents(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK, with_shard: bool = False) -> DataFrame:
    """The mix as documents: one row per document and use, with the words taken that often; other columns are kept.

    ``with_shard`` adds ``shard``, the output shard that drew the first of the row's blocks: a use of a document stays together.
    """
    plain = plain_names(docs, "doc_id", "source", "text", "n_chars").withColumn("id", F.monotonically_increasing_id())
    known = stage(plain, "mixing-documents")
    rows = ordered(_sized(known, "id"), ["no_source", "source", "doc_id", "id"], ["size"], label="mixing-rows")
    planned = plan(rows, weights=weights, block=block)
    used = uses(rows, planned, block=block).join(rows.select("row", "id"), "row")
    each = used.select("id", "first", "last", F.posexplode("shards").alias("use", "shard"))
    ranges = each.groupBy("id", "use").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("ranges"), F.min_by("shard", "first").alias("shard")).drop("use")
    parts = F.regexp_extract_all(F.col("text").cast("string"), F.lit("[^\\x20\\x09-\\x0D]++[\\x20\\x09-\\x0D]*+"), F.lit(0))

    def taken(p: Column) -> Column:
        return F.array_join(F.flatten(F.transform("ranges", lambda r: F.slice(p, (r["first"] + 1).cast("int"), (r["last"] - r["first"] + 1).cast("int")))), "")

    # The words go through a one-element array, so that they are found once and not anew for every range.
    text = F.rtrim(F.get(F.transform(F.array(parts), taken), F.lit(0)))
    columns = plain.columns[:-1]
    chosen = known.join(ranges, "id").select(*[text.alias("text") if c == "text" else F.col(c) for c in columns], "shard")
    counted = chosen.select(*[F.length("text").cast("long").alias("n_chars") if c == "n_chars" else F.col(c) for c in columns], "shard")
    return counted.toDF(*docs.columns, "shard") if with_shard else counted.drop("shard").toDF(*docs.columns)
