"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import balltree, extraction, linededup, merkle, mixing, packing, pii, rules, sharding, simhash, toxicity, warc, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Place of the word vocabulary used by the packing query."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary(), with_ids=False, word_table=200_000, keep_words=True)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_composite_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_pages(table(spark, sf_dir, "pages"))


def op3_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).drop("passages")


def op4_decision_list_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op6_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_incremental_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    n, explained, error = (model.n, model.explained, model.identity_error) if model else (0, [], 0.0)
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*map(F.lit, explained)).cast("array<double>"), "at").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op12_incremental_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in merkle.FIELDS}
    tampered = fields | {"text": F.replace("text", F.lit("\n"))}
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    leaf = merkle.leaf_of(list(fields.values()))
    leaves = docs.select("doc_id", "source", leaf.alias("leaf"), F.when(chosen, merkle.leaf_of(list(tampered.values()))).otherwise(leaf).alias("claim"))
    checked = merkle.verified(merkle.manifest(leaves), F.col("claim"))
    return checked.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_two_filter_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = linededup.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


QUERIES = {
    "op1_power_of_two_packing": op1_power_of_two_packing,
    "op2_composite_text_density": op2_composite_text_density,
    "op3_segment_toxicity": op3_segment_toxicity,
    "op4_decision_list_quality": op4_decision_list_quality,
    "op5_simhash_multi_index": op5_simhash_multi_index,
    "op6_ball_tree_top_k": op6_ball_tree_top_k,
    "op7_minimax_shards": op7_minimax_shards,
    "op8_warc_salvage": op8_warc_salvage,
    "op9_contextual_pii": op9_contextual_pii,
    "op10_source_mixing": op10_source_mixing,
    "op11_incremental_whitening": op11_incremental_whitening,
    "op12_incremental_witnesses": op12_incremental_witnesses,
    "op13_two_filter_line_dedup": op13_two_filter_line_dedup,
}

# SQL for the queries that it can express.  The others need the tokenizer, learned models, XXH64 or CRC-32 and are tested
# against plain computations.
ORACLE: dict[str, str] = {
    "op6_ball_tree_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(x::double * 256)) as v, row_number() over () as r
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.r, q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score, c.r as other
            from v q join v c on q.r <> c.r where q.vec_id % 50 = 0
        )
        select query_id, cast(row_number() over (partition by r order by score desc, vec_id, other) as integer) as rank, vec_id, score
        from scored qualify row_number() over (partition by r order by score desc, vec_id, other) <= 5
    """,
    "op8_warc_salvage": """
        with p as (
            select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h,
                   row_number() over (partition by coalesce(html, '') order by page_id nulls last) as k,
                   first_value(page_id) over (partition by coalesce(html, '') order by page_id nulls last) as first_id
            from pages
        ), digits as (
            select *, list_transform(range(8), lambda i: ('0x' || substr(h, 5 * i::int + 1, 5))::bigint) as five from p
        )
        select page_id, cast(payload_bytes as bigint) as payload_bytes,
               array_to_string(list_transform(five, lambda n:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((n >> 15) & 31 as int) + 1, 1) ||
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((n >> 10) & 31 as int) + 1, 1) ||
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((n >> 5) & 31 as int) + 1, 1) ||
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(n & 31 as int) + 1, 1)), '') as payload_digest,
               case when k = 1 then 'response' else 'revisit' end as record_type,
               case when k > 1 then first_id end as refers_to
        from digits
    """,
    "op12_incremental_witnesses": """
        with recursive d as (
            select row_number() over () as r, *, list_reduce(
                list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
                lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda i: 0::bigint)),
                                              lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) as crc
            from documents
        ), leaves as (
            select r, doc_id, coalesce('=' || source, '') as g,
                   sha256(coalesce(strlen(doc_id::varchar) || ':' || doc_id::varchar, '-') || coalesce(strlen(source) || ':' || source, '-')
                       || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars::varchar, '-')
                       || coalesce(strlen(text) || ':' || text, '-')) as leaf,
                   case when (4294967295 - crc) % 2 = 0 then
                       sha256(coalesce(strlen(doc_id::varchar) || ':' || doc_id::varchar, '-') || coalesce(strlen(source) || ':' || source, '-')
                           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars::varchar, '-')
                           || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
                   end as tampered
            from d
        ), trees as (
            select r, g, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as i, leaf as node,
                   coalesce(tampered, leaf) as folded, '' as proof, 0 as level from leaves
            union all
            select t.r, t.g, t.i // 3, sha256(array_to_string(u.run, '')),
                   sha256(array_to_string(list_concat(u.run[1:t.i % 3], [t.folded], u.run[t.i % 3 + 2:]), '')),
                   t.proof || array_to_string(list_concat(u.run[1:t.i % 3], u.run[t.i % 3 + 2:]), ''), t.level + 1
            from trees t
            join (select g, i // 3 as up, list(node order by i) as run from (select distinct g, i, node from trees) group by g, i // 3) u
              on t.g = u.g and t.i // 3 = u.up
            where t.g in (select g from trees where i > 0)
        ), subroots as (
            select * from trees qualify row_number() over (partition by r order by level desc) = 1
        ), tops as (
            select r, dense_rank() over (order by g) - 1 as i, node, folded, proof, 0 as level from subroots
            union all
            select t.r, t.i // 3, sha256(array_to_string(u.run, '')),
                   sha256(array_to_string(list_concat(u.run[1:t.i % 3], [t.folded], u.run[t.i % 3 + 2:]), '')),
                   t.proof || array_to_string(list_concat(u.run[1:t.i % 3], u.run[t.i % 3 + 2:]), ''), t.level + 1
            from tops t
            join (select i // 3 as up, list(node order by i) as run from (select distinct i, node from tops) group by i // 3) u on t.i // 3 = u.up
            where exists (select 1 from tops where i > 0)
        ), roots as (
            select * from tops qualify row_number() over (partition by r order by level desc) = 1
        )
        select l.doc_id, l.leaf, s.node as subroot, t.node as root, sha256(t.proof) as proof_sha256, t.folded as folded_root,
               t.folded = t.node as verified
        from leaves l join subroots s using (r) join roots t using (r)
    """,
    "op13_two_filter_line_dedup": """
        with d as (
            select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
        ), l as (
            select r, doc_id, unnest(lines) as line, unnest(range(len(lines))) as i from d
        ), k as (
            select *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l
        ), repeated as (
            select key, max(coalesce(doc_id, -9223372036854775808)) as keep from k where length(key) >= 20
            group by key having count(distinct r) >= 3
        ), judged as (
            select k.*, repeated.key is not null and coalesce(doc_id, -9223372036854775808) <> keep as dropped
            from k left join repeated using (key)
        )
        select doc_id, count(*) as n_lines, count_if(dropped)::bigint as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by i) filter (not dropped), '')) as kept_sha256
        from judged group by r, doc_id
    """,
}
