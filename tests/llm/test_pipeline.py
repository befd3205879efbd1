import struct
import zlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tidewire.llm import packing, pii, simhash, toxicity
from tidewire.llm.queries import table

from . import cases
from .test_mixing import targets
from .test_pii import expected
from .test_simhash import components, slow_print

SF = "/root/testdata/sf0.001"


def test_stages_on_the_table(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, [docs]
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, seen[-1], SF).write.parquet(str(tmp_path / str(k)))
        seen.append(spark.read.parquet(str(tmp_path / str(k))))
    raw, clean, single, masked, mixed = ([tuple(r) for r in d.select("doc_id", "text", "source").collect()] for d in seen[:-1])
    assert all(d.columns == columns for d in seen[:-1])

    model = toxicity.train(docs, table(spark, SF, "labels"))
    verdicts = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert sorted(clean) == sorted(r for r in raw if not verdicts[r[0]])

    prints = {i: slow_print(t) for i, t, _ in clean}
    root = components(set(prints.values()), simhash.DISTANCE)
    first = {}
    for i, p in prints.items():
        first[root[p]] = min(i, first.get(root[p], i))
    assert sorted(i for i, _, _ in single) == sorted(first.values())

    spans = {r["doc_id"]: r["spans"] for r in pii.find(seen[2]).collect()}
    before = {i: t for i, t, _ in single}
    for i, text, _ in masked:
        assert (text == before[i]) == (spans[i] == "") and not expected(text)[1]

    sizes = {}
    for _, t, s in masked:
        sizes[s] = sizes.get(s, 0) + len(cases.words(t))
    wanted, got = targets(sizes), {}
    for _, t, s in mixed:
        got[s] = got.get(s, 0) + len(cases.words(t))
    assert all(abs(got.get(s, 0) - wanted[s]) <= 64 for s in sizes)
    original = {i: t for i, t, _ in masked}
    assert all(set(cases.words(t)) <= set(cases.words(original[i])) for i, t, _ in mixed)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = []
    for _, t, _ in mixed:
        ids, start = [*tokenizer.encode(t, add_special_tokens=False).ids, 1], 0
        for n in packing.piece_lengths(len(ids)):
            pieces.append(zlib.crc32(struct.pack(f"<{n}I", *ids[start : start + n])))
            start += n
    assert sorted(r["ids_crc32"] for r in seen[-1].collect()) == sorted(pieces)


def test_awkward_documents_pass_every_stage(spark, tmp_path):
    for name, docs in (("some", cases.documents(spark)), ("none", cases.no_documents(spark))):
        for k, (_, function) in enumerate(corpus_pipeline.STAGES):
            columns = docs.columns
            function(spark, docs, SF).write.parquet(str(tmp_path / name / str(k)))
            docs = spark.read.parquet(str(tmp_path / name / str(k)))
            assert k == 4 or docs.columns == columns
        assert (docs.count() > 0) == (name == "some")


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_workers_get_batches_of_bounded_bytes(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = cases.documents(spark, [(i, "word " * 20_000, "a") for i in range(200)]).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield batch.from_pydict({"bytes": [batch.nbytes]})

    try:
        for size, most in (("64m", corpus_pipeline.BATCH_BYTES), ("1m", 1 << 20)):
            spark.conf.set(setting, size)
            corpus_pipeline.STAGES[-1][1](spark, docs, SF)
            seen = [r["bytes"] for r in docs.select("text").mapInArrow(sizes, "bytes long").collect()]
            assert len(seen) > 1 and max(seen) <= most + 110_000
    finally:
        spark.conf.unset(setting)
