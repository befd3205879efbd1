import math

from tidewire.llm import toxicity

from . import cases

WORDS = [f"bad{c}" for c in "abcdefgh"]
MODEL = toxicity.Model({w: 2.5 for w in WORDS}, scale=1.0, intercept=-2.0, slope=1.0)
PASSAGE = " ".join(WORDS)


def scored(spark, *texts):
    rows = toxicity.score(cases.documents(spark, [(i, t, "a") for i, t in enumerate(texts)]), MODEL).collect()
    return [(r["passages"], r["predicted"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_a_passage_counts_after_many_single_uses_of_its_words(spark):
    single = " ".join(f"{w} {'fine ' * 40}" for _ in range(20) for w in WORDS)
    assert 8 * 2.5 > math.log(len(f"{single} {PASSAGE}".split()))
    close = " ".join(f"bada {'fine ' * 6}" for _ in range(200)) + "fine " * 40
    assert scored(spark, single, f"{single} {PASSAGE}", f"{close} {PASSAGE}") == [(0, 0), (1, 1), (1, 1)]


def test_a_passage_repeated_through_a_text_counts_each_time(spark):
    gap = "fine " * 300
    assert scored(spark, gap.join([PASSAGE] * 5)) == [(5, 1)]


def test_one_word_repeated_is_no_passage(spark):
    assert scored(spark, "bada fine fine " * 200) == [(0, 0)]
