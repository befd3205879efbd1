import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewire.llm import rules
from tidewire.llm.queries import op4_decision_list_quality, table

from . import cases


def expected(text):
    text = text or ""
    words = cases.words(text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    uses = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if uses[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_awkward_statistics(spark):
    texts = [t for _, t, _ in cases.rows()] + ["a a a a", "a b a b a b", "a b c d a b c", "# # # |"]
    rows = rules.statistics(cases.documents(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()
    assert {r["doc_id"]: tuple(r[f] for f in FIELDS) for r in rows} == {i: expected(t) for i, t in enumerate(texts)}
    assert rules.statistics(cases.no_documents(spark)).count() == 0


def test_whole_table_and_verdicts(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    rows = op4_decision_list_quality(spark, sf).collect()
    assert {r["doc_id"]: tuple(r[f] for f in FIELDS) for r in rows} == {i: expected(t) for i, t in texts.items()}
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    judged = [(labels[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(q == k for q, k in judged) >= 0.97 * len(judged)


def test_rules_are_conditional_expressions(spark):
    data = [(i, float(i % 20), float(i % 7), 0 if i % 20 > 14 and i % 7 > 2 else 1) for i in range(6000)]
    stats = spark.createDataFrame(data, "doc_id long, n_words double, mean_word double, quality int")
    stats = stats.withColumns({s: F.lit(0.0) for s in rules.STATISTICS if s not in stats.columns} | {"base_failed": F.lit(False)})
    learned = rules.learn(stats, stats.select("doc_id", "quality"))
    assert 1 <= len(learned) <= 4
    judged = stats.select("quality", rules.verdict(learned).alias("kept"), *rules.STATISTICS)
    assert judged.filter("(quality = 1) <> kept").count() == 0
    frame = judged.toPandas()
    again = duckdb.sql(f"select kept, {rules.as_sql(learned)} as said from frame").fetchall()
    assert all(a == b for a, b in again)


@pytest.mark.parametrize("given", [[], [(1, 1)], [(None, 0), (2, 9)]])
def test_without_usable_labels_only_base_rules_hold(spark, given):
    labels = spark.createDataFrame(given, "doc_id long, quality int")
    rows = rules.judge(cases.documents(spark), labels).collect()
    assert len(rows) == len(cases.rows()) and all(r["kept"] != r["base_failed"] for r in rows)


def test_native(spark):
    plan = rules.statistics(cases.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
