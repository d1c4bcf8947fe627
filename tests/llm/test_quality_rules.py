import re
from collections import Counter

from pyspark.sql import functions as F

from tradewatch.llm import quality_rules as q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)


def test_measures_match_brute_force(spark, docs, texts):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, len(texts), 2)], "doc_id long, quality int, toxic int")
    out = q.judge(docs, labels).collect()
    assert len(out) == docs.count()
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert r.kept is False or not r.base_failed


def test_no_python_on_the_main_path(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    plan = q.judge(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_tables_and_null_labels(spark, no_docs, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert q.judge(no_docs, none).count() == 0
    nulls = spark.createDataFrame([(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    assert q.learn(docs, nulls) == []


def test_learns_a_planted_conjunction(spark):
    """Bad: many symbols and long lines; either alone is good."""
    rows, marks = [], []
    for i in range(900):
        noisy, wide = i % 2, (i // 2) % 2
        words = [f"word{i}x{k}" + ("###" if noisy else "") for k in range(40)]
        text = "".join(w + ("\n" if not wide and k % 4 == 3 else " ") for k, w in enumerate(words))
        rows.append((i, text))
        marks.append((i, 0 if noisy and wide else 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    assert q.learn(docs, labels)
    out = q.judge(docs, labels).join(labels, "doc_id").select((F.col("kept") == (F.col("quality") == 1)).alias("ok")).collect()
    assert sum(r.ok for r in out) >= 0.99 * len(out)


def test_the_fit_measures_the_labelled_rows_only(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    real, read = q.measures, []

    def measures(rows, *more, **named):
        read.append((rows.inputFiles(), rows.count()))
        return real(rows, *more, **named)

    monkeypatch.setattr(q, "measures", measures)
    q.learn(docs, labels, max_labelled=50)
    assert [n for _, n in read] == [50] and all("labelled-sample" in f for f in read[0][0])


def test_held_out_accuracy_on_test_data(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    seen = labels.filter("doc_id % 3 != 0")
    out = q.judge(docs, seen).join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in out) > 0.9 * len(out)


def test_cover_prunes_and_stops():
    bins = [("n_words", [10, 20]), ("mark_share", [5])]
    cells = [(fold, (a, b), 50 if a == 2 and b else 0, 0 if a == 2 and b else 50) for fold in (False, True) for a in range(3) for b in range(2)]
    rules = q.cover(cells, bins)
    assert len(rules) == 1
    assert {str(c) for c in rules[0].conditions} == {"n_words > 20", "mark_share > 5"}
