import importlib
import re

import pytest
from conftest_llm import frame
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def cp():
    return importlib.import_module("corpus_pipeline")


def test_stages_chain_and_keep_the_columns(spark, cp):
    from tradewatch.session import scratch_path

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    results = {}
    for name, stage in cp.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        if name != cp.STAGES[-1][0]:
            assert out.columns == columns
        results[name] = (docs, out)
        sizes.append(out.count())
        docs = out
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.6 * sizes[0]
    # near duplicates: of each group that the input's links make, the smallest id stays
    before, after = results["ngram_jaccard_join"]
    texts = {r.doc_id: r.text for r in before.collect()}
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t.lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    ids = sorted(sets)
    lead = {i: i for i in ids}
    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = lead[a], lead[b]
                for k in ids:
                    if lead[k] == max(x, y):
                        lead[k] = min(x, y)
    assert {r.doc_id for r in after.collect()} == {i for i in ids if lead[i] == i}
    # decontamination: no item is left, clean documents stay
    before, after = results["benchmark_decontamination"]
    norm = lambda t: f" {' '.join(re.findall(r'[0-9a-z\x80-\U0010ffff]+', t.lower()))} "
    items = [norm(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect() if not any(x in norm(r.text) for x in items)}
    # encoding: the ids decode to the text
    before, after = results["byte_level_bpe"]
    want = {r.doc_id: r.h for r in before.select("doc_id", F.sha2("text", 256).alias("h")).collect()}
    assert {r.doc_id: r.decoded_sha256 for r in after.collect()} == want
    assert {r.doc_id for r in cp.run(spark, SF).select("doc_id").collect()} == set(want)


def test_odd_rows(spark, cp, docs, no_docs):
    """Nulls, empties, repeats and clashing columns pass every stage without a crash."""
    odd = docs.select("doc_id", "text", "lang", "source", "n_chars", "n_words", "row", "id").unionByName(
        spark.createDataFrame([(None, "some text here " * 10, None, None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long, n_words long, row long, id long")
    )
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns
        assert stage(spark, odd, SF).count() <= odd.count()
        assert stage(spark, no_docs, SF).count() == 0
    assert cp.STAGES[-1][1](spark, odd, SF).count() == odd.count()


def test_rows_without_an_id_are_cut_and_decontaminated(spark, cp):
    passage = " ".join(f"passage{i}" for i in range(60))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 100").first().text
    docs = frame(spark, [f"a start {passage} an end", f"other words {passage} more words", f"x {item} y", "clean text of its own", f"z {item}"], [1, None, None, None, 4])
    cut = [r.text for r in cp.repeated_text(spark, docs, SF).collect() if r.doc_id is None]
    assert len(cut) == 3 and not any("passage30" in t for t in cut)
    assert sorted(r.text for r in cp.decontaminate(spark, docs, SF).collect()) == sorted([f"a start {passage} an end", f"other words {passage} more words", "clean text of its own"])


def test_repeated_text_is_cut_once(spark, cp):
    passage = " ".join(f"passage{i}" for i in range(60))
    docs = frame(spark, [f"a start {passage} an end", f"other words {passage} more words", passage], [1, 2, 3])
    out = {r.doc_id: r.text for r in cp.repeated_text(spark, docs, SF).collect()}
    assert out[1] == f"a start {passage} an end"
    assert "passage30" not in out[2] and out[2].startswith("other words") and out[2].endswith("more words")
    assert 3 not in out


def test_rows_without_or_with_equal_ids_stay_if_their_text_is_clean(spark, cp):
    text = lambda k: " ".join(f"word{k}x{i}" for i in range(40))
    near = text(2).replace("word2x39", "other")
    rows = [(None, text(0)), (None, text(1)), (None, text(2)), (5, near), (5, text(3)), (5, text(3)), (5, text(4)), (6, text(4)), (None, text(4)), (7, None), (8, " "), (None, "")]
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    out = cp.near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    want = [(None, text(0)), (None, text(1)), (5, near), (5, text(3)), (5, text(4)), (7, None), (8, " "), (None, "")]
    assert sorted(map(str, [(r.doc_id, r.text) for r in out.collect()])) == sorted(map(str, want))
