import random

import public_tokenizers as P
import pytest
import tiktoken

from tradewatch.llm.byte_bpe import SHORT, Codec, digest, encode, load_ranks

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strings(seed, n):
    r = random.Random(seed)
    for k in range(n):
        alphabet = [b"aab eth.\xc3\xa9nio", b" the anderinagontiou", bytes(range(256)), b"aaaa", b" \n\t"][k % 5]
        yield bytes(r.choice(alphabet) for _ in range(r.choice([1, 2, 5, 12, 40, 90]))), r


def test_encoding_equals_the_library(ranks, library):
    codec = Codec(ranks)
    for s, _ in strings(1, 1500):
        want = library._encode_single_piece(s)
        assert codec.encode(s) == want
        assert codec.encode_short(s) == want
        assert codec.decode(want) == s


def test_append_and_edit_equal_encoding_anew(ranks):
    codec = Codec(ranks)
    for s, r in strings(2, 400):
        last = codec.prefixes(s)
        i = r.randint(0, len(s))
        j = r.randint(i, len(s))
        new = bytes(r.choice(b"the ") for _ in range(r.randint(0, 4)))
        assert codec.append(s, last, new) == (s + new, codec.prefixes(s + new))
        joined, state, _ = codec.edit(s, last, i, j, new)
        assert state == codec.prefixes(joined)


def test_an_edit_computes_few_prefixes(ranks):
    codec = Codec({t: i for t, i in ranks.items() if len(t) <= 12})
    s = b" the quick brown fox" * 200
    _, _, work = codec.edit(s, codec.prefixes(s), 100, 101, b"x")
    assert work < 200


def test_documents(docs, texts, library):
    import hashlib

    rows = digest(docs, PATH, P.PATTERN).collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha((texts[r.doc_id] or "").encode())
    for r in encode(docs, PATH, P.PATTERN, keep=("doc_id", "id", "size")).collect():
        assert list(r.ids) == library.encode_ordinary(texts[r.doc_id] or "")
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()


def test_long_match_and_nulls(spark, library):
    text = "a" * 5000 + " " * 3000 + "word" * (SHORT + 1)
    df = spark.createDataFrame([(None, text), (1, None)], "doc_id long, text string")
    out = {r.doc_id: list(r.ids) for r in encode(df, PATH, P.PATTERN).collect()}
    assert out == {None: library.encode_ordinary(text), 1: []}


def test_empty_table(no_docs):
    assert digest(no_docs, PATH, P.PATTERN).count() == 0
