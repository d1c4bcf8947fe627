import random

import pytest

#: Extra columns whose names clash with columns that operators make or use.
CLASHING = ["id", "n_words", "pack_id", "bucket", "component_id", "shard", "kept", "host", "rule", "row", "size", "h"]


def make_texts(seed: int = 5, n: int = 60) -> list[str | None]:
    """Texts with copies, near copies, shared passages, repeats, odd characters, nulls and empties."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(150)]
    passage = " ".join(r.choice(vocab) for _ in range(40))
    out: list[str | None] = []
    for i in range(n):
        words = [r.choice(vocab) for _ in range(r.randint(1, 120))]
        kind = i % 10
        if kind == 0 and out:
            out.append(r.choice(out))
            continue
        if kind == 1 and out:
            base = (r.choice(out) or "x y z").split(" ")
            base[r.randrange(len(base))] = r.choice(vocab)
            out.append(" ".join(base))
            continue
        if kind == 2:
            words[len(words) // 2 : len(words) // 2] = passage.split(" ")
        if kind == 3:
            words = words[:6] * 5
        text = "".join(w + r.choice([" ", " ", "\n", "\t", "  "]) for w in words)
        out.append(text.title() if kind == 4 else text)
    return out + [None, "", "   \n ", "a", "a b", "A B", "é" * 30, "x" * 400, "x" * 300, "🙂 日本語 " * 20, "\x00 a", "#*$ |<>&% ! <|end|> \\l"]


def frame(spark, texts, ids=None):
    """documents with clashing extra columns."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or ""), *[k] * len(CLASHING)) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} long" for c in CLASHING)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts, with two rows more that repeat a row (same id and text)."""
    ids = list(range(len(texts)))
    return frame(spark, texts + texts[3:5], ids + ids[3:5]).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"
