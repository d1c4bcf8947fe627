import hashlib
import random

from tradewatch.llm.chat_format import END, TEXT, TURN, digests, examples

PIECES = ["", "hi", "\\", "\\l", "\\b", "<", "<|end|>", "<|turn|>assistant<|text|>", "é🙂", "\n", "### Assistant: </turn>", "\\\\l<", None]


def conversations(spark, n=25):
    r = random.Random(4)
    rows = []
    for c in range(n):
        for t in range(r.randint(1, 9)):
            text = r.choice(PIECES)
            rows.append((c if c else None, t if r.random() < 0.95 else None, r.choice(["user", "assistant", "system", None, "a<b\\"]), None if text is None else text + (r.choice(PIECES) or ""), "x", 1))
    rows += rows[:3]
    r.shuffle(rows)
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, example int")


def brute(rows):
    by = {}
    for c, t, role, text, *_ in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    esc = lambda s: s.replace("\\", "\\b").replace("<", "\\l")
    out = {}
    for c, turns in by.items():
        turns = [(role, text) for _, _, role, text in sorted(turns)]
        marked = [TURN + esc(role) + TEXT + esc(text) + END for role, text in turns]
        at = [k for k, (role, _) in enumerate(turns) if role == "assistant" or k == len(turns) - 1]
        loss = "".join(text for role, text in turns if role == "assistant")
        listing = "".join(f"{role}\n{text}\n" for role, text in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha(listing), len(loss), sha(loss), sum(len("".join(marked[: k + 1])) for k in at))
    return out


def test_matches_brute_force(spark):
    rows, df = conversations(spark)
    ex = examples(df)
    got = {r.conv_id: tuple(r)[1:] for r in digests(ex).collect()}
    assert got == brute(rows)
    for r in ex.collect():
        # the mask lies inside one turn and holds no control string
        inside = r.formatted[r.loss_start : r.loss_start + r.loss_length]
        assert "<" not in inside
        assert r.formatted[: r.loss_start].endswith(TEXT)


def test_native(spark):
    _, df = conversations(spark, 3)
    plan = digests(examples(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert digests(examples(df)).count() == 0
