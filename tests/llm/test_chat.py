"""Operator 3: Viterbi against all paths, held-out recovery of roles."""

import itertools
import random
import zlib

import numpy as np

from sparkledger.llm import chat


def conversations(spark, n=240):
    rng = random.Random(6)
    rows = []
    for c in range(n):
        for t in range(rng.randint(2, 6)):
            text = "\n".join(" ".join(rng.choice("what where this that house walk the of".split()) for _ in range(rng.randint(1, 9))) + rng.choice(".?") for _ in range(rng.randint(1, 3)))
            rows.append((c, t, ("user", "assistant")[t % 2], text))
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string").repartition(3)


def test_held_out_roles(spark):
    rows, df = conversations(spark)
    got = {r.conv_id: r for r in chat.formatted(df).collect()}
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((role, text))
    held = [c for c in want if zlib.crc32(str(c).encode()) % 3 == 1]
    right = [c for c in held if got[c].roles == ",".join(r for r, _ in want[c])]
    assert len(got) == len(want) and len(right) >= 0.9 * len(held)
    whole = [c for c in right if got[c].chat == "\n".join(f"<|im_start|>{r}\n{t}<|im_end|>" for r, t in want[c])]
    assert len(whole) >= 0.95 * len(right)


def test_viterbi_is_the_best_path(spark):
    _, df = conversations(spark, 60)
    model = chat.fit(chat.transcripts(df))
    lines = ["User: what", "this?", "", "the house."]
    seen = [model.emission(f) for f in chat.line_features(lines)]
    value = lambda p: model.start[p[0]] + sum(e[s] for e, s in zip(seen, p)) + sum(model.steps[a, b] for a, b in zip(p, p[1:]))
    best = max(itertools.product(range(len(chat.STATES)), repeat=len(lines)), key=value)
    assert np.isclose(value(model.viterbi(lines)), value(best))


def test_long_conversations_equal_the_undivided_path(spark):
    rng = random.Random(9)
    words = "what where this that house walk the of".split()
    rows = [(c, t, ("user", "assistant")[t % 2], "\n".join(" ".join(rng.choices(words, k=rng.randint(0, 7))) for _ in range(rng.randint(1, 3)))) for c, n in ((1, 1000), (2, 64), (3, 65), (5, 128)) for t in range(n)]
    # One turn number for all rows of a conversation: still parts of bounded size.
    rows += [(4, 7, "user", f"line {i}?") for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    parts = chat.transcripts(df).cache()
    assert parts.selectExpr("max(size(split(text, '\n')))").first()[0] <= 64 * 5
    model = chat.fit(parts)
    texts = {}
    for r in parts.orderBy("conv_id", "part").collect():
        texts.setdefault(r.conv_id, []).append(r.text)
    assert [len(texts[c]) for c in (1, 2, 3, 4, 5)] == [16, 1, 2, 4, 2]
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.parse_parts(parts, model, ["conv_id"]).collect()}
    assert got == {c: model.turns("\n".join(x)) for c, x in texts.items()}
    assert {r.conv_id: r.n_turns for r in chat.formatted(df).collect()} == {c: len(x) for c, x in got.items()}


def test_any_cut_of_a_transcript(spark):
    _, df = conversations(spark, 60)
    model = chat.fit(chat.transcripts(df))
    lines = "User: what\nthis?\n\nthe house.\n\n\n[user] walk the\nof that.\n### Human:\nwhere".split("\n")
    rng, rows = random.Random(2), []
    for c in range(40):
        cuts = sorted(rng.sample(range(1, len(lines)), c % len(lines)))
        rows += [(c if c else None, i, "\n".join(lines[a:b])) for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(lines)]))]
    got = chat.parse_parts(spark.createDataFrame(rows, "k long, part long, text string"), model, ["k"]).collect()
    assert len(got) == 40 and {tuple((t.role, t.text) for t in r.turns) for r in got} == {tuple(model.turns("\n".join(lines)))}


def test_odd_rows(spark):
    rows = [(1, 0, None, "hi"), (1, 0, None, "hi"), (1, None, "user", None), (None, 1, "assistant", ""), (None, 1, "assistant", ""), (None, 1, "user", "alone"), (2, 200, "user", "late"), (2, 0, "system", "x" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.formatted(df).collect()
    assert sorted(r.conv_id or 0 for r in got) == [0, 0, 1, 2]
    assert chat.formatted(df.limit(0)).count() == 0
