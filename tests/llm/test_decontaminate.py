"""Operator 10 against a plain loop over all windows."""

import random
from collections import defaultdict

import pytest

from sparkledger.llm import decontaminate as dc

ITEM = "Anna buys 3 apples for 12 dollars and gives Bob 2 of them while Anna keeps the rest for tomorrow"


def frame(spark, rows, key="doc_id"):
    return spark.createDataFrame([(*r, 1) for r in rows], f"{key} long, text string, item int").repartition(2)


def test_reparameterised_questions(spark):
    items = [(1, ITEM), (2, "too short item here"), (3, None), (4, "")]
    docs = [
        (1, "pad pad. Carl buys 7 apples for 5 dollars and gives Dora 9 of them while Carl keeps the rest for tomorrow pad"),
        (2, "pad pad. Carl buys 7 apples for 5 dollars and gives Dora 9 of them while Dora keeps the rest for tomorrow pad"),  # one name for two
        (3, "and too short item here ."), (4, None), (5, ""), (6, "3 4 5 6 7 8 9 10 11 12 13 14"), (None, "x " + ITEM), (7, "x " * 30_000 + ITEM), (7, "x " * 30_000 + ITEM),
    ]
    got = {(r.doc_id, r.item_id) for r in dc.leaks(frame(spark, docs), frame(spark, items, "item_id")).collect()}
    assert got == {(1, 1), (3, 2), (None, 1), (7, 1)}


def plain(docs, items):
    """Same rules, written over Python lists."""
    def template(text):
        rows = []
        t = dc.Templates()
        word, kind, ids, _ = t.codes([text])
        for k, i in zip(kind, ids):
            rows.append((int(k), t.value(int(i))))
        return rows

    out = set()
    made = {i: template(t) for i, t in items}
    for d, text in docs:
        doc = template(text)
        for i, item in made.items():
            w = min(dc.WINDOW, len(item))
            if not w:
                continue
            shape = lambda x: [(k, v if k == dc.WORD else None) for k, v in x]
            lines = defaultdict(list)
            usable = [p for p in range(len(item) - w + 1) if sum(k == dc.WORD for k, _ in item[p:p + w]) >= min(dc.LEAST_WORDS, w)]
            for p in usable:
                for q in range(len(doc) - w + 1):
                    if shape(doc[q:q + w]) == shape(item[p:p + w]):
                        lines[q - p].append((p, q))
            for hits in lines.values():
                slots = {(item[p + x], doc[q + x]) for p, q in hits for x in range(w) if item[p + x][0] != dc.WORD}
                left = [a for a, _ in slots]
                names = [(a, b) for a, b in slots if a[0] == dc.NAME]
                if len(hits) >= min(dc.LEAST_WINDOWS, len(usable)) and len(set(left)) == len(slots) and len({a for a, _ in names}) == len({b for _, b in names}):
                    out.add((d, i))
    return out


@pytest.mark.parametrize("block", [2_000_000, 40])
def test_equals_plain_loop(spark, block):
    rng = random.Random(9)
    vocab = ["buys", "sells", "the", "of", "Anna", "Bob", "12", "7", "km", "5kg", "house.", "and", "red", "green", "to"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(3, 25)))) for i in range(12)]
    docs = []
    for d in range(60):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        if d % 2:
            text = rng.choice(items)[1].split()
            for x, w in enumerate(text):
                text[x] = {"Anna": rng.choice(["Carl", "Anna", "Bob"]), "12": rng.choice(["3", "12"])}.get(w, w)
            words[len(words) // 2:len(words) // 2] = text
        docs.append((d, " ".join(words)))
    from pyspark.sql import functions as F

    got = dc.contaminated(frame(spark, docs), frame(spark, items, "item_id"), block_hashes=block).select(F.col("dk"), F.col("item"))
    assert {tuple(r) for r in got.collect()} == plain(docs, items)


def test_verbatim_copies_of_dense_items(spark):
    items = [(1, "What is 2 + 2?"), (2, "Who wrote Hamlet?"), (3, "The Old Man And The Sea By Ernest Hemingway"), (4, "Compute 12 + 7 - 3 * 4 / 2 + 9"), (5, "a 5kg bag"),
             (6, "Sum up 1 2 3 4 5 6 7 8 9 10 11 12 and then tell us what the total of them is today"), (7, "42")]
    pad = "some words before it "
    docs = [(i, pad + text + " and some behind") for i, text in items]
    loose = ["What is 3 + 5?", "Who wrote Macbeth?", "The Old Cat And The Hat By Somebody Else", "Compute 12 + 7 - 3 * 4 * 2 + 9", "a 5lb bag", "Sum up 1 2 3 4 5 6 8 7 9 10", "43"]
    docs += [(100 + n, pad + text) for n, text in enumerate(loose)]
    got = {(r.doc_id, r.item_id) for r in dc.leaks(frame(spark, docs), frame(spark, items, "item_id")).collect()}
    assert got == {(i, i) for i, _ in items}


def test_one_verbatim_row_per_document_and_item(spark):
    got = dc.leaks(frame(spark, [(1, "7 8 9 " * 1000)]), frame(spark, [(1, "7 8 9 " * 20)], "item_id")).collect()
    assert [tuple(r) for r in got] == [(1, 1, 51, 0)]


def test_empty_tables(spark):
    docs, items = frame(spark, [(1, ITEM)]), frame(spark, [(1, ITEM)], "item_id")
    assert dc.leaks(docs.limit(0), items).count() == 0
    assert dc.leaks(docs, items.limit(0)).count() == 0
