"""Operator 9: repeated passages by prefix-partitioned suffix trees over words.

A window is WINDOW consecutive words; it is repeated if its word sequence starts
anywhere else too.  Suffixes are the positions at which windows start.

1. Every suffix gets a prefix of variable length that ends with the least
   GRAM-gram (by hash) of its window.  Equal windows have equal prefixes, so
   suffixes whose closing gram is alone in the corpus are leaves at the top and
   leave here; about one gram in twelve is a closing one, and only those are counted.
2. The suffixes that stay are dealt by the closing gram.  Groups larger than
   the mean task (their number is below the number of partitions) take the
   whole window as prefix instead, so no group outgrows a task.
3. A task reads its groups in order and holds each subtree as the sorted list
   of its suffixes cut at depth WINDOW: runs of equal entries are the internal
   nodes of that depth, and suffixes below them, joined where they overlap, are
   the maximal repeats.

Copies inside a task are found before the shuffles and one of them stands for
all of them there, so rows of a group of copies do not meet in one task.  Rows alike in
id and text are one row with a count before anything else: all their windows are repeated.

Null and empty texts have no words.  Rows that repeat a doc_id are documents of
their own, told apart by their text; a row that repeats another one whole is
another place where its windows start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_steps, mix64, ragged, written
from .pretokens import piece_keys, utf8_column

WINDOW = 35
GRAM = 12
#: Closing grams a task gathers before it looks for copies among them.
FLUSH = 500_000
#: Rows that a group has at least before it takes the whole window as prefix.
LEAST_HOT = 1000
#: Bytes of suffix groups that a task sorts at a time; a larger group is sorted whole.
CHUNK = 4_000_000

_rng = np.random.default_rng(20)
MULTIPLIERS = _rng.integers(0, 1 << 63, (2, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
NO_DOC = -(1 << 63)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word in bytes, and words per text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)  # a text starts here
    edge[offsets[:-1]] = True
    edge[-1] = True
    start = np.flatnonzero(word & (np.concatenate([[True], ~word[:-1]]) | edge[:-1]))
    end = np.flatnonzero(word & (np.concatenate([~word[1:], [True]]) | edge[1:])) + 1
    return start, end, np.diff(np.searchsorted(start, offsets))


def sequence_hash(words: np.ndarray, length: int, row: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` word hashes."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out += words[j:j + n] * MULTIPLIERS[row, j]
    return mix64(out)


def closing_grams(words: np.ndarray, counts: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text number, first window, windows, gram position, gram hash) of each run of
    windows with one closing gram; positions count the words of all texts."""
    per = window - gram + 1
    grams = sequence_hash(words, gram)
    first = np.cumsum(counts) - counts
    if len(grams) < per or not (counts >= window).any():
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    # Ordered by the upper bits of the hash, ties to the left.
    bits = np.uint64(max(1, int(len(grams)).bit_length()))
    key = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    low, width = key, 1
    while width * 2 <= per:
        low, width = np.minimum(low[:-width], low[width:]), width * 2
    if width < per:
        low = np.minimum(low[:len(low) - (per - width)], low[per - width:])
    at = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(counts)), counts)[:len(at)]
    ok = np.arange(len(at)) + window <= (first + counts)[text]
    new = np.empty(len(at), bool)
    new[0] = True
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    runs = np.flatnonzero(new & ok)
    run_of = np.cumsum(new & ok)[ok] - 1
    size = np.bincount(run_of, minlength=len(runs))
    return text[runs], runs, size, at[runs], grams[at[runs]]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    body = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_DOC)).alias("dk"), F.xxhash64(body).alias("th"), body.alias("body"))


def _first_copies(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is one of several with its key, is the first of its key)."""
    uniq, first, inverse, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    lead = np.zeros(len(key), bool)
    lead[first] = True
    return n[inverse] > 1, lead


def _grams(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            h, dk, th, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            several, lead = _first_copies(h)
            uniq, n = np.unique(h[several], return_counts=True)
            # Copies in this task are known; they are spread by their place, and one row without a place stands for them.
            place = mix64(dk.view(np.uint64) ^ mix64(th.view(np.uint64) + pos.astype(np.uint64)))
            g = np.concatenate([np.where(several, place, h), uniq]).view(np.int64)
            empty = np.zeros(len(uniq), np.int64)
            cols = [pa.array(g), pa.array(np.concatenate([h, uniq]).view(np.int64)), pa.array(np.concatenate([dk, empty])), pa.array(np.concatenate([th, empty])),
                    pa.array(np.concatenate([pos, empty - 1])), pa.array(np.concatenate([several, np.zeros(len(uniq), bool)])), pa.array(np.concatenate([np.ones(len(h), np.int64), n]))]
            return pa.RecordBatch.from_arrays(cols, names=["g", "h", "dk", "th", "pos", "known", "n"])

        size = 0
        for piece in arrow_steps(batches, "body"):
            data, offsets = utf8_column(piece.column(2))
            start, end, counts = words_of(data, offsets)
            words, _ = piece_keys(data, start, end - start)
            text, _, _, at, h = closing_grams(words, counts, window, gram)
            if len(h):
                dk, th = (np.asarray(piece.column(i)) for i in (0, 1))
                held.append((h, dk[text], th[text], at - (np.cumsum(counts) - counts)[text]))
                size += len(h)
            if size >= FLUSH:
                yield flush()
                size = 0
        if held:
            yield flush()

    return run


def _suffixes(window: int, gram: int, hot: np.ndarray):
    """Rows of the suffixes to be dealt out: runs of windows that share a closing gram that is not alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            g, dk, th, at, size, content = (np.concatenate([x[i] for x in held]) for i in range(6))
            texts = [t for x in held for t in x[6]]
            held.clear()
            several, lead = _first_copies(mix64(g ^ mix64(content + size.astype(np.uint64))))
            place = mix64(dk.view(np.uint64) ^ mix64(th.view(np.uint64) + at.astype(np.uint64)))
            reps = np.flatnonzero(several & lead)
            cols = [
                pa.array(np.concatenate([np.where(several, place, g), g[reps]]).view(np.int64)),
                pa.array(np.concatenate([dk, dk[reps]])), pa.array(np.concatenate([th, th[reps]])),
                pa.array(np.concatenate([at, np.full(len(reps), -1)])), pa.array(np.concatenate([size, size[reps]])),
                pa.array([None if s else t for s, t in zip(several.tolist(), texts, strict=True)] + [texts[i] for i in reps], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(cols, names=["g", "dk", "th", "at", "size", "words"])

        total = 0
        for piece in arrow_steps(batches, "body"):
            data, offsets = utf8_column(piece.column(2))
            start, end, counts = words_of(data, offsets)
            words, check = piece_keys(data, start, end - start)
            text, s, size, at, h = closing_grams(words, counts, window, gram)
            if not len(h):
                continue
            first = np.cumsum(counts) - counts
            # Keep the runs whose closing gram stands in the list of the document.
            wanted = piece.column(3)
            w_off = np.asarray(wanted.offsets)
            w_text = np.repeat(np.arange(len(wanted)), np.diff(w_off))
            w_pos = np.asarray(wanted.flatten()) + first[w_text]
            keep = np.isin(at, w_pos)
            text, s, size, h = text[keep], s[keep], size[keep], h[keep]
            big = np.isin(h, hot)
            if big.any():  # one row for each window, dealt by the whole of it
                one = ragged(s[big], size[big])
                whole = sequence_hash(words, window)
                text = np.concatenate([text[~big], np.repeat(text[big], size[big])])
                g = np.concatenate([h[~big], mix64(whole[one] + np.uint64(1))])
                s, size = np.concatenate([s[~big], one]), np.concatenate([size[~big], np.ones(len(one), np.int64)])
            else:
                g = h
            if not len(s):
                continue
            span = size + window - 1
            ids = ragged(s, span)
            content = np.add.reduceat(mix64(check[ids] + (np.arange(len(ids)) - np.repeat(np.cumsum(span) - span, span)).astype(np.uint64)), np.cumsum(span) - span)
            raw = data.tobytes()
            cells = [raw[a:b] for a, b in zip(start[s].tolist(), end[s + span - 1].tolist(), strict=True)]
            dk, th = (np.asarray(piece.column(i)) for i in (0, 1))
            held.append((g, dk[text], th[text], s - first[text], size, content, cells))
            total += sum(map(len, cells))
            if total >= 4 * CHUNK:
                yield flush()
                total = 0
        if held:
            yield flush()

    return run


def _subtrees(window: int):
    """Reads rows sorted by group; returns spans [a, b) of words below nodes of depth ``window``."""

    def nodes(rows: list[tuple]) -> pa.RecordBatch:
        g, dk, th, at, size, texts = (list(x) for x in zip(*rows, strict=True))
        g, dk, th, at, size = (np.array(x, np.int64) for x in (g, dk, th, at, size))
        known = np.array([t is None for t in texts])
        lens = np.array([len(t) for t in texts if t is not None], np.int64)
        data = np.frombuffer(b"".join(t for t in texts if t is not None), np.uint8)
        start, end, counts = words_of(data, np.concatenate([[0], np.cumsum(lens)]).astype(np.int64))
        words, check = piece_keys(data, start, end - start)
        own = np.flatnonzero(~known)
        suffix = ragged(np.cumsum(counts) - counts, counts - window + 1)
        row = np.repeat(own, counts - window + 1)
        a, b = (np.zeros(0, np.uint64),) * 2
        if len(suffix):
            a, b = sequence_hash(words, window)[suffix], sequence_hash(check, window, 1)[suffix]
        # The sorted suffixes of every group; runs of equal ones are the deep nodes.
        order = np.lexsort((b, a, g[row]))
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1]) & (g[row][order][1:] == g[row][order][:-1])
        deep = np.zeros(len(order), bool)
        deep[order] = same[1:] | same[:-1]
        place = ragged(np.zeros(len(own), np.int64), counts - window + 1)
        row, place = row[deep], place[deep]
        row, place = row[at[row] >= 0], place[at[row] >= 0]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], len(row)) - 1 if len(lo) else lo
        k = np.flatnonzero(known)
        r = np.concatenate([row[lo], k]).astype(np.int64)
        first = np.concatenate([at[row[lo]] + place[lo], at[k]])
        last = np.concatenate([at[row[lo]] + place[hi] + window, at[k] + size[k] + window - 1])
        return pa.RecordBatch.from_arrays([pa.array(dk[r]), pa.array(th[r]), pa.array(first), pa.array(last)], names=["dk", "th", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        total = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if total >= CHUNK and row[0] != held[-1][0]:
                    yield nodes(held)
                    held, total = [], 0
                held.append(row)
                total += 64 + len(row[5] or b"")
        if held:
            yield nodes(held)

    return run


def maximal_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(dk, th, body, spans, several): every text with the word spans that lie in repeated windows.

    ``dk`` is the document's id and ``th`` the hash of its text; spans may
    overlap, their union is what is repeated.  ``several``: the row repeats another one
    in id and text, so every window of it is repeated and its spans are not listed.
    """
    spark = docs.sparkSession
    texts, key = _texts(docs, id_col, text_col), ["dk", "th"]
    # Written, so that its size is known where it is joined; most tables have no such rows.
    copies = written(texts.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key), "copies")
    alone = texts.join(copies, key, "left_anti")
    many = texts.join(copies, key, "left_semi")
    # One row stands for all that are alike, for the sake of the others' windows.
    once = alone.unionAll(many.groupBy(*key).agg(F.first("body").alias("body")))
    schema = "g long, h long, dk long, th long, pos long, known boolean, n long"
    counted = once.mapInArrow(_grams(window, gram), schema)
    counted = counted.withColumn("total", F.sum("n").over(Window.partitionBy("g")))
    counted = written(counted.where("known or total > 1").drop("g", "n"), "grams")
    # Groups above the mean of a task: fewer than there are partitions.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = counted.where("not known").groupBy("h").agg(F.max("total").alias("n"))
    mean = max(LEAST_HOT, (counted.where("pos >= 0").count()) // tasks)
    hot = np.array([r.h for r in sizes.where(F.col("n") > mean).select("h").collect()], np.int64).view(np.uint64)
    places = counted.where("pos >= 0").groupBy("dk", "th").agg(F.collect_list("pos").alias("places"))
    dealt = once.join(places, key).select("dk", "th", "body", "places").mapInArrow(
        _suffixes(window, gram, hot), "g long, dk long, th long, at long, size long, words binary")
    spans = dealt.repartition("g").sortWithinPartitions("g").mapInArrow(_subtrees(window), "dk long, th long, a long, b long")
    spans = spans.groupBy("dk", "th").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    none = F.lit(None).cast(spans.schema["spans"].dataType)
    return alone.join(spans, key, "left").withColumn("several", F.lit(False)).unionByName(many.withColumns({"spans": none, "several": F.lit(True)}))


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): texts without the words of repeated windows, joined by blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrow_steps(batches, "body"):
            data, offsets = utf8_column(piece.column(1))
            start, end, counts = words_of(data, offsets)
            first = np.cumsum(counts) - counts
            delta = np.zeros(len(start) + 1, np.int64)
            spans = piece.column(2)
            if len(flat := spans.flatten()):
                text = np.repeat(np.arange(len(spans)), np.asarray(spans.value_lengths().fill_null(0)))
                np.add.at(delta, np.asarray(flat.field(0)) + first[text], 1)
                np.add.at(delta, np.asarray(flat.field(1)) + first[text], -1)
            whole = piece.column(3).to_numpy(zero_copy_only=False) & (counts >= window)
            keep = (np.cumsum(delta[:-1]) == 0) & ~np.repeat(whole, counts)
            kept = np.bincount(np.repeat(np.arange(len(counts)), counts)[keep], minlength=len(counts))
            # Each kept word and a blank behind it; the last blank of a text goes.
            out = np.append(data, np.uint8(32))[_with_blank(start[keep], end[keep], len(data))]
            size = (end - start + 1)[keep]
            ends = np.cumsum(np.concatenate([[0], size]))[np.cumsum(kept)]
            raw, cells, a = out.tobytes(), [], 0
            for b in ends.tolist():
                cells.append(raw[a:max(a, b - 1)].decode())
                a = b
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(counts), pa.array(counts - kept), pa.array(cells, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    rows = maximal_repeats(docs, window, min(GRAM, window), id_col, text_col)
    rows = rows.select(F.when(F.col("dk") != NO_DOC, F.col("dk")).alias("doc_id"), "body", "spans", "several")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def _with_blank(start: np.ndarray, end: np.ndarray, blank: int) -> np.ndarray:
    """Byte positions of the words, each followed by that of a blank."""
    size = end - start + 1
    at = ragged(start, size)
    at[np.cumsum(size) - 1] = blank
    return at


def repeat_digests(docs: DataFrame) -> DataFrame:
    """The query: one row per document with the digest of the kept words."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
