"""Operator 10: benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question with other
values gives the same template.  Windows of WINDOW template tokens of the documents are hash-joined
with those of the benchmark; the slots of matching windows at one alignment must agree: equal
values of the benchmark stand for equal values of the document, and different names for different
names.  A document holds an item if at least LEAST_WINDOWS windows (or all
of a shorter item) match at one consistent alignment.

Templates of numbers and names alone would match loosely, so beside them every item is also looked for
verbatim: a document holds it too if it has a run of WINDOW + LEAST_WINDOWS - 1 tokens of it (all of a shorter
item) with the same values, whatever they are.  Only case and marks around a token do not count there.

The benchmark is a query set: its window hashes go to the tasks in blocks of at
most BLOCK_HASHES, one pass over the documents for each block, and only
documents' windows that match go on to the join.

A number is digits with marks of thousands and decimals; a unit is one of a list right behind a number; a name
is a capitalised word that starts no sentence.  Windows with fewer than LEAST_WORDS words that are no placeholder
have no template; their values decide.  Items of fewer than WINDOW tokens give one window of all of them, matched as
a run of that length.  Null and empty texts and items give no windows.  Rows that repeat a
doc_id or item_id are told apart by their text for matching and reported once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_steps, mix64
from .repeats import NO_DOC, _texts, sequence_hash

WINDOW = 8
LEAST_WINDOWS = 3
LEAST_WORDS = 5
#: Window hashes of the benchmark that one pass over the documents holds.
BLOCK_HASHES = 2_000_000
#: Tokens that a worker keeps the template of.
CACHE = 100_000

NUMBER = re.compile(r"[+-]?\d[\d.,]*(?<![.,])%?$|[+-]?\d%?$")
MEASURE = re.compile(r"([+-]?\d[\d.,]*)([a-z%$€£°]+)$")
#: Units, in lower case.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz pound pounds ton tons ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros usd eur gbp percent % $ € £ degree degrees ° mph kmh kph hz khz mhz ghz kb mb gb tb w kw mw v kv a ma j kj n pa kpa".split()
)
WORD, NUM, UNIT, NAME = 0, 1, 2, 3
MARKS = ".,;:!?\"'()[]{}<>«»„“”‘’…*_"


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class Templates:
    """Codes of raw tokens, kept from text to text inside a worker (up to CACHE tokens)."""

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.rows: list[tuple[int, int, bool, bool, str, str, int]] = []  # hash, kind, capital, ends a sentence, value, unit, hash of the whole
        self.tables: tuple | None = None
        #: Hash of each whole token of the last texts, and tokens per text.
        self.raw = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _add(self, token: str) -> int:
        core = token.strip(MARKS)
        low = core.lower()
        whole = low or token  # tokens of marks alone, as in 3 * 4, differ by them
        kind, unit = WORD, ""
        if NUMBER.match(low):
            kind = NUM
        elif m := MEASURE.match(low):
            if m[2] in UNITS:
                kind, low, unit = NUM, m[1], m[2]
        elif low in UNITS:
            kind = UNIT
        tail = token.rstrip("\"')]}»”’*_")
        n = self.at[token] = len(self.rows)
        # The hash of the word itself, the same in every worker.
        word = _hash(low)
        self.rows.append((word, kind, core[:1].isupper(), tail[-1:] in (".", "?", "!", ":"), low, unit, word if whole == low else _hash(whole)))
        return n

    def codes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each template token, its kind, its number in ``rows``, tokens per text)."""
        if len(self.rows) > CACHE:
            self._clear()
        ids, counts = [], []
        for text in texts:
            tokens = text.split() if text else ()
            got = list(map(self.at.get, tokens))
            if None in got:
                for i, t in enumerate(tokens):
                    if got[i] is None:
                        found = self.at.get(t)
                        got[i] = self._add(t) if found is None else found
            ids += got
            counts.append(len(got))
        ids, counts = np.array(ids, np.int64), np.array(counts, np.int64)
        done = len(self.tables[0]) if self.tables else 0
        if not self.tables or done != len(self.rows):
            more = self.rows[done:]
            new = (np.array([r[0] for r in more], np.uint64), np.array([r[1] for r in more], np.int8), np.array([r[2] for r in more], bool),
                   np.array([r[3] for r in more], bool), np.array([bool(r[5]) for r in more], bool), np.array([r[6] for r in more], np.uint64))
            self.tables = tuple(np.concatenate(x) for x in zip(self.tables, new, strict=True)) if self.tables else new
        word, kind, capital, ends, joined, whole = (t[ids] if len(ids) else t[:0] for t in self.tables)
        self.raw = whole, counts
        first = np.zeros(len(ids) + 1, bool)
        first[np.cumsum(counts) - counts] = True
        starts = first[:-1].copy()
        starts[1:] |= ends[:-1]
        kind = np.where((kind == WORD) & capital & ~starts, NAME, kind)
        # A unit is one right behind a number only; 5kg is a number and a unit.
        after = np.zeros(len(ids), bool)
        after[1:] = (kind[:-1] == NUM) & ~joined[:-1]
        kind = np.where((kind == UNIT) & (first[:-1] | ~after), WORD, kind)
        twice = 1 + joined.astype(np.int64)
        out_kind, out_id, out_word = np.repeat(kind, twice), np.repeat(ids, twice), np.repeat(word, twice)
        second = np.cumsum(twice)[joined] - 1
        out_kind[second] = UNIT
        out_word = np.where(out_kind == WORD, out_word, mix64(out_kind.astype(np.uint64) + np.uint64(77)))
        is_second = np.zeros(len(out_id), bool)
        is_second[second] = True
        text = np.repeat(np.arange(len(counts)), counts)
        totals = np.bincount(text, weights=twice, minlength=len(counts)).astype(np.int64) if len(ids) else counts
        return out_word, out_kind, np.where(is_second, -1 - out_id, out_id), totals

    def value(self, number: int) -> str:
        return self.rows[number][4] if number >= 0 else self.rows[-1 - number][5]


def windows(templates: Templates, texts: list[str | None], window: int, lengths: list[int]) -> Iterator[tuple[np.ndarray, ...]]:
    """For each length: (text number, position in it, hash, kinds, token numbers) of its windows;
    shorter lengths than ``window`` are those of short items."""
    word, kind, ids, counts = templates.codes(texts)
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    plain = np.concatenate([[0], np.cumsum(kind == WORD)])
    for n in lengths:
        h = sequence_hash(word, n) + np.uint64(n)
        at = np.arange(len(h))
        ok = (at + n <= (first + counts)[text[:len(h)]]) & (plain[n:] - plain[:-n] >= min(LEAST_WORDS, n)) if len(h) else np.zeros(0, bool)
        yield text[:len(h)][ok], at[ok] - first[text[:len(h)][ok]], h[ok], at[ok], n, kind, ids, counts


def runs(raw: tuple[np.ndarray, np.ndarray], lengths: list[int]) -> Iterator[tuple[np.ndarray, ...]]:
    """For each length: (text number, position in it, hash) of the runs of so many whole tokens."""
    whole, counts = raw
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    for n in lengths:
        h = sequence_hash(whole, n) + np.uint64(n)
        at = np.flatnonzero(np.arange(n, len(h) + n) <= (first + counts)[text[:len(h)]])
        yield text[at], at - first[text[at]], h[at]


SLOT = "array<struct<kind: int, value: string>>"
SLOT_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("value", pa.string())]))


def _slots(templates: Templates, at: np.ndarray, n: int, kind: np.ndarray, ids: np.ndarray) -> list[list[dict]]:
    return [[{"kind": int(kind[i]), "value": templates.value(int(ids[i]))} for i in range(a, a + n) if kind[i] != WORD] for a in at.tolist()]


def item_windows(benchmark: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text", run_length: int = 0) -> DataFrame:
    """(item, exact, hash, pos, n, total, slots): the template windows of every item, and with a ``run_length``
    its exact runs of so many tokens (all of a shorter item)."""
    names = ["item", "exact", "hash", "ipos", "n", "total", "islots"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for piece in arrow_steps(batches, "body"):
            texts = piece.column(2).to_pylist()
            counts = templates.codes(texts)[3]
            for n in range(1, window + 1):
                for text, pos, h, at, n, kind, ids, _ in windows(templates, texts, window, [n]):  # noqa: B020
                    mine = (counts[text] >= window) if n == window else (counts[text] == n)
                    text, pos, h, at = text[mine], pos[mine], h[mine], at[mine]
                    if len(text):
                        total = np.bincount(text, minlength=len(texts))[text]
                        yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(text)), pa.array(np.zeros(len(text), bool)), pa.array(h.view(np.int64)), pa.array(pos), pa.array(np.full(len(text), n, np.int32)), pa.array(total), pa.array(_slots(templates, at, n, kind, ids), SLOT_ARROW)], names=names)
            templates.codes(texts)
            raw = templates.raw
            lengths = np.minimum(raw[1], run_length)
            for n in np.unique(lengths[lengths > 0]).tolist():
                for text, pos, h in runs(raw, [n]):
                    mine = lengths[text] == n
                    text, pos, h = text[mine], pos[mine], h[mine]
                    # One run is enough.
                    yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(text)), pa.array(np.ones(len(text), bool)), pa.array(h.view(np.int64)), pa.array(pos), pa.array(np.full(len(text), n, np.int32)), pa.array(np.ones(len(text), np.int64)), pa.array([[]] * len(text), SLOT_ARROW)], names=names)

    src = _texts(benchmark, id_col, text_col)
    return src.dropDuplicates(["dk", "th"]).mapInArrow(run, f"item long, exact boolean, hash long, ipos long, n int, total long, islots {SLOT}")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least: int = LEAST_WINDOWS, id_col: str = "doc_id", text_col: str = "text", block_hashes: int = BLOCK_HASHES, verbatim: bool = False) -> DataFrame:
    """(dk, th, item, n_windows, first, n_slots): each document (by id and text hash) with each item it holds,
    the windows at the best alignment, the document's token there, and the slots filled.  With ``verbatim`` also
    items found by their values alone: the item's exact runs found, the first one's token, and no slots."""
    spark = docs.sparkSession
    items = item_windows(benchmark, window, run_length=window + least - 1 if verbatim else 0)
    keys = items.select("exact", "hash", "n").distinct()
    blocks = max(1, -(-keys.count() // block_hashes))
    texts = _texts(docs, id_col, text_col)
    hits = None
    for b in range(blocks):
        rows = keys.where(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == b).toPandas()  # about block_hashes rows
        known: tuple[dict[int, np.ndarray], ...] = {}, {}  # of templates, of exact runs
        for (exact, n), g in rows.groupby(["exact", "n"]):
            known[bool(exact)][int(n)] = np.sort(g["hash"].to_numpy(np.int64).view(np.uint64))
        shared = spark.sparkContext.broadcast(known)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            templates = Templates()
            shapes, values = shared.value
            among = lambda want, h: want[np.minimum(np.searchsorted(want, h), len(want) - 1)] == h
            names = ["dk", "th", "exact", "hash", "pos", "slots"]
            for piece in arrow_steps(batches, "body"):
                for text, pos, h, at, n, kind, ids, _ in windows(templates, piece.column(2).to_pylist(), window, sorted(shapes)):
                    hit = among(shapes[n], h)
                    text, pos, h, at = text[hit], pos[hit], h[hit], at[hit]
                    if len(text):
                        pick = pa.array(text)
                        yield pa.RecordBatch.from_arrays([piece.column(0).take(pick), piece.column(1).take(pick), pa.array(np.zeros(len(text), bool)), pa.array(h.view(np.int64)), pa.array(pos), pa.array(_slots(templates, at, n, kind, ids), SLOT_ARROW)], names=names)
                if not values:
                    continue
                if not shapes:
                    templates.codes(piece.column(2).to_pylist())
                lengths = sorted(values)
                for n, (text, pos, h) in zip(lengths, runs(templates.raw, lengths), strict=True):
                    hit = among(values[n], h)
                    text, pos, h = text[hit], pos[hit], h[hit]
                    if len(text):
                        # A run that a text repeats is reported once.
                        once = np.unique(np.rec.fromarrays([text, h]), return_index=True)[1]
                        text, pos, h = text[once], pos[once], h[once]
                        pick = pa.array(text)
                        yield pa.RecordBatch.from_arrays([piece.column(0).take(pick), piece.column(1).take(pick), pa.array(np.ones(len(text), bool)), pa.array(h.view(np.int64)), pa.array(pos), pa.array([[]] * len(text), SLOT_ARROW)], names=names)

        found = texts.mapInArrow(run, f"dk long, th long, exact boolean, hash long, pos long, slots {SLOT}")
        hits = found if hits is None else hits.unionAll(found)
    # Exact runs stand for themselves: no alignment, one of them is enough.
    pairs = hits.join(items, ["exact", "hash"]).withColumn("offset", F.when(~F.col("exact"), F.col("pos") - F.col("ipos")))
    pairs = pairs.withColumn("match", F.arrays_zip(F.col("islots.kind").alias("kind"), F.col("islots.value").alias("item_value"), F.col("slots.value").alias("doc_value")))
    # A document repeated whole gives its windows twice: they count once.
    lined = pairs.groupBy("dk", "th", "item", "exact", "offset").agg(
        F.countDistinct("ipos").alias("n_windows"), F.max("total").alias("total"), F.min("pos").alias("first"),
        F.array_distinct(F.flatten(F.collect_set("match"))).alias("match"))
    names = F.filter("match", lambda m: m["kind"] == NAME)
    distinct = lambda pairs, *c: F.size(F.array_distinct(F.transform(pairs, lambda m: F.struct(*(m[x] for x in c)))))
    agree = (distinct("match", "kind", "item_value") == F.size("match")) & (distinct(names, "doc_value") == distinct(names, "item_value"))
    held = lined.where((F.col("n_windows") >= F.least(F.lit(least), F.col("total"))) & agree)
    best = held.groupBy("dk", "th", "item").agg(F.max(F.struct((~F.col("exact")).alias("aligned"), "n_windows", (-F.col("first")).alias("back"), F.size("match").alias("n_slots"))).alias("m"))
    return best.select("dk", "th", "item", F.col("m.n_windows").alias("n_windows"), (-F.col("m.back")).alias("first"), F.col("m.n_slots").alias("n_slots"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The query: one row per document and item it holds."""
    real = lambda c: F.when(F.col(c) != NO_DOC, F.col(c))
    found = contaminated(docs, benchmark, verbatim=True).groupBy("dk", "item").agg(F.max(F.struct("n_windows", "n_slots")).alias("m"))
    return found.select(real("dk").alias("doc_id"), real("item").alias("item_id"), F.col("m.n_windows").cast("long").alias("n_windows"), F.col("m.n_slots").cast("long").alias("n_slots"))
