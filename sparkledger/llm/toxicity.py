"""Operator 2: toxicity by noisy-channel restoration, then scoring.

Restoration.  Spans that look disguised (letters mixed with digits or symbols,
runs of one letter, single letters set apart) become lattices of characters:
a symbol may stand for the letters it resembles, a letter of a run of three or
more or a separator may be an insertion, a separator may be a word boundary.  Viterbi
decoding over the last two characters finds the most likely text under a
trigram character language model counted from the words of all documents.

Scoring.  The training documents that hold a word, or a prefix of it, give the
share of toxic ones among them; along the chain from the shortest prefix to the
word each share is smoothed towards that of the rest of its parent, so that a
common word that merely begins like a toxic one stays clean and an unseen ending
of a toxic stem does not.  A word whose share is high multiplies the odds of its
document, less so in long documents, which hold any word more often by chance.
The odds start from the share of toxic rows, a tenth of it without such a word.

Null and empty texts hold no word.  Repeated rows are scored alike.
Labels are taken as toxic if any row of a doc_id says so; null labels are left
out.  Without toxic training rows there is no feature and
every score is 0.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_steps, spread_sample, written

#: Labelled rows that the classifier is fitted on, at most.
TRAIN_ROWS = 30_000
THRESHOLD = 0.7
#: Toxic documents and their share that a word or prefix needs to count at all.
LEAST_DOCS, LEAST_SHARE = 6, 0.6
#: Similarity from which labelled rows count as near copies.
COPIES = 0.8
#: Weight of the parent's share, in documents.
SMOOTH = 2.0
PREFIXES = range(3, 9)
#: What the absence of any feature makes of the share of toxic rows.
NO_HIT = 0.1
#: Words that a worker keeps scores of, and that it gathers before it passes their counts on.
CACHE, GATHER = 100_000, 200_000

#: Letters that a digit or symbol resembles.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: Letters that a masking star may stand for.
MASKED = "aeiou"
SEPARATORS = " .-_*~'"
_SYM = re.escape("".join(LOOKS_LIKE))
_SEP = re.escape(SEPARATORS)
_CH = rf"(?:[^\W\d_]|[{_SYM}])"
#: Single characters set apart by separators.
SPACED = re.compile(rf"(?<![^\W_])(?:{_CH}[{_SEP}]){{2,}}{_CH}(?![^\W_])")
#: What any run of characters set apart by blanks holds; quick to look for.
BLANKS = re.compile(r" \S (?=\S(?:\W|$))")
#: Inside a token: single characters set apart, a word with symbols in it, or a letter three times over.
NOISY = re.compile(
    SPACED.pattern
    + rf"|[^\W\d_]*(?:[{_SYM}*_]+[^\W\d_]+)+[0-9@$|+(]*"
    + r"|[^\W\d_]+[0-9@$|+(]+"
    + r"|[^\W\d_]*?([^\W\d_])\1\1[^\W\d_]*"
)
WORD = re.compile(r"[^\W\d_]+")
TRIPLE = re.compile(r"([^\W\d_])\1\1")
#: Marks around a word that disguise nothing.
AROUND = ".,;:?!%&#*'\"()[]"

#: Characters of the model: a boundary, a to z, Latin letters with marks, and one for all others.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
SIZE = len(LETTERS) + 2
CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
COST_LOOK, COST_MASK, COST_JOIN, COST_BREAK, COST_DROP = 0.5, 1.5, 0.3, 2.0, 12.0
#: A letter more of a run of three or more.
COST_REPEAT = 0.3


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-probabilities [a, b, c] of a character c behind a and b.

    Every distinct word counts by one plus the logarithm of its frequency over all documents, so
    that a few frequent words do not drown the rest.  Only the table, bounded
    by the alphabet, comes to the driver.
    """

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            found: Counter = Counter()
            for token, n in seen.items():
                for word in (token,) if token.isalpha() else WORD.findall(token):
                    found[word] += n
            return pa.RecordBatch.from_arrays([pa.array(list(found.keys()), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

        for piece in arrow_steps(batches, "body"):
            for text in piece.column(0).to_pylist():
                if text:
                    seen.update(text.lower().split())
            if len(seen) > GATHER:
                yield out()
                seen.clear()
        if seen:
            yield out()

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE ** 3)
        for b in batches:
            text, weight = [], []
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                text += [0, 0, *(CODE.get(c, SIZE - 1) for c in word), 0]
                weight += [0.0, 0.0, *([1 + math.log(n)] * (len(word) + 1))]
            if text:
                t, w = np.array(text), np.array(weight)
                total += np.bincount((t[:-2] * SIZE + t[1:-1]) * SIZE + t[2:], w[2:], SIZE ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.rint(total[at] * 1024).astype(np.int64))], names=["gram", "n"])

    vocabulary = docs.select(F.col(text_col).alias("body")).mapInArrow(words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = vocabulary.mapInArrow(grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    n3 = np.zeros(SIZE ** 3)
    for r in rows:
        n3[r.gram] = r.n / 1024
    n3 = n3.reshape(SIZE, SIZE, SIZE)
    n2, n1 = n3.sum(0), n3.sum((0, 1))
    p1 = (n1 + 0.5) / (n1 + 0.5).sum()
    p2 = (n2 + 5 * p1) / (n2.sum(1, keepdims=True) + 5)
    p3 = (n3 + 5 * p2[None]) / (n3.sum(2, keepdims=True) + 5)
    return np.log(p3)


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """For each symbol of a span what it may stand for ('' nothing, ' ' a boundary) and the cost."""
    out, before = [], ""
    runs = {m.start() + k: m.end() - m.start() for m in re.finditer(r"(.)\1+", span) for k in range(m.end() - m.start())}
    for at, c in enumerate(span):
        options = []
        if c in SEPARATORS:
            options = [("", COST_JOIN), (" ", COST_BREAK)]
        if c == "*":
            options += [(x, COST_MASK) for x in MASKED]
        if c in LOOKS_LIKE:
            options += [(x, COST_LOOK) for x in LOOKS_LIKE[c]] + ([] if c.isdigit() else [("", COST_DROP)])
        if c.isalpha():
            options.append((c, 0.0))
        if not options:
            options = [("", COST_DROP)]
        if c == before and c not in SEPARATORS and runs[at] > 2:
            options.append(("", COST_REPEAT))
        out.append(options)
        before = c
    return out


def decode(span: str, model: np.ndarray) -> str:
    """The cheapest path through the lattice of a span, ended by a boundary."""
    best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for options in lattice(span):
        new: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in best.items():
            for c, extra in options:
                if not c or (c == " " and b == 0):
                    state, total, got = (a, b), cost + extra, text
                elif c == " ":
                    state, total, got = (0, 0), cost + extra - model[a, b, 0], text + " "
                else:
                    k = CODE.get(c, SIZE - 1)
                    state, total, got = (b, k), cost + extra - model[a, b, k], text + c
                if state not in new or (total, got) < new[state]:
                    new[state] = (total, got)
        best = new
    return min((cost - (model[a, b, 0] if b else 0.0), text) for (a, b), (cost, text) in best.items())[1]


class Restorer:
    """Restores texts; what spans and tokens become is kept, up to CACHE of each."""

    def __init__(self, model: np.ndarray):
        self.model, self.spans, self.tokens = model, {}, {}

    def _span(self, m: re.Match) -> str:
        span = m.group()
        if (got := self.spans.get(span)) is None:
            if len(self.spans) > CACHE:
                self.spans.clear()
            got = self.spans[span] = decode(span, self.model)
        return got

    def token(self, token: str) -> str:
        if token.strip(AROUND).isalpha() and not TRIPLE.search(token):
            return token
        return NOISY.sub(self._span, token)

    def joined(self, text: str) -> str:
        """Lower case, characters set apart by blanks brought together."""
        text = text.lower()
        return SPACED.sub(self._span, text) if BLANKS.search(text) else text

    def words(self, text: str) -> set[str]:
        """Distinct words of the restored text."""
        out: set[str] = set()
        for token in set(self.joined(text).split()):
            got = self.tokens.get(token)
            if got is None:
                if len(self.tokens) > CACHE:
                    self.tokens.clear()
                got = self.tokens[token] = tuple(WORD.findall(self.token(token)))
            out.update(got)
        return out

    def restore(self, text: str) -> str:
        return re.sub(r"\S+", lambda m: self.token(m.group()), self.joined(text))


def restored(docs: DataFrame, model: np.ndarray, text_col: str = "text") -> Column:
    """Column of restored lower-case texts (null: empty)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def run(col: pd.Series) -> pd.Series:
        r = Restorer(shared.value)
        return col.map(lambda t: r.restore(t) if t else "")

    return run(F.col(text_col))


def features(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) > k)]


def word_share(word: str, tree: dict[str, tuple[int, int]], share: float) -> float:
    """Smoothed share of toxic documents among those with the word; 0 where it does not count."""
    chain = [tree[f] for f in [*features(word)[1:], word] if f in tree]
    if not any(k >= LEAST_DOCS and k >= LEAST_SHARE * n for k, n in chain):
        return 0.0
    for (k, n), (k2, n2) in zip(chain, [*chain[1:], (0, 0)], strict=True):
        share = (max(k - k2, 0) + SMOOTH * share) / (max(n - n2, k - k2, 0) + SMOOTH)
    return share


def shingles(text: str) -> set[int]:
    """Hashes of the runs of five words; of a shorter text that of all its words."""
    words = text.lower().split()
    return {zlib.crc32(" ".join(words[i:i + 5]).encode()) for i in range(max(1, len(words) - 4))}


def signature(text: str) -> int:
    """Least hash of the runs of five words: near copies mostly share it."""
    return min(shingles(text))


def alike(a: str, b: str) -> bool:
    """Whether two texts are near copies: similarity of their runs of five words."""
    x, y = shingles(a), shingles(b)
    return len(x & y) >= COPIES * len(x | y)


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray, train_rows: int = TRAIN_ROWS) -> tuple[float, float, dict[str, tuple[int, int]]]:
    """(share of toxic rows, mean words of a row, feature -> toxic and all documents with it),
    from at most ``train_rows`` labelled rows that are not held out.

    Of near copies with one label a single one counts, of several texts of a doc_id the longest
    (of equally long ones the last in code-point order).
    """
    spark = docs.sparkSession
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    )
    sample = spread_sample(known, F.col("doc_id"), train_rows).checkpoint()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("body"))

    @F.pandas_udf("long")
    def sign(col: pd.Series) -> pd.Series:
        return col.map(signature)

    @F.pandas_udf("boolean")
    def same(col: pd.Series, heads: pd.Series) -> pd.Series:
        return pd.Series([alike(x, y) for x, y in zip(col, heads, strict=True)], dtype=bool)

    # The sample is bounded by train_rows, so its ids may be broadcast; its texts are written once.
    drawn = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.max_by("body", F.struct(F.length("body"), "body")).alias("body"))
    signed = written(drawn.select("*", sign("body").alias("sign")), "labelled")
    # Rows that share a hash are near copies only if they are alike to the first of them.
    heads = signed.groupBy("sign", "toxic").agg(F.min("doc_id").alias("head"))
    first = signed.select(F.col("doc_id").alias("head"), F.col("body").alias("model_text"))
    met = signed.join(F.broadcast(heads), ["sign", "toxic"])  # three numbers a row, at most train_rows rows
    others = met.where("doc_id <> head").join(first, "head").where(~same("body", "model_text"))
    rows = met.where("doc_id = head").select("body", "toxic").unionAll(others.select("body", "toxic"))
    shared = spark.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, seen = Restorer(shared.value), {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.int64())], names=["feature", "toxic", "n"])

        for piece in arrow_steps(batches, "body"):
            for text, y in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                words = r.words(text)
                # Distinct words; under the empty feature: documents by label; under a blank: words by label.
                for f, n in (*((f, 1) for f in {f for w in words for f in features(w)}), ("", 1), (" ", len(words))):
                    v = seen.setdefault(f, [0, 0])
                    v[0] += y * n
                    v[1] += n
            if len(seen) > GATHER:
                yield out()
                seen.clear()
        if seen:
            yield out()

    found = rows.mapInArrow(count, "feature string, toxic long, n long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    found = written(found.where("n > 1 or feature in ('', ' ')"), "features")
    total = {r.feature: (r.toxic, r.n) for r in found.where("feature in ('', ' ')").collect()}
    toxic, n = total.get("", (0, 0))
    if not toxic:
        return 0.0, 1.0, {}
    # Each seed takes some toxic documents of the sample, so the sample bounds them; with them come their trees.
    seeds = [r.feature for r in found.where(f"toxic >= {LEAST_DOCS} and toxic >= {LEAST_SHARE} * n and feature not in ('', ' ')").select("feature").collect()]
    stem = F.ltrim("feature", F.lit("^"))
    near = F.col("feature").isin(sorted({x for f in seeds for x in features(f.lstrip("^"))}))
    for k in PREFIXES:
        near |= F.substring(stem, 1, k).isin([f[1:] for f in seeds if f[0] == "^" and len(f) == k + 1])
    tree = {r.feature: (r.toxic, r.n) for r in found.where(near).collect()}
    return min(toxic / n, 0.5), max(1.0, total[" "][1] / n), tree


def score(docs: DataFrame, model: np.ndarray, fitted: tuple[float, float, dict[str, tuple[int, int]]], text_col: str = "text") -> Column:
    """Column of scores, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast((model, fitted))

    @F.pandas_udf("double")
    def run(cols: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, (share, usual, tree) = shared.value
        r, memo = Restorer(model), {}

        def one(text: str) -> float:
            words, hits = r.words(text), []
            for w in words:
                p = memo.get(w)
                if p is None:
                    if len(memo) > CACHE:
                        memo.clear()
                    p = memo[w] = word_share(w, tree, share)
                if p >= LEAST_SHARE:
                    hits.append(p)
            prior = share / (1 - share)
            odds = prior * (1 if hits else NO_HIT)
            for p in sorted(hits):
                odds = min(1e12, odds * max(1.0, p / (1 - p) / prior * min(1.0, usual / len(words))))
            return odds / (1 + odds)

        for col in cols:
            yield col.map(one, na_action=None).astype("float64")

    return run(F.coalesce(F.col(text_col), F.lit("")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query: (doc_id, held_out, score, predicted) of every document."""
    model = character_model(docs)
    fitted = fit(docs, labels, model)
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
        score(docs, model, fitted).alias("score"),
    )
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
