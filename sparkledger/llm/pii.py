"""Operator 5: personal data by a semi-Markov conditional random field.

Rules give the base spans (email, ip, card, phone).  The field then reads the
surroundings of every digit and at sign: candidate segments of bounded length are scored as
wholes (digit counts and groupings, separators, checksum, neighbours, shape), and a dynamic
program over segment ends chooses boundaries and types together.  Segments that
touch no base span are added; base spans always stay.

The field is trained here by likelihood on a bounded sample of surroundings,
labelled by the base spans and by disguised copies of them (the plus sign left
out, blanks around the at sign, other separators), with surroundings without any span
as counter-examples.  Every candidate segment holds a digit or an at sign.

Null and empty texts have no spans.  Repeated rows give repeated results.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_steps
from .pretokens import utf8_column

KINDS = ("email", "ip", "card", "phone")
#: The base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match cannot begin inside a run of digits if none begins with it; without the look-behind long runs cost their square.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Surroundings that the field is trained on, at most, and passes over them.
TRAIN_WINDOWS, EPOCHS = 1500, 4
#: Tokens and characters of a segment, at most.
MOST_TOKENS, MOST_CHARS = 24, 72
#: Characters kept on each side of a digit or at sign, at least: no segment reaches further.
MARGIN = MOST_CHARS
#: Characters of a surrounding that the field is trained on, below this.
TRAIN_CHARS = 400 + 2 * (MARGIN - 24)
TOKEN = re.compile(r"[^\W_]+|\s|.", re.S)
TRIGGER = re.compile(r"[0-9@]")
RUN = re.compile(r"[A-Za-z0-9._%+-]+")
BLANK = re.compile(r"\s")
#: What no phone number holds: other characters, a date.
NO_PHONE = re.compile(r"[^+0-9\x20().\-/]|(?<![0-9])(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9])")
GROUPS = re.compile(r"[0-9]+")
#: Thirteen digits that may be a book number; its check digit decides.
BOOK = re.compile(r"(?<![0-9])97[89](?:[\x20-]?[0-9]){10}(?![0-9])")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then kind."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    for m in IP.finditer(text):
        if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def surroundings(text: str) -> list[tuple[int, int]]:
    """Parts of a text around its digits and at signs: MARGIN characters on each side and on to the next blank,
    overlapping ones joined."""
    near: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if near and a < near[-1][1]:
            near[-1][1] = b
        else:
            near.append([a, b])
    out: list[list[int]] = []
    for a, b in near:
        last = out[-1][1] if out else 0
        if b <= last:
            continue
        while a > last and not text[a - 1].isspace():
            a -= 1
        m = BLANK.search(text, b)
        b = b if text[b - 1].isspace() else m.start() if m else len(text)
        if out and a <= last and (a < last or not text[a - 1].isspace()):
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


@lru_cache(maxsize=20_000)
def _shape_features(shape: str, luhn_ok: bool, ip_ok: bool) -> tuple[str, ...]:
    """Features of a whole segment from its shape: letters as a, digits as 9, others as they are."""
    digits = shape.count("9")
    groups = [len(g) for g in re.findall("9+", shape)]
    short = re.sub(r"9+", "9", re.sub(r"a+", "a", shape))
    out = [
        "bias", f"digits={digits if digits < 20 else 20}", f"groups={min(len(groups), 8)}", f"at={min(shape.count('@'), 2)}",
        f"dots={min(shape.count('.'), 4)}", f"first={short[0]}", f"last={short[-1]}", f"blanks={min(shape.count(' '), 4)}",
        f"letters={'a' in shape}", f"dashes={min(shape.count('-'), 4)}", f"round={'(' in shape}", f"short={short}", f"sizes={groups[:6]}",
        f"length={min(len(shape) // 6, 8)}",
    ]
    if luhn_ok:
        out.append(f"checksum={12 <= digits <= 19}")
    if ip_ok:
        out.append("four parts")
    if "\n" in shape or "\t" in shape:
        out.append("line break")
    if "@" in shape:
        left, _, right = shape.partition("@")
        out += [f"before={left[-1:]}", f"behind={right[:1]}", f"domain={'.' in right}"]
    return tuple(out)


def _shape(part: str) -> str:
    return "".join("9" if "0" <= c <= "9" else "a" if c.isalnum() else c for c in part)


def is_phone(part: str, digits: int) -> bool:
    """Nine to fifteen digits in a phone's characters that are no date and no list of
    small numbers (groups of two begin with a zero, a plus sign or a bracket where they are dialled)."""
    if not 9 <= digits <= 15 or part.isdigit() or NO_PHONE.search(part):
        return False
    return part[0] in "+(0" or max(map(len, GROUPS.findall(part))) > 2


def book_numbers(text: str) -> list[tuple[int, int]]:
    """Places of ISBNs: no part of one is a phone number."""
    valid = lambda m: sum((ord(c) - 48) * (3 if i % 2 else 1) for i, c in enumerate(filter(str.isdigit, m.group()))) % 10 == 0
    return [m.span() for m in BOOK.finditer(text) if valid(m)]


def admitted(part: str, digits: int, checksum: bool, ip_ok: bool) -> np.ndarray:
    """0 for each kind that a segment can be, -inf for the others: what a kind must be
    by definition (digits, checksum, parts up to 255, a domain) is not left to weights."""
    left, _, right = part.partition("@")
    can = (
        part.count("@") == 1 and left.strip() and "." in right.strip(". ") and not re.search(r"\s\S*\s", part.replace(" @ ", "@")),
        ip_ok,
        checksum and "@" not in part and not any(c.isalpha() for c in part),
        not ip_ok and is_phone(part, digits),
    )
    return np.array([0.0 if c else -np.inf for c in can])


def segments(text: str) -> tuple[list[int], list[tuple[int, int, tuple[str, ...], np.ndarray]]]:
    """(token ends with 0 first, candidate segments (first token, end token, features, kinds it can be))."""
    tokens = TOKEN.findall(text)
    ends = [0]
    for t in tokens:
        ends.append(ends[-1] + len(t))
    shape = _shape(text)
    starts = [i for i, t in enumerate(tokens) if t[0] in "+(" or t[0].isalnum()]
    stops = [i + 1 for i, t in enumerate(tokens) if t[-1].isalnum()]
    count = lambda chars: [0, *accumulate(sum(map(t.count, chars)) for t in tokens)]
    books = book_numbers(text)
    digit_count, at_count, dot_count = count("0123456789"), count("@"), count(".")
    out = []
    for i in starts:
        for j in stops[bisect_right(stops, i):bisect_right(stops, i + MOST_TOKENS)]:
            if ends[j] - ends[i] > MOST_CHARS:
                break
            # Without an at sign it takes nine digits, or four parts.
            n = digit_count[j] - digit_count[i]
            if at_count[j] == at_count[i] and not 9 <= n <= 19 and (n < 4 or dot_count[j] - dot_count[i] != 3):
                continue
            part = text[ends[i]:ends[j]]
            digits = [c for c in part if "0" <= c <= "9"]
            pieces = part.split(".")
            ip_ok = len(pieces) == 4 and all(p.isdigit() and p.isascii() and len(p) < 4 and int(p) < 256 for p in pieces)
            checksum = 12 <= len(digits) <= 19 and luhn("".join(digits))
            can = admitted(part, len(digits), checksum, ip_ok)
            if books and can[3] == 0:
                k = bisect_left(books, (ends[j],)) - 1  # the last that begins before the segment ends
                can[3] = -np.inf if k >= 0 and books[k][1] > ends[i] else 0
            if not np.isfinite(can).any():
                continue
            fixed = _shape_features(shape[ends[i]:ends[j]], checksum, ip_ok)
            left = shape[ends[i] - 1] if i else "^"
            right = shape[ends[j]] if j < len(tokens) else "^"
            out.append((i, j, (*fixed, f"left={left}", f"right={right}"), can))
    _whole_addresses(text, ends, out)
    return ends, out


def _whole_addresses(text: str, ends: list[int], found: list[tuple[int, int, tuple[str, ...], np.ndarray]]) -> None:
    """Of segments that begin in one run of address characters and end in one, only the longest can be an email."""
    emails = [x for x, (_, _, _, can) in enumerate(found) if can[0] == 0]
    if len(emails) < 2:
        return
    runs = [m.span() for m in RUN.finditer(text)]

    def run(at: int) -> int:
        k = bisect_right(runs, (at, len(text) + 1)) - 1
        return k if k >= 0 and at < runs[k][1] else -1 - at

    longest: dict[tuple[int, int], int] = {}
    for x in emails:
        i, j = found[x][:2]
        key = run(ends[i]), run(ends[j] - 1)
        y = longest.setdefault(key, x)
        if y != x:
            less = x if ends[j] - ends[i] <= ends[found[y][1]] - ends[found[y][0]] else y
            found[less][3][0] = -np.inf
            longest[key] = x + y - less
    found[:] = [f for f in found if np.isfinite(f[3]).any()]


class Field:
    """Weights of the field; scores, gradients and the best segmentation."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        self.weights = weights or {}
        self.zero = np.zeros(len(KINDS))
        self.memo: dict[tuple[str, ...], np.ndarray] = {}

    def score(self, features: tuple[str, ...]) -> np.ndarray:
        return sum((self.weights.get(f, self.zero) for f in features), self.zero)

    def best(self, text: str) -> list[Span]:
        """Spans of the best segmentation."""
        ends, found = segments(text)
        if not found:
            return []
        n = len(ends) - 1
        into: list[list[tuple[float, int, int]]] = [[] for _ in range(n + 1)]
        for i, j, feats, can in found:
            s = self.memo.get(feats)
            if s is None:
                if len(self.memo) > 50_000:
                    self.memo.clear()
                s = self.memo[feats] = self.score(feats)
            s = s + can
            k = int(s.argmax())
            if s[k] > 0:
                into[j].append((float(s[k]), i, k))
        value, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            value[j], back[j] = value[j - 1], None
            for s, i, k in into[j]:
                if value[i] + s > value[j]:
                    value[j], back[j] = value[i] + s, (i, k)
        out, j = [], n
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, k = back[j]
                out.append((ends[i], k, ends[j]))
                j = i
        return out[::-1]

    def step(self, text: str, gold: list[Span], rate: float, decay: float) -> None:
        """One step up the likelihood of a labelled text."""
        ends, found = segments(text)
        n = len(ends) - 1
        scores = [self.score(f) + can for _, _, f, can in found]
        into: list[list[int]] = [[] for _ in range(n + 1)]
        out: list[list[int]] = [[] for _ in range(n + 1)]
        for x, (i, j, _, _) in enumerate(found):
            into[j].append(x)
            out[i].append(x)
        total = [float(np.logaddexp.reduce(s)) for s in scores]
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            ahead[j] = _logsum([ahead[j - 1], *(ahead[found[x][0]] + total[x] for x in into[j])])
        for i in range(n - 1, -1, -1):
            behind[i] = _logsum([behind[i + 1], *(behind[found[x][1]] + total[x] for x in out[i])])
        gold_at = {(a, b): k for a, k, b in gold}
        for x, (i, j, feats, _) in enumerate(found):
            grad = -np.exp(np.minimum(0.0, ahead[i] + scores[x] + behind[j] - ahead[n]))
            if (k := gold_at.get((ends[i], ends[j]))) is not None:
                grad[k] += 1
            if np.abs(grad).max() < 1e-4:
                continue
            for f in feats:
                w = self.weights.get(f)
                self.weights[f] = rate * grad if w is None else w * (1 - rate * decay) + rate * grad


def _logsum(xs: list[float]) -> float:
    top = max(xs)
    return top + math.log(sum(math.exp(x - top) for x in xs))


def disguised(text: str, spans: list[Span], salt: int) -> tuple[str, list[Span]]:
    """The text with its spans written another way, and the spans there."""
    out, new, at = [], [], 0
    size = 0
    for k, (a, kind, b) in enumerate(spans):
        if a < at:
            continue
        out.append(text[at:a])
        size += a - at
        part, way = text[a:b], (salt + k) % 3
        if kind == 0:
            part = [part.replace("@", " @ "), part.replace("@", "@ "), part][way]
        elif kind == 2:
            digits = re.sub(r"\D", "", part)
            part = [".".join(digits[i:i + 4] for i in range(0, len(digits), 4)), " ".join(digits[i:i + 4] for i in range(0, len(digits), 4)), part][way]
        elif kind == 3:
            part = [part.lstrip("+"), "(" + part[part.index("(") + 1:] if "(" in part else part.lstrip("+"), part][way]
        out.append(part)
        new.append((size, kind, size + len(part)))
        size += len(part)
        at = b
    out.append(text[at:])
    return "".join(out), new


def train(rows: list[tuple[str, list[Span]]], epochs: int = EPOCHS) -> Field:
    field = Field()
    examples = []
    for n, (text, spans) in enumerate(rows):
        examples.append((text, spans))
        if spans:
            examples.append(disguised(text, spans, n))
    order = np.random.default_rng(5)
    for epoch in range(epochs):
        for x in order.permutation(len(examples)):
            field.step(*examples[x], rate=0.3 / (1 + epoch), decay=0.002)
    return field


def _interesting(piece: pa.RecordBatch, column: int) -> np.ndarray:
    """Rows whose text has a digit or an at sign."""
    data, offsets = utf8_column(piece.column(column))
    hits = np.flatnonzero(((data >= 48) & (data <= 57)) | (data == 64))
    at = np.searchsorted(hits, offsets)
    return np.diff(at) > 0


def fit(docs: DataFrame, text_col: str = "text", train_windows: int = TRAIN_WINDOWS) -> Field:
    """The field, from at most ``train_windows`` surroundings, those of least checksum in each of so many slots."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrow_steps(batches, "body"):
            keys, parts, marks = [], [], []
            for text in piece.column(0).filter(pa.array(_interesting(piece, 0))).to_pylist():
                spans = base_spans(text)
                for a, b in surroundings(text):
                    inside = [s for s in spans if a <= s[0] and s[2] <= b]
                    part = text[a:b]
                    if len(part) < TRAIN_CHARS and all(s[2] <= a or s[0] >= b or s in inside for s in spans):
                        keys.append(zlib.crc32(part.encode("utf-8", "surrogatepass")))
                        parts.append(part)
                        marks.append([x for s, k, e in inside for x in (s - a, k, e - a)])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(parts, pa.string()), pa.array(marks, pa.list_(pa.int64()))], names=["key", "part", "marks"])

    found = docs.select(F.col(text_col).alias("body")).mapInArrow(windows, "key long, part string, marks array<long>")
    # Surroundings without a span are about as many as those with one.
    slots = max(1, train_windows // 2)
    slot = [(F.size("marks") > 0).alias("some"), (F.col("key") % slots).alias("slot")]
    rows = found.groupBy(*slot).agg(F.min(F.struct("key", "part", "marks")).alias("w")).select("w.*").orderBy("key", "part").collect()
    return train([(r.part, [(r.marks[i], r.marks[i + 1], r.marks[i + 2]) for i in range(0, len(r.marks), 3)]) for r in rows])


def find_pii(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start, then kind."""
    base = base_spans(text)
    starts, reach = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))
    extra = []
    for a, b in surroundings(text):
        for s, k, e in field.best(text[a:b]):
            s, e = s + a, e + a
            before = bisect_left(starts, e)
            if not before or reach[before - 1] <= s:  # no base span that begins before its end goes on into it
                extra.append((s, k, e))
    return base, sorted(base + extra)


SPAN = "array<struct<kind: int, start: int, end: int>>"


def pii_spans(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end), by start, then kind."""
    shared = docs.sparkSession.sparkContext.broadcast(field.weights)
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(shared.value)
        for piece in arrow_steps(batches, "body"):
            cells: list[list] = [[], []]
            for text, some in zip(piece.column(1).to_pylist(), _interesting(piece, 1).tolist(), strict=True):
                found = find_pii(text, field) if some else ((), ())
                for cell, spans in zip(cells, found, strict=True):
                    cell.append([{"kind": k, "start": s, "end": e} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([piece.column(0), *(pa.array(c, kind) for c in cells)], names=["doc_id", "base", "spans"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    return src.mapInArrow(run, f"doc_id long, base {SPAN}, spans {SPAN}")


def redactor(docs: DataFrame, field: Field):
    """Column function: a text with every span replaced by its kind in angle brackets."""
    shared = docs.sparkSession.sparkContext.broadcast(field.weights)

    @F.pandas_udf("string")
    def run(cols: Iterator[pd.Series]) -> Iterator[pd.Series]:
        field = Field(shared.value)

        def one(text):
            if not text or not TRIGGER.search(text):
                return text
            out, at = [], 0
            for s, k, e in find_pii(text, field)[1]:
                if e <= at:
                    continue
                out += [text[at:max(at, s)], f"<{KINDS[k]}>" if s >= at else ""]
                at = e
            return "".join([*out, text[at:]])

        for col in cols:
            yield col.map(one, na_action="ignore")

    return run


def of_kind(kind: int):
    return lambda span: span["kind"] == kind


def pii_rows(docs: DataFrame) -> DataFrame:
    """The query: counts and digest of the base spans, and all spans."""
    names = F.array(*(F.lit(k) for k in KINDS))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
    found = pii_spans(docs, fit(docs))
    return found.select(
        "doc_id",
        *(F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(text("base").cast("binary"), 256).alias("base_sha256"),
        text("spans").alias("spans"),
    )
