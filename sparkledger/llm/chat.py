"""Operator 3: transcripts to canonical turns by a hidden Markov model.

States are (role, first line or later line of a turn).  What is seen of a line
is its speaker marker (a short lead such as ``User:`` or ``### Human:``, taken as a
word of a learned vocabulary), whether it is blank or follows a blank line, its length
and how it ends.  Start, transition and emission probabilities are counted, with
add-one smoothing, on transcripts whose turns are known; the Viterbi path gives every line
its role and every turn its start, markers are taken off, and turns are rendered in one form.

A conversation is one transcript and one row of the result, however long.  It is read in
parts of PART_ROWS turn rows, so an endless one does not meet in one task: each part gives the
best score from every state before it to every state at its end (a max-plus matrix), the matrices
of a conversation, taken in order, give the states at all borders, and between its borders
each part is decoded on its own.  Scores are whole numbers, so the sums do not depend on the cut and the
path is a best one of the undivided transcript.

Null and empty transcripts have no turns.  A turn row repeated whole counts once, different
rows of one turn number follow each other by role and text, a null turn number is 0, a null role is
read as user.  Rows without a conversation id belong to no other row: each is a conversation.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkledger.operators.ranking import sequence_within

from .common import arrow_steps, spread_sample, written

ROLES = ("system", "user", "assistant")
STATES = [(r, b) for r in range(3) for b in (1, 0)]  # role, first line of a turn
#: Turn rows that are decoded by one call.
PART_ROWS = 64
#: Log probabilities are counted in units of 1 / SCALE.
SCALE = 1 << 20
#: Markers of the vocabulary; others are one word.
MARKERS = 500
#: Conversations that the model is counted on, at most.
TRAIN_PARTS = 20_000

MARKER = re.compile(r"^\s*(?:[#>*\-]{1,4}\s*)?[<\[(|*]{0,3}([A-Za-z]{1,12})(?:\|>|[\]\)|>*:]{1,3})\s*")

#: What tells conversations apart.
KEYS = ["conv_id", "solo"]

#: Ways in which transcripts are written: the form of a marker, and the names of the roles.
STYLES = [
    ("{}: ", ("System", "User", "Assistant")),
    ("### {}:\n", ("Instruction", "Human", "Assistant")),
    ("<|{}|>\n", ROLES),
    ("{}: ", ("Note", "Q", "A")),
    ("[{}] ", ROLES),
    ("{}> ", ("admin", "guest", "bot")),
    ("**{}:** ", ("Context", "Customer", "Agent")),
]


def transcripts(turns: DataFrame) -> DataFrame:
    """(conv_id, solo, part, cut, text, truth): turns written as transcripts, in the style that the
    conversation's checksum draws; one turn in seven has a blank line instead of its marker.
    ``solo`` tells rows without an id apart, ``cut`` is true if the conversation may have more
    parts, and ``truth`` is the true state of every line, by number."""
    row = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.when(F.lower("role").isin(*ROLES), F.lower("role")).otherwise("user").alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    draw = lambda *c: F.crc32(F.concat_ws(":", *[F.coalesce(F.col(x).cast("string"), F.lit("")) for x in c]))
    solo = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text")).otherwise(F.lit(0))
    row = sequence_within(row.withColumn("solo", solo), KEYS, [("turn", "asc"), ("role", "asc"), ("text", "asc")])
    style = draw("conv_id") % len(STYLES)
    lead = F.lit("")
    for i, (form, names) in enumerate(STYLES):
        for role, name in zip(ROLES, names, strict=True):
            lead = F.when((style == i) & (F.col("role") == role), F.lit(form.format(name))).otherwise(lead)
    hidden = (F.col("turn") > 0) & (draw("conv_id", "turn") % 7 == 0)
    body = F.concat(F.when(hidden, F.lit("\n")).otherwise(lead), F.col("text"))
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") - 1
    lines = F.size(F.split(body, "\n"))
    truth = F.transform(F.sequence(F.lit(1), lines), lambda i: role * 2 + F.when(i == 1, 0).otherwise(1))
    parts = row.select(*KEYS, F.floor((F.col("seq") - 1) / PART_ROWS).alias("part"), F.struct("seq", body.alias("body"), truth.alias("truth")).alias("t"))
    grouped = parts.groupBy(*KEYS, "part").agg(F.array_sort(F.collect_list("t")).alias("t"))
    cut = (F.col("part") > 0) | (F.size("t") == PART_ROWS)
    return grouped.select(*KEYS, "part", cut.alias("cut"), F.array_join("t.body", "\n").alias("text"), F.flatten("t.truth").alias("truth"))


def line_features(lines: list[str], after: int = 2) -> list[tuple[str, tuple[int, ...]]]:
    """(marker or '', (blank, after a blank, length, ending)) of every line; ``after`` is 1 if the
    line before the first one is blank, 0 if it is not, 2 if there is none."""
    out = []
    for line in lines:
        m = MARKER.match(line)
        mark = re.sub(r"\s+", "", line[:m.end()]).lower() if m else ""
        rest = line.strip()
        blank = int(not rest)
        ending = 0 if not rest else 1 + ".?!:".find(rest[-1]) if rest[-1] in ".?!:" else 5
        out.append((mark, (blank, after, min(len(rest).bit_length() // 2, 6), ending)))
        after = blank
    return out


SIZES = (2, 3, 7, 6)


class Model:
    def __init__(self, counts: dict[tuple[str, int, int], float], markers: list[str]):
        """counts: (what, state, value) -> number; markers: the vocabulary, '' and '*' (any other) first."""
        n = len(STATES)
        table = lambda what, size: np.array([[counts.get((what, s, v), 0) + 1.0 for v in range(size)] for s in range(n)])
        whole = lambda x: np.rint(np.log(x) * SCALE).astype(np.int64)
        norm = lambda t: whole(t / t.sum(1, keepdims=True))
        self.words = {m: i for i, m in enumerate(markers)}
        start = np.array([counts.get(("start", s, 0), 0) + (1.0 if STATES[s][1] else 1e-6) for s in range(n)])
        self.start = whole(start / start.sum())
        steps = table("step", n)
        for a, (role, _) in enumerate(STATES):  # a later line goes on with the turn it is in
            for b, (role2, first) in enumerate(STATES):
                if not first and role != role2:
                    steps[a, b] = 1e-12
        self.steps = norm(steps)
        self.marks = norm(table("mark", len(markers)))
        self.lines = [norm(table(f"line{k}", size)) for k, size in enumerate(SIZES)]

    def emission(self, features: tuple[str, tuple[int, ...]]) -> np.ndarray:
        mark, line = features
        out = self.marks[:, self.words.get(mark, 1)]
        for t, v in zip(self.lines, line, strict=True):
            out = out + t[:, v]
        return out

    def viterbi(self, lines: list[str], enter: int | None = None, after: int = 2, leave: int | None = None) -> list[int]:
        """The most likely states; of equal ones the smaller number.  A part in the middle of a
        transcript has the state before it, whether that line was blank, and its own last state."""
        if not lines:
            return []
        seen = [self.emission(f) for f in line_features(lines, after)]
        value, back = (self.start if enter is None else self.steps[enter]) + seen[0], []
        for e in seen[1:]:
            reach = value[:, None] + self.steps
            back.append(reach.argmax(0))
            value = reach.max(0) + e
        path = [int(value.argmax()) if leave is None else leave]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]

    def matrix(self, lines: list[str], opens: bool) -> np.ndarray:
        """Best scores from the state before the lines (rows; first all after a line with text, then all
        after a blank one) to the state of the last line (columns)."""
        features = line_features(lines)
        before = np.broadcast_to(self.start, self.steps.shape) if opens else self.steps
        heads = [line_features(lines[:1], 2 if opens else a)[0] for a in (0, 1)]
        value = np.concatenate([before + self.emission(h) for h in heads])
        for f in features[1:]:
            value = (value[:, :, None] + self.steps).max(1) + self.emission(f)
        return value

    def pieces(self, lines: list[str], path: list[int], goes_on: bool = False) -> list[tuple[bool, str, str]]:
        """(starts a turn, role, text) of every run of lines of a turn, markers taken off; if the
        lines go on from others, the first run may belong to the turn before."""
        out: list[tuple[bool, str, list[str]]] = []
        for line, s in zip(lines, path, strict=True):
            role, first = STATES[s]
            if first or not (out or goes_on):
                m = MARKER.match(line)
                marked = m and re.sub(r"\s+", "", line[:m.end()]).lower() in self.words
                out.append((True, ROLES[role], [line[m.end():] if marked else line]))
            elif out:
                out[-1][2].append(line)
            else:
                out.append((False, ROLES[role], [line]))
        return [(starts, role, "\n".join(body)) for starts, role, body in out]

    def turns(self, text: str | None) -> list[tuple[str, str]]:
        """(role, text) of every turn; markers and the blank lines around a turn are taken off."""
        if not text:
            return []
        lines = text.split("\n")
        return joined(self.pieces(lines, self.viterbi(lines)))


def joined(pieces: Iterable[tuple[bool, str, str]]) -> list[tuple[str, str]]:
    """Turns from the pieces of all parts, in order."""
    out: list[tuple[str, list[str]]] = []
    for starts, role, text in pieces:
        if starts or not out:
            out.append((role, [text]))
        else:
            out[-1][1].append(text)
    return [(role, "\n".join(body).strip("\n")) for role, body in out]


def fit(known: DataFrame, train_parts: int = TRAIN_PARTS) -> Model:
    """Counted on the first parts of at most ``train_parts`` transcripts, of those whose checksum mod 3 is not 1."""
    learnt = known.where("part = 0").where(F.coalesce(F.crc32(F.col("conv_id").cast("string")) % 3 != 1, F.lit(True)))
    sample = spread_sample(learnt.select(*KEYS, "text", "truth"), F.struct(*KEYS), train_parts).select("text", "truth")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for piece in arrow_steps(batches, "text"):
            for text, truth in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                before = None
                for s, (mark, line) in zip(truth, line_features(text.split("\n")), strict=True):
                    seen["start" if before is None else "step", s if before is None else before, 0 if before is None else s, ""] += 1
                    seen["mark", s, 0, mark] += 1
                    for k, v in enumerate(line):
                        seen[f"line{k}", s, v, ""] += 1
                    before = s
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in ([k[0] for k in seen], pa.array([k[1] for k in seen], pa.int32()), pa.array([k[2] for k in seen], pa.int32()), [k[3] for k in seen], pa.array(list(seen.values()), pa.int64()))], schema=pa.schema([("what", pa.string()), ("state", pa.int32()), ("value", pa.int32()), ("mark", pa.string()), ("n", pa.int64())]))

    counted = sample.mapInArrow(count, "what string, state int, value int, mark string, n long").groupBy("what", "state", "value", "mark").agg(F.sum("n").alias("n")).checkpoint()
    rows = counted.where("what <> 'mark'").collect()  # bounded by the states and feature values
    common = [r.mark for r in counted.where("what = 'mark' and mark <> ''").groupBy("mark").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "mark").limit(MARKERS).collect()]
    markers = ["", "*", *common]
    counts = {(r.what, r.state, r.value): float(r.n) for r in rows}
    at = {m: i for i, m in enumerate(markers)}
    word = F.when(F.col("mark").isin(*markers), F.col("mark")).otherwise("*")
    for r in counted.where("what = 'mark'").groupBy("state", word.alias("mark")).agg(F.sum("n").alias("n")).collect():
        counts["mark", r.state, at[r.mark]] = float(r.n)
    return Model(counts, markers)


TURNS = "array<struct<role: string, text: string>>"


def parse(rows: DataFrame, model: Model, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, turns): the turns of every transcript."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrow_steps(batches, "body"):
            model = shared.value
            cells = [[{"role": r, "text": t} for r, t in model.turns(x)] for x in piece.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*piece.columns[:len(keys)], pa.array(cells, kind)], names=[*keys, "turns"])

    src = rows.select(*keys, F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    types = dict(src.dtypes)
    return src.mapInArrow(run, ", ".join(f"`{k}` {types[k]}" for k in keys) + f", turns {TURNS}")


def borders(model: Model, parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, part, enter, after, leave): the state before each part (null: none), whether the line before
    it is blank, and its last state, on a best path through all parts of a transcript.

    ``parts`` (keys, part, text) are numbered from 0; the lines of a transcript are those of its parts.
    One group holds 73 numbers a part, far less than the rendered transcript, which is one value as well.
    """
    shared = parts.sparkSession.sparkContext.broadcast(model)
    n, k = len(STATES), len(keys)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrow_steps(batches, "body"):
            lines = [x.split("\n") for x in piece.column(k + 1).to_pylist()]
            best = [shared.value.matrix(x, p == 0).ravel() for x, p in zip(lines, piece.column(k).to_pylist(), strict=True)]
            blank = [int(not x[-1].strip()) for x in lines]
            yield pa.RecordBatch.from_arrays([*piece.columns[:k + 1], pa.array(best, pa.list_(pa.int64())), pa.array(blank, pa.int32())], names=[*keys, "part", "best", "blank"])

    def through(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        value, backs, afters, after = np.zeros(n, np.int64), [], [], 0
        for best, blank in zip(group["best"], group["blank"], strict=True):
            reach = value[:, None] + np.asarray(best, np.int64).reshape(2, n, n)[after]
            backs.append(reach.argmax(0))
            value = reach.max(0)
            afters.append(after)
            after = int(blank)
        ends = [int(value.argmax())]
        for back in reversed(backs[1:]):
            ends.append(int(back[ends[-1]]))
        ends.reverse()
        out = group[[*keys, "part"]].copy()
        out["enter"] = pd.array([None, *ends[:-1]], "Int32")
        out["after"] = pd.array([2, *afters[1:]], "Int32")
        out["leave"] = pd.array(ends, "Int32")
        return out

    src = parts.select(*keys, F.col("part").cast("long").alias("part"), F.coalesce("text", F.lit("")).alias("body"))
    types = dict(src.dtypes)
    named = ", ".join(f"`{c}` {types[c]}" for c in [*keys, "part"])
    scored = src.mapInArrow(score, f"{named}, best array<long>, blank int")
    return scored.groupBy(*keys).applyInPandas(through, f"{named}, enter int, after int, leave int")


def parse_parts(parts: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """(keys, turns): the turns of transcripts that come in parts (keys, part, text)."""
    shared = parts.sparkSession.sparkContext.broadcast(model)
    k = len(keys)
    bounds = borders(model, parts, keys)
    bounds = bounds.withColumnsRenamed({c: f"_b_{c}" for c in [*keys, "part"]})
    src = parts.select(*keys, F.col("part").cast("long").alias("part"), F.coalesce("text", F.lit("")).alias("body"))
    same = F.col("part") == F.col("_b_part")
    for c in keys:
        same &= F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    kind = pa.list_(pa.struct([("starts", pa.bool_()), ("role", pa.string()), ("text", pa.string())]))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrow_steps(batches, "body"):
            cells = []
            for body, enter, after, leave in zip(*(piece.column(k + i).to_pylist() for i in range(1, 5)), strict=True):
                lines = body.split("\n")
                found = shared.value.pieces(lines, shared.value.viterbi(lines, enter, after, leave), enter is not None)
                cells.append([{"starts": a, "role": r, "text": t} for a, r, t in found])
            yield pa.RecordBatch.from_arrays([*piece.columns[:k + 1], pa.array(cells, kind)], names=[*keys, "part", "pieces"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = [[{"role": r, "text": t} for r, t in joined((p["starts"], p["role"], p["text"]) for p in x)] for x in b.column(k).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(cells, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))], names=[*keys, "turns"])

    types = dict(src.dtypes)
    named = ", ".join(f"`{c}` {types[c]}" for c in keys)
    met = src.join(bounds, same).select(*keys, "part", "body", "enter", "after", "leave")
    found = met.mapInArrow(decode, f"{named}, part long, pieces array<struct<starts: boolean, role: string, text: string>>")
    ordered = found.groupBy(*keys).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "pieces"))), lambda x: x["pieces"])).alias("pieces"))
    return ordered.mapInArrow(whole, f"{named}, turns {TURNS}")


def rendered(turns: str = "turns") -> Column:
    """The canonical form: each turn between marks that name its role."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|im_start|>"), t["role"], F.lit("\n"), t["text"], F.lit("<|im_end|>"))), "\n")


def formatted(conversations: DataFrame) -> DataFrame:
    """The query: every conversation written as a transcript, parsed, and rendered."""
    parts = written(transcripts(conversations), "transcripts")
    model = fit(parts)
    done = parse(parts.where("not cut"), model, KEYS).unionAll(parse_parts(parts.where("cut"), model, KEYS))
    return done.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", lambda t: t["role"]), ",").alias("roles"), rendered().alias("chat"))
