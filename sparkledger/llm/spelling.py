"""Operator 11: spelling variants by dynamic programming over sorted word lists.

Words are counted over whole texts; those of at least LEAST_LENGTH code points and LEAST_COUNT
occurrences are the vocabulary.  Two words are near if one inserted, deleted or replaced
code point makes one of the other.

1. Of two near words, the shorter of length L, one edit leaves the first L // 2 code
   points alone or the last L // 2.  So words meet in groups by (L, first half)
   and, reversed, by (L, last half): each word in its own length's groups and, as
   the longer one, in those of the length below.  Pairs with both halves equal count
   in the first only, so no pair is found twice.
2. Groups of more than BLOCK words (or CELL_CHARS code points) are cut into blocks by a
   hash, and every pair of blocks is a cell of its own, so no cell outgrows a task.
3. A cell's words are a sorted list.  For a query word the list is scanned in order
   with the edit matrix cut to the three cells around its diagonal.  The rows of the prefix
   shared with the word before (the adjacent LCP) are used again; once a row's least entry
   exceeds one edit, all following words that share this prefix are skipped.  All queries of
   many cells scan in lockstep, one list word each at a time, on arrays.

The form of a word is its most frequent near word (ties: least in code-point order) if that
is at least RATIO times as frequent.  Frequencies grow along forms, so they end in a root.

Null and empty texts have no words; a null id reads as an empty one; rows that repeat a
doc_id or a whole row count like any other.  An empty table has no words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_steps, ragged, written

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
#: One in this many (document, run) pairs loses a code point before words are counted.
SLIP = 199
#: Words of a block, and code points of a block of long words.
BLOCK = 2048
CELL_CHARS = 1 << 20
#: Code points of the cells that a task scans in one lockstep.
STEP = 1 << 21
#: Distinct words, and their code points, that a task counts before it passes them on.
FLUSH_WORDS, FLUSH_CHARS = 100_000, 4_000_000
FAR = 2


def runs_pattern(least: int) -> regex.Pattern:
    return regex.compile("[A-Za-zÀ-ÿ]{%d,}" % least)


def _count(least: int, slip: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A shorter run gives no word: it is greedy, so a run of least code points matches whole.
        find = runs_pattern(least).findall
        held: Counter[str] = Counter()
        chars = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for piece in arrow_steps(batches, "body"):
            for ident, body in zip(piece.column(0).to_pylist(), piece.column(1), strict=True):
                seed = crc32(f"{ident}:".encode())
                # bytes.lower() changes A-Z only.
                for word, n in Counter(find(body.as_buffer().to_pybytes().lower().decode())).items():
                    h = crc32(word.encode(), seed)
                    if h % slip == 0:
                        k = h % len(word)
                        word = word[:k] + word[k + 1:]
                        if len(word) < least:
                            continue
                    if word not in held:
                        chars += len(word)
                    held[word] += n
                if len(held) > FLUSH_WORDS or chars > FLUSH_CHARS:
                    yield flush()
                    chars = 0
        if held:
            yield flush()

    return run


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT, slip: int = SLIP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of every word frequent and long enough."""
    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("ident"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    counted = texts.mapInArrow(_count(least, slip), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def cells(vocab: DataFrame, block: int = BLOCK, cell_chars: int = CELL_CHARS, least: int = LEAST_LENGTH) -> DataFrame:
    """(size, cell, word, turned, is_query, is_listed): words of a cell, reversed where ``turned``."""
    turns = F.explode(F.array(*[F.struct(F.lit(t).alias("turned"), F.lit(s).alias("short")) for t in (False, True) for s in (True, False)])).alias("t")
    rows = vocab.select("word", turns).select("t.turned", "t.short", F.when(F.col("t.turned"), F.reverse("word")).otherwise(F.col("word")).alias("word"),
                                              (F.length("word") - F.when(F.col("t.short"), 0).otherwise(1)).alias("size"))
    rows = rows.where(F.col("size") >= least).withColumn("half", F.substring("word", F.lit(1), F.floor(F.col("size") / 2).cast("int")))
    group = ["turned", "size", "half"]
    blocks = F.ceil(F.greatest(F.col("n") / block, F.col("n") * (F.col("size") + 2) / cell_chars)).cast("int")
    # Written, so that its size is known where it is joined.
    hot = written(rows.groupBy(*group).agg(F.count("*").alias("n")).select(*group, blocks.alias("nb")).where("nb > 1"), "hot_groups")
    rows = rows.join(hot, group, "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("word"), F.col("nb")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    # A cell (i, j) holds the queries of block i and the list of block j.
    same = F.col("own") == F.col("other")
    as_list = F.struct(F.col("other").alias("i"), F.col("own").alias("j"), (same & F.col("short")).alias("is_query"), F.lit(True).alias("is_listed"))
    as_query = F.struct(F.col("own").alias("i"), F.col("other").alias("j"), F.lit(True).alias("is_query"), F.lit(False).alias("is_listed"))
    rows = rows.select("*", F.explode(F.when(F.col("short") & ~same, F.array(as_list, as_query)).otherwise(F.array(as_list))).alias("c"))
    return rows.select("size", F.xxhash64(*group, "c.i", "c.j").alias("cell"), "word", "turned", "c.is_query", "c.is_listed")


def word_matrix(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(code points padded with zeros, lengths)."""
    size = np.array([len(w) for w in words], np.int64)
    out = np.zeros((len(words), width), np.uint32)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    out[np.repeat(np.arange(len(words)), size), ragged(np.zeros(len(words), np.int64), size)] = points
    return out, size


def scan(points: np.ndarray, size: np.ndarray, first: np.ndarray, count: np.ndarray, query: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, list row) one edit apart.

    ``points``/``size`` are words; list ``k`` is the rows ``first[k]`` and the ``count[k] - 1`` after it,
    sorted; query row ``query[i]`` scans list ``lists[i]``.
    """
    order = np.argsort(-count[lists], kind="stable")  # longest lists first: the active queries are a prefix
    query, lists = query[order], lists[order]
    width = points.shape[1]
    # Code points shared by each word and the one before it.
    lcp = np.zeros(len(points), np.int64)
    if len(points) > 1:
        lcp[1:] = np.minimum((points[1:] == points[:-1]).cumprod(1, dtype=np.uint8).sum(1, dtype=np.int64), np.minimum(size[1:], size[:-1]))
    lcp[first[count > 0]] = 0
    rows = np.full((width + 1, len(query), 3), FAR, np.int8)
    rows[0, :, 1], rows[0, :, 2] = 0, 1
    # The query's code points with a zero on either side: column j - 1 is at j.
    mine = np.zeros((len(query), width + 2), np.uint32)
    mine[:, 1:-1] = points[query]
    dead = np.full(len(query), width + 2)
    out_q, out_x = [], []
    remaining = count[lists]
    for step in range(int(remaining[0]) if len(query) else 0):
        active = int(np.searchsorted(-remaining, -step, side="left"))
        x = first[lists[:active]] + step
        shared = lcp[x]
        todo = np.flatnonzero(shared < dead[:active])  # the others share a prefix that is too far already
        dead[todo] = width + 2
        depth = int(shared[todo].min()) + 1 if len(todo) else 1
        live = todo
        while len(live):
            live = live[size[x[live]] >= depth]
            at = live[shared[live] < depth]
            if len(at):
                c = points[x[at], depth - 1]
                p = rows[depth - 1, at]
                new = np.empty((len(at), 3), np.int8)
                new[:, 0] = np.minimum(p[:, 0] + (mine[at, depth - 1] != c), p[:, 1] + 1)
                new[:, 1] = np.minimum(np.minimum(p[:, 1] + (mine[at, depth] != c), p[:, 2] + 1), new[:, 0] + 1)
                new[:, 2] = np.minimum(p[:, 2] + (mine[at, depth + 1] != c) if depth + 1 < width + 2 else FAR, new[:, 1] + 1)
                np.minimum(new, FAR, out=new)
                rows[depth, at] = new
                gone = at[new.min(1) >= FAR]
                dead[gone] = depth
                if len(gone):
                    live = live[dead[live] > depth]
            depth += 1
        done = todo[dead[todo] > width]
        side = size[query[done]] - size[x[done]] + 1
        ok = (side >= 0) & (side <= 2)
        done, side = done[ok], side[ok]
        hit = done[rows[size[x[done]], done, side] == 1]
        out_q.append(query[hit])
        out_x.append(x[hit])
    empty = np.zeros(0, np.int64)
    return (np.concatenate(out_q), np.concatenate(out_x)) if out_q else (empty, empty)


def near_in_cells(cell: np.ndarray, words: list[str], turned: np.ndarray, is_query: np.ndarray, is_listed: np.ndarray) -> tuple[list[str], list[str]]:
    """Near pairs (query, listed word) of whole cells whose rows are sorted by (cell, word)."""
    start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    of = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(cell))))
    listed = np.flatnonzero(is_listed)
    count = np.bincount(of[listed], minlength=len(start))
    busy = (count[of] > 0) & is_query & ~((count[of] == 1) & is_listed)  # a word alone with itself
    query = np.flatnonzero(busy)
    if not len(query):
        return [], []
    # Lists first, queries that are not listed after them.
    alone = query[~is_listed[query]]
    rows = np.concatenate([listed, alone])
    place = np.empty(len(cell), np.int64)
    place[rows] = np.arange(len(rows))
    points, size = word_matrix([words[i] for i in rows], max(len(words[i]) for i in rows))
    a, b = scan(points, size, np.cumsum(count) - count, count, place[query], of[query])
    # Reversed pairs whose other half is the same too were found by that half.
    half = size[a] // 2
    k = np.arange(points.shape[1])
    back = size[:, None] - 1 - k  # place of the k-th code point from the end
    turn = turned[rows[a]]
    tail = lambda i: np.take_along_axis(points[i], np.maximum(back[i], 0), 1)
    again = np.zeros(len(a), bool)
    again[turn] = ((tail(a[turn]) == tail(b[turn])) | (k >= half[turn][:, None])).all(1)
    a, b = rows[a[~again]], rows[b[~again]]
    name = lambda i: words[i][::-1] if turned[i] else words[i]
    return [name(i) for i in a], [name(i) for i in b]


def _near(step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(cols: list[pa.Array]) -> Iterator[pa.RecordBatch]:
            cell, word, turned, is_query, is_listed = cols
            flags = (c.to_numpy(zero_copy_only=False) for c in (turned, is_query, is_listed))
            a, b = near_in_cells(cell.to_numpy(), word.to_pylist(), *flags)
            # Words of one length query each other; a longer one is only listed.
            longer = [(y, x) for x, y in zip(a, b, strict=True) if len(y) > len(x)]
            pairs = [*zip(a, b, strict=True), *longer]
            for i in range(0, len(pairs), 100_000):
                x, y = zip(*pairs[i:i + 100_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()), pa.array(y, pa.string())], names=["word", "near"])

        held: list[pa.RecordBatch] = []
        chars = 0
        for batch in batches:
            # Cells come in order of size; a long batch is cut where a cell ends.
            while batch.num_rows:
                room = max(1, step // (int(batch.column(0)[0].as_py()) + 2))
                part, batch = batch.slice(0, room), batch.slice(room)
                held.append(part)
                chars += sum(part.column(0).to_numpy().astype(np.int64) + 2)
                if chars < step:
                    continue
                cols = [pa.concat_arrays([h.column(i) for h in held]) for i in range(1, 6)]
                cell = cols[0].to_numpy()
                change = np.flatnonzero(cell[1:] != cell[:-1])
                if not len(change):
                    continue
                cut = int(change[-1]) + 1  # the last cell may go on
                yield from found([c.slice(0, cut) for c in cols])
                rest = pa.concat_arrays([h.column(0) for h in held]).slice(cut)
                held = [pa.RecordBatch.from_arrays([rest, *[c.slice(cut) for c in cols]], names=part.schema.names)]
                chars = sum(rest.to_numpy().astype(np.int64) + 2)
        if held:
            yield from found([pa.concat_arrays([h.column(i) for h in held]) for i in range(1, 6)])

    return run


def near_words(vocab: DataFrame, block: int = BLOCK, cell_chars: int = CELL_CHARS, least: int = LEAST_LENGTH, step: int = STEP) -> DataFrame:
    """(word, near): every pair of near words of ``vocab(word)``, in both directions."""
    dealt = cells(vocab, block, cell_chars, least).repartition("size", "cell").sortWithinPartitions("size", "cell", "word")
    return dealt.select("size", "cell", "word", "turned", "is_query", "is_listed").mapInArrow(_near(step), "word string, near string")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of every word of ``forms(word, form)``, by doubling."""
    at = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while at.where("moved").limit(1).count():  # at most the logarithm of the longest chain
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = written(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return at.select("word", "root")


def variants(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT, ratio: int = RATIO, slip: int = SLIP,
             block: int = BLOCK, cell_chars: int = CELL_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The query: word, form, root, n, n_near, form_n of every word of the vocabulary."""
    vocab = written(vocabulary(docs, least, count, slip, id_col, text_col), "vocabulary")
    pairs = near_words(vocab.select("word"), block, cell_chars, least)
    named = pairs.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = named.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("top"))
    rows = vocab.join(best, "word", "left").withColumn("ok", -F.col("top.least") >= ratio * F.col("n"))
    rows = written(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("ok"), F.col("top.near")).alias("form"),
                               F.when(F.col("ok"), -F.col("top.least")).alias("form_n")), "variants")
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
