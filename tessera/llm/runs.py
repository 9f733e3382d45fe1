"""Periodic runs of words, from the longest previous factors.

A run is a stretch of words with a smallest period q, words q apart being equal, that no neighbouring word extends;
those of at least ``exponent`` periods and ``shortest`` words are found, all of them, and exactly:

1. Suffix array: the words of a slice of texts are ranked, then blocks of 2, 4, 8, ... words by the ranks of their halves,
   until no block of a text occurs twice in it. Blocks that are alone leave the sort, which is then the suffix array.
   The ranks of all lengths are kept: how far two places agree, forward or backward, is read from them.
2. Longest previous factors: of the suffixes that follow in the array in either direction the nearest that begins earlier
   in its text; the larger of the two LCPs is the place's longest previous factor.
3. LZ blocks: the first begins with the text, each is as long as its place's factor, one word at least.
4. Boundaries: a run that meets a block's boundary, with its last word in the block after it, has a period q with
   (exponent - 1) q no longer than the block before and the block after together, as the block before would else have been
   longer. So at each boundary those periods are extended in both directions, in time proportional to the text.
5. All other runs lie inside a block, away from its ends. They are copies of runs where the block occurred before, and are
   copied from buckets of runs by their start, in the order of the text.

Texts are dealt to tasks by Spark as they lie; no shuffle. A slice takes a few times its text's bytes for each doubling.

Defined cases: a null text, one without words, and one shorter than ``shortest`` have no runs; repeated rows are worked on
again each; an empty table gives an empty result; a text of any length is one sequence; extra columns pass
through, but ``runs`` and ``collapsed`` replace columns of these names. Words are runs of anything but ASCII white space.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .bpe import slices
from .common import let, ship, trim, words

SHORTEST = 6
EXPONENT = 4
#: Bytes of text worked on at once, one text at least.
SLICE = 2 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ADDED = {"runs": "array<struct<start bigint, length bigint, period bigint>>", "collapsed": "string"}


def split_words(column):
    """The words of an Arrow text column end to end, as an Arrow binary array, and where each text's begin and end."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:-1]
    end[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(begin)
    ends = np.concatenate([[0], np.cumsum(np.flatnonzero(end) + 1 - starts)])
    parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[solid])])
    return parts, np.searchsorted(starts, offsets)


class Ranks:
    """Ranks of blocks of 1, 2, 4, ... words within their text, and the suffix array."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray):
        n = len(ids)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        stop = np.repeat(bounds[1:], np.diff(bounds))
        key = text * (int(ids.max(initial=0)) + 1) + ids
        self.order = np.argsort(key, kind="stable")
        rank = np.full(n + 1, -1, np.int32)  # one more: what is past the last text equals nothing
        at, items, key = np.arange(n), self.order, key[self.order]
        self.levels: list[np.ndarray] = []
        while True:
            first = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
            rank[items] = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
            self.levels.append(rank.copy())
            last = np.concatenate([first[1:], [True]])[: len(key)]
            at = at[~(first & last)]
            if not len(at):
                return
            h = 1 << (len(self.levels) - 1)
            items = self.order[at]
            key = rank[items].astype(np.int64) * (n + 1) + np.where(items + h < stop[items], rank[np.minimum(items + h, n)] + 1, 0)
            by = np.argsort(key)
            items, key = items[by], key[by]
            self.order[at] = items

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree from places i and j on; i and j differ."""
        i, j, was = i.copy(), j.copy(), i
        for k in reversed(range(len(self.levels))):
            same = self.levels[k][i] == self.levels[k][j]
            i += same << k
            j += same << k
        return i - was

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree before places i and j, where i is the smaller."""
        i, j, was = i.copy(), j.copy(), i
        for k in reversed(range(len(self.levels))):
            a, b = i - (1 << k), j - (1 << k)
            same = (self.levels[k][np.maximum(a, 0)] == self.levels[k][np.maximum(b, 0)]) & (a >= 0)
            i -= same << k
            j -= same << k
        return was - i


def previous_factors(ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """For each place the length of the longest factor that begins there and also earlier in its text, and where."""
    order, n = ranks.order, len(ranks.order)
    word = ranks.levels[0][order]  # suffixes that begin with one word lie together
    length, source = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for step in (-1, 1):
        to = np.arange(n) + step
        inside = (to >= 0) & (to < n)
        inside[inside] = word[to[inside]] == word[inside]
        to[~inside] = -1
        live = np.flatnonzero(inside)
        live = live[order[to[live]] > order[live]]
        while len(live):  # who is passed over has its own pointer to follow
            to[live] = further = to[to[live]]
            live = live[further >= 0]
            live = live[order[to[live]] > order[live]]
        found = np.flatnonzero(to >= 0)
        i, j = order[found], order[to[found]]
        common = ranks.forward(i, j)
        better = common > length[i]
        length[i[better]], source[i[better]] = common[better], j[better]
    return length, source


def blocks(length: np.ndarray) -> np.ndarray:
    """Where the LZ blocks of all texts begin; no factor leaves its text."""
    follow, out, i = (np.arange(len(length)) + np.maximum(length, 1)).tolist(), [], 0
    while i < len(follow):
        out.append(i)
        i = follow[i]
    return np.array(out, np.int64)


def _ranges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """1 to each count, and whose they are."""
    whose = np.repeat(np.arange(len(counts)), counts)
    return np.arange(1, len(whose) + 1) - np.repeat(np.cumsum(counts) - counts, counts), whose


def _at_boundaries(ranks: Ranks, start: np.ndarray, bounds: np.ndarray, shortest: int, exponent: int) -> np.ndarray:
    """Rows (start, stop, period) of the runs that meet a boundary of a block."""
    n, first = len(ranks.order), bounds[:-1][np.diff(bounds) > 0]
    size = np.diff(np.append(start, n))
    opens = np.isin(start, first)
    before = np.where(opens, 0, np.concatenate([[0], size[:-1]]))
    # The end of a text is a boundary with nothing after it.
    closes = np.append(np.flatnonzero(opens)[1:], len(start)) - 1
    b = np.concatenate([start, start[closes] + size[closes]])
    before, after = np.concatenate([before, size[closes]]), np.concatenate([size, np.zeros(len(closes), np.int64)])
    since = b - np.concatenate([np.repeat(first, np.diff(np.append(np.flatnonzero(opens), len(start)))), first])
    level = ranks.levels[0]
    found = []
    for to_left in (True, False):
        q, k = _ranges(np.minimum((before + after) // (exponent - 1), since) if to_left else after // (exponent - 1))
        i = b[k] - q if to_left else b[k]
        j = i + q
        near = (level[i] == level[j]) | (i > 0) & (level[np.maximum(i - 1, 0)] == level[j - 1])
        q, i, j = q[near], i[near], j[near]
        left, right = ranks.backward(i, j), ranks.forward(i, j)
        full = (left + right >= (exponent - 1) * q) & (left + right + q >= shortest)
        found.append(np.stack([i - left, j + right, q], 1)[full])
    rows = np.concatenate(found)
    rows = rows[np.lexsort(rows.T[::-1])]
    fresh = np.ones(len(rows), bool)  # of a stretch the smallest period
    fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[fresh]


def _copied(known: list[tuple[int, int, int]], spans: list[tuple[int, int, int]], shortest: int) -> list[tuple[int, int, int]]:
    """All runs of one text: those known, and their copies inside blocks (start, stop, source)."""
    bucket: dict[int, list[tuple[int, int]]] = {}
    for s, t, q in known:
        bucket.setdefault(s, []).append((t, q))
    for a, z, source in spans:
        back = a - source
        for s in range(a + 1, z - shortest):
            for t, q in bucket.get(s - back, ()):
                if t + back < z:
                    bucket.setdefault(s, []).append((t + back, q))
    return sorted((s, t, q) for s, ends in bucket.items() for t, q in ends)


def find(ids: np.ndarray, bounds: np.ndarray, shortest: int = SHORTEST, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """For each text, given as numbers of words, its runs as (start, length, period) by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    if not len(ids):
        return out
    ranks = Ranks(ids, bounds)
    length, source = previous_factors(ranks)
    start = blocks(length)
    rows = _at_boundaries(ranks, start, bounds, shortest, exponent)
    stop = np.append(start[1:], len(ids))
    wide = np.flatnonzero(stop - start >= shortest + 2)
    owner, holder = np.searchsorted(bounds, rows[:, 0], "right") - 1, np.searchsorted(bounds, start[wide], "right") - 1
    for text in np.unique(owner).tolist():
        known = [tuple(r) for r in rows[np.searchsorted(owner, text) : np.searchsorted(owner, text, "right")].tolist()]
        inner = wide[np.searchsorted(holder, text) : np.searchsorted(holder, text, "right")]
        spans = list(zip(start[inner].tolist(), stop[inner].tolist(), source[start[inner]].tolist(), strict=True))
        base = int(bounds[text])
        out[text] = sorted((s - base, t - s, q) for s, t, q in _copied(known, spans, shortest))
        out[text].sort(key=lambda r: (r[0], r[2]))
    return out


def _joined(parts, keep: np.ndarray, bounds: np.ndarray):
    """The kept words of each text joined by one space, as an Arrow text column."""
    import pyarrow as pa

    ends = np.frombuffer(parts.buffers()[1], np.int64)[: len(parts) + 1]
    size = np.diff(ends)
    data = np.frombuffer(parts.buffers()[2] or b"", np.uint8)[np.repeat(keep, size)]
    size = size[keep] + 1  # and a space after each
    stops = np.cumsum(size)
    total = int(stops[-1]) if len(stops) else 0
    out = np.full(total, 32, np.uint8)
    solid = np.ones(total, bool)
    solid[stops - 1] = False
    out[solid] = data
    many = np.concatenate([[0], np.cumsum(keep)])[bounds]
    at = np.concatenate([[0], stops])[many]
    # The space after a text's last word goes.
    out = np.delete(out, stops[many[1:][np.diff(many) > 0] - 1] - 1)
    at = at - np.concatenate([[0], np.cumsum(np.diff(many) > 0)])
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def _worked(column, shortest: int, exponent: int):
    """The columns ``runs`` and ``collapsed`` of a slice of texts."""
    import pyarrow as pa

    parts, bounds = split_words(column)
    ids = parts.dictionary_encode().indices.to_numpy().astype(np.int64)
    runs = find(ids, bounds, shortest, exponent)
    drop = np.zeros(len(ids) + 1, np.int64)
    flat = np.array([(s + b, n, q) for r, b in zip(runs, bounds.tolist(), strict=False) for s, n, q in r], np.int64).reshape(-1, 3)
    np.add.at(drop, flat[:, 0] + flat[:, 2], 1)
    np.add.at(drop, flat[:, 0] + flat[:, 1], -1)
    held = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
    whose = np.repeat(bounds[:-1], np.diff(held))
    rows = pa.StructArray.from_arrays([pa.array(flat[:, 0] - whose), pa.array(flat[:, 1]), pa.array(flat[:, 2])], names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(held), rows), _joined(parts, np.cumsum(drop[:-1]) == 0, bounds)


def periodic_runs(docs: DataFrame, text: str = "text", shortest: int = SHORTEST, exponent: int = EXPONENT) -> DataFrame:
    """docs with ``runs`` (start, length and period in words, by start, then period) and ``collapsed``, the words joined by
    one space without those that any run contains after its first period."""
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    ship(docs.sparkSession)
    docs = docs.drop(*(n for n in _ADDED if n != text))
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(", ".join(f"{n} {kind}" for n, kind in _ADDED.items())).fields])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for s in slices(column, SLICE):
                part = batch.slice(s.start, s.stop - s.start)
                yield pa.RecordBatch.from_arrays([*part.columns, *_worked(part.column(batch.schema.get_field_index(text)), shortest, exponent)], names=[*part.schema.names, *_ADDED])
        trim()

    return docs.mapInArrow(run, schema)


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or for every tenth id one that repeats a part of it: what the query looks for."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
        return F.when(n > 0, F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, a + F.pmod(i - a, p)))), " "))

    return F.when(doc_id.isNotNull() & (h % 10 == 0), F.coalesce(let(words(text), repeated), F.lit(""))).otherwise(text)


def digests(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts, the longest run (ties: smallest start, then period) and digests of what periodic_runs found."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    out = found.select(doc_id, F.size("runs").cast("long").alias("n_runs"), longest.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length = -F.col("best.l")
    return out.select(
        doc_id, "n_runs", F.col("best.s").alias("start"), length.alias("length"), F.col("best.p").alias("period"), F.floor(1000 * length / F.col("best.p")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )
