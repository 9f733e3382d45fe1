"""Exact n-gram Jaccard join by vertical partitioning.

Two documents link when their sets of distinct 5-word shingles have a Jaccard similarity of at least
THRESHOLD; the result is each document's connected component.

1. Every document becomes a set of 64-bit shingle hashes; documents with equal sets form a class, and classes
   are joined instead of documents, so groups of exact copies cost one member.
2. The global order of shingles is cut into fragments by hash. A fragment gets every class's shingles of that
   range, counts in how many classes each occurs, and keeps the shared ones only. There are as many fragments as the
   texts' bytes ask for, so that each stays small. What is shared goes back to buckets of classes, many classes
   packed in a row, as many buckets as fragments.
3. A class of n shingles can only link with one that shares at least ceil(0.75 n) of them, so among its
   n - ceil(0.75 n) + 1 rarest shingles there is a common one. If fewer are shared at all, the class is done;
   otherwise its rarest shared ones are its postings (rare first in one global order, by all classes' counts).
4. The classes of a posting list have a hashed order, another one in each list. The first of them, the leaders, are
   compared with all that follow, what links is contracted to components, the leaders leave, and lists that are
   within one component are done. Each round takes LEADERS times as many leaders as the one before, so few rounds
   end any list, and lists of near copies end in the first ones with one pair an entry. No pair is skipped
   unless its classes are already connected. A list passes a pair on only if its classes could still link were
   this shingle the first that they share: the overlap is then at most what follows in the shorter rest.
5. Pairs are verified with exact counts: the shared shingles of the two classes are intersected part by part (a part
   is every PARTS-th fragment), the partial overlaps summed per pair.

Defined cases: null text, and text without words, has an empty set and is linked with nothing; a text of 1 to 4
words is one shingle; repeated rows are copies of each other; rows with a null id take part and keep a null
id, and a component holding only such rows has a null component; an empty table gives an empty result; a text of any
length is one set; of docs' other columns near_groups reads none, and keep_one passes all on. The sets are compared by
64-bit hashes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, materialize, ship, trim
from .components import components

THRESHOLD = 75  # of 100
SHINGLE = 5
#: Bytes of text whose shingles share a fragment, over a million shingles.
FRAGMENT_BYTES = 8 << 20
#: Parts in which overlaps are counted.
PARTS = 4
#: Times as many leaders of a list in each round as in the round before.
LEADERS = 4
#: Bytes of text for each task of the steps that work on shared shingles and their lists.
TASK_BYTES = 4 << 20
#: Bytes of text hashed at once.
CHUNK = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (_BASE, _INVERSE)]
    return _powers


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> list[np.ndarray]:
    """For texts laid end to end as UTF-8 bytes, with their offsets: the sorted distinct shingle hashes of each."""
    n_docs, size = len(offsets) - 1, int(offsets[-1])
    if size == 0:
        return [np.zeros(0, np.uint64)] * n_docs
    low = _FOLD[data[:size]]
    solid = low != 32
    first = np.zeros(size + 1, bool)
    first[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | first[1:size]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | first[1:size]
    starts, stops = np.flatnonzero(start), np.flatnonzero(stop) + 1
    up, down = _power_tables(size + 1)
    total = np.zeros(size + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:size], out=total[1:])
    word = _mix((total[stops] - total[starts]) * down[starts])
    bounds = np.searchsorted(starts, offsets)
    shingle = word.copy()
    for k in range(1, width):
        shingle = shingle * _BASE
        shingle[: len(word) - k] += word[k:]
    shingle = _mix(shingle)
    out = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        if b - a >= width:
            s = np.sort(shingle[a : b - width + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            h = np.array([b - a], np.uint64)
            for k in range(a, b):
                h = _mix(h * _BASE + word[k : k + 1])
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


_CUT = "frag int, ids array<bigint>, tags array<bigint>, classes binary, sizes binary, counts binary, shingles binary"


def _packed(counts: np.ndarray) -> bytes:
    return counts.astype(np.int64 if counts.max(initial=0) > 65535 else np.uint16).tobytes()


def _counts(packed: list[bytes], classes: list[bytes]) -> np.ndarray:
    return np.concatenate([np.frombuffer(n, np.int64 if len(n) == len(c) else np.uint16).astype(np.int64) for n, c in zip(packed, classes, strict=True)])


def _range(values: np.ndarray, ranges: int) -> np.ndarray:
    """Which of so many equal ranges 64-bit values lie in."""
    return ((values.view(np.uint64) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)


def _fragment_rows(fragments: int):
    """Batches of (id, tag, text) to rows for the fragments. Rows with ids carry documents, dealt to any fragment:
    their ids, tags, classes and set sizes; the others carry, for each class that this task meets first, its set size
    and its shingles of the fragment."""

    def run(batches):
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext

        from .bpe import slices

        seen: set[int] = set()
        turn = TaskContext.get().partitionId() * 7919
        for batch in batches:
            texts = batch.column(2).fill_null("")
            for part in slices(texts, CHUNK):
                col = texts[part]
                offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
                data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
                sets = shingle_sets(data, offsets - offsets[0])
                classes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) if len(s) else 0 for s in sets], np.uint64).astype(np.int64)
                sizes = np.array([len(s) for s in sets], np.int64)
                fresh = []
                for i, (c, n) in enumerate(zip(classes.tolist(), sizes.tolist(), strict=True)):
                    if n and c not in seen:
                        seen.add(c)
                        fresh.append(i)
                turn += 1
                ids, tags = ([batch.column(k)[part].to_pylist()] for k in (0, 1))
                frags, owners, totals, counts, shingles = [turn % fragments], [classes.tobytes()], [sizes.tobytes()], [None], [None]
                if fresh:
                    values = np.concatenate([sets[i] for i in fresh])
                    owner = np.repeat(np.arange(len(fresh)), sizes[fresh])
                    frag = _range(values, fragments)
                    order = np.argsort(frag, kind="stable")
                    there, starts = np.unique(frag[order], return_index=True)
                    raw, owner = np.ascontiguousarray(values[order].astype("<u8")), owner[order]
                    of, total = classes[np.array(fresh)], sizes[np.array(fresh)]
                    for f, a, b in zip(there.tolist(), starts.tolist(), [*starts.tolist()[1:], len(raw)], strict=True):
                        new = np.flatnonzero(np.concatenate([[True], owner[a + 1 : b] != owner[a : b - 1]]))
                        who = owner[a:b][new]
                        frags.append(f)
                        owners.append(of[who].tobytes())
                        totals.append(total[who].astype(np.uint32).tobytes())
                        counts.append(_packed(np.diff(np.append(new, b - a))))
                        shingles.append(raw[a:b].tobytes())
                rest = [None] * (len(frags) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(frags, pa.int32()), *(pa.array(x + rest, pa.list_(pa.int64())) for x in (ids, tags)), *(pa.array(x, pa.binary()) for x in (owners, totals, counts, shingles))],
                    names=["frag", "ids", "tags", "classes", "sizes", "counts", "shingles"],
                )
        trim()

    return run


_COUNTED = "kind int, id bigint, tag bigint, cls bigint, n bigint, bucket int, part int, classes binary, sizes binary, counts binary, keys binary, ranks binary"


def _count_fragment(buckets: int):
    """One fragment's rows to documents (kind 0) and, for each bucket of classes, their shared shingles with the
    logarithm of the number of classes that hold them (kind 1)."""

    def run(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        binary = ("classes", "sizes", "counts", "keys", "ranks")
        schema = pa.schema([("kind", pa.int32()), *((c, pa.int64()) for c in ("id", "tag", "cls", "n")), ("bucket", pa.int32()), ("part", pa.int32()), *((c, pa.binary()) for c in binary)])
        docs, segments = table.filter(pc.is_valid(table["ids"])), table.filter(pc.is_null(table["ids"]))
        out = []
        if len(docs):
            cls0, n0 = (np.frombuffer(b"".join(docs[c].to_pylist()), np.int64) for c in ("classes", "sizes"))
            k = len(cls0)
            ids, tags = (docs[c].combine_chunks().flatten() for c in ("ids", "tags"))
            out.append(pa.Table.from_arrays([pa.array(np.zeros(k, np.int32)), ids, tags, pa.array(cls0, mask=n0 == 0), pa.array(n0), *(pa.nulls(k, f.type) for f in list(schema)[5:])], schema=schema))
        if len(segments):
            frag, owners = segments["frag"][0].as_py(), segments["classes"].to_pylist()
            cls, counts = np.frombuffer(b"".join(owners), np.int64), _counts(segments["counts"].to_pylist(), owners)
            sizes = np.frombuffer(b"".join(segments["sizes"].to_pylist()), np.uint32)
            value = np.frombuffer(b"".join(segments["shingles"].to_pylist()), "<u8")
            # In the order of buckets; of a class that other tasks have met too, once.
            first = np.unique(cls, return_index=True)[1]
            first = first[np.argsort(_range(cls[first], buckets), kind="stable")]
            starts = (np.cumsum(counts) - counts)[first]
            cls, counts, sizes = cls[first], counts[first], sizes[first]
            ends = np.cumsum(counts)
            value = value[np.arange(ends[-1]) + np.repeat(starts - ends + counts, counts)]
            order = np.argsort(value, kind="stable").astype(np.uint32)
            sorted_ = value[order]
            runs = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
            del sorted_
            runs = np.diff(np.append(runs, len(value))).astype(np.uint32)
            df = np.empty(len(value), np.uint32)
            df[order] = np.repeat(runs, runs)
            del order
            shared = df > 1
            held = np.bincount(np.repeat(np.arange(len(cls)), counts)[shared], minlength=len(cls))
            keys, ranks = value[shared], np.log2(df[shared].astype(np.float64)).astype(np.int8)
            some = held > 0
            cls, sizes, held = cls[some], sizes[some], held[some]
            ends = np.concatenate([[0], np.cumsum(held)])
            bucket, at = np.unique(_range(cls, buckets), return_index=True)
            rows = {c: [] for c in binary}
            for a, b in zip(at.tolist(), [*at.tolist()[1:], len(cls)], strict=False):
                for c, x in (("classes", cls[a:b]), ("sizes", sizes[a:b]), ("keys", keys[ends[a] : ends[b]]), ("ranks", ranks[ends[a] : ends[b]])):
                    rows[c].append(x.tobytes())
                rows["counts"].append(_packed(held[a:b]))
            m = len(bucket)
            out.append(pa.Table.from_arrays([pa.array(np.ones(m, np.int32)), *(pa.nulls(m, pa.int64()),) * 4, pa.array(bucket), pa.array(np.full(m, frag % PARTS, np.int32)), *(pa.array(rows[c], pa.binary()) for c in binary)], schema=schema))
        trim()
        return pa.concat_tables(out)

    return run


_LISTED = "kind int, cls bigint, n bigint, part int, keys array<bigint>, key bigint, pos bigint"


def _prefixes(table):
    """One bucket's classes, but those that share too little to link: their shared shingles by part (kind 0) and
    their postings (kind 1)."""
    import pyarrow as pa

    schema = pa.schema([("kind", pa.int32()), ("cls", pa.int64()), ("n", pa.int64()), ("part", pa.int32()), ("keys", pa.list_(pa.int64())), ("key", pa.int64()), ("pos", pa.int64())])
    owners = table["classes"].to_pylist()
    counts = _counts(table["counts"].to_pylist(), owners)
    cls, entry = np.unique(np.frombuffer(b"".join(owners), np.int64), return_inverse=True)
    n = np.zeros(len(cls), np.int64)
    n[entry] = np.frombuffer(b"".join(table["sizes"].to_pylist()), np.uint32)
    part = np.repeat(np.array(table["part"].to_pylist(), np.int32), [len(x) // 8 for x in owners])
    held = np.bincount(entry, counts, len(cls)).astype(np.int64)
    # need = how many of the class's shared shingles belong to its prefix; the others of the prefix are its own.
    need = held + 1 - -(-THRESHOLD * n // 100)
    lives = np.repeat((need > 0)[entry], counts)
    owner, part = np.repeat(entry, counts)[lives], np.repeat(part, counts)[lives]
    keys = np.frombuffer(b"".join(table["keys"].to_pylist()), np.int64)[lives]
    ranks = np.frombuffer(b"".join(table["ranks"].to_pylist()), np.int8)[lives]
    out = []
    if len(keys):
        order = np.lexsort((part, owner))
        new = np.concatenate([[True], (owner[order][1:] != owner[order][:-1]) | (part[order][1:] != part[order][:-1])])
        at = np.flatnonzero(new)
        whose, m = owner[order][at], len(at)
        lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(keys)).astype(np.int32)), pa.array(keys[order]))
        out.append(pa.Table.from_arrays([pa.array(np.zeros(m, np.int32)), pa.array(cls[whose]), pa.array(n[whose]), pa.array(part[order][at]), lists, *(pa.nulls(m, pa.int64()),) * 2], schema=schema))
        order = np.lexsort((keys, ranks, owner))
        whose = owner[order]
        first = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]]))
        place = np.arange(len(whose)) - np.repeat(first, np.diff(np.append(first, len(whose))))
        rare = place < need[whose]
        whose, place, m = whose[rare], place[rare], int(rare.sum())
        out.append(pa.Table.from_arrays([pa.array(np.ones(m, np.int32)), pa.array(cls[whose]), pa.array(n[whose]), pa.nulls(m, pa.int32()), pa.nulls(m, pa.list_(pa.int64())), pa.array(keys[order][rare]), pa.array((n - held)[whose] + place)], schema=schema))
    trim()
    return pa.concat_tables(out) if out else schema.empty_table()


def _verified(pairs: DataFrame, segments: DataFrame, size: int) -> DataFrame:
    """Of pairs (a, na, b, nb), those that link: overlaps are counted part by part and summed."""
    left = segments.select(F.col("cls").alias("a"), "part", F.col("keys").alias("ka"))
    right = segments.select(F.col("cls").alias("b"), F.col("part").alias("pb"), F.col("keys").alias("kb"))
    met = few(pairs.join(left, "a"), size, TASK_BYTES).join(right, (pairs["b"] == right["b"]) & (F.col("part") == F.col("pb"))).drop(right["b"])
    sums = few(met, size, TASK_BYTES).select("a", "b", "na", "nb", F.size(F.array_intersect("ka", "kb")).cast("long").alias("o")).groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("o"))
    return sums.where(F.lit(100) * F.col("o") >= F.lit(THRESHOLD) * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def _near(na: str, pa: str, nb: str, pb: str):
    """The length filter, and the positional one: p shingles of a class come before the one that the two share.
    Of a pair that links, the first common shingle passes it; other lists need not."""
    most = F.least(F.col(na) - F.col(pa), F.col(nb) - F.col(pb))
    return (F.lit(100) * F.least(na, nb) >= F.lit(THRESHOLD) * F.greatest(na, nb)) & (F.lit(100 + THRESHOLD) * most >= F.lit(THRESHOLD) * (F.col(na) + F.col(nb)))


def _linked(segments: DataFrame, postings: DataFrame, size: int) -> DataFrame | None:
    """The components that the links between classes make: cls and component for each class with a link. A round
    adds its links to the stars of the rounds before, so nothing is contracted twice."""
    stars: DataFrame | None = None
    # A class's place in a list, from 0 to 1: its leaders come first, and differ from list to list.
    place = (F.shiftrightunsigned(F.xxhash64("key", "cls"), 11).cast("double") / F.lit(float(1 << 53))).alias("u")
    lists = postings.select("key", "cls", "n", "pos", place, F.col("cls").alias("comp"))
    turn = 0
    while True:
        live = lists.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("u").alias("first"), F.count(F.lit(1)).alias("many")).where("lo <> hi")
        upto = F.greatest("first", F.col("first") + F.lit(float(LEADERS**turn - 1)) / F.col("many") * (1 - F.col("first")))
        lists = materialize(few(lists.join(live.select("key", upto.alias("upto")), "key"), size, TASK_BYTES), "lists")
        if lists.isEmpty():
            return stars
        led = lists.where("u <= upto").select("key", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("u").alias("ua"), F.col("comp").alias("ca"))
        rest = lists.select("key", F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("u").alias("ub"), F.col("comp").alias("cb"))
        met = rest.join(led, "key").where("(ua < ub or ua = ub and a < b) and ca <> cb").where(_near("na", "pa", "nb", "pb"))
        pairs = few(met.select(*(F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y)).alias(x) for x, y in ("ab", "ba")), *(F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y)).alias(x) for x, y in (("na", "nb"), ("nb", "na")))).distinct(), size, TASK_BYTES)
        found = materialize(few(_verified(pairs, segments, size), size, TASK_BYTES), "links")
        if not found.isEmpty():
            grown = found if stars is None else found.unionByName(stars.select(F.col("cls").alias("a"), F.col("component").alias("b")))
            stars = materialize(components(grown, "a", "b").withColumnRenamed("node", "cls"), "stars")
        lists = lists.where("u > upto").select("key", "cls", "n", "pos", "u")
        lists = lists.withColumn("comp", F.col("cls")) if stars is None else lists.join(stars, "cls", "left").withColumn("comp", F.coalesce("component", "cls")).drop("component")
        lists = few(lists, size, TASK_BYTES)
        turn += 1


def _grouped(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Members: id, tag (a hash of the text), cls and n for each row. Labels: cls, copies, and the first of its
    component, the smallest (id is null, id, tag)."""
    ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    fragments = max(8, -(-size // FRAGMENT_BYTES))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("tag"), F.col(text).alias("text"))
    cut = rows.mapInArrow(_fragment_rows(fragments), _CUT)
    counted = materialize(cut.groupBy("frag").applyInArrow(_count_fragment(fragments), _COUNTED), "fragments", "kind")
    members = counted.where("kind = 0").select("id", "tag", "cls", "n")
    row = F.struct(F.col("id").isNull().alias("none"), "id", "tag")
    classes = members.where("cls is not null").groupBy("cls").agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("copies"))
    packed = counted.where("kind = 1").select("bucket", "part", "classes", "sizes", "counts", "keys", "ranks")
    listed = materialize(packed.groupBy("bucket").applyInArrow(_prefixes, _LISTED), "listed", "kind")
    segments, postings = listed.where("kind = 0").select("cls", "part", "keys"), listed.where("kind = 1").select("cls", "n", "key", "pos")
    stars = _linked(segments, postings, size)
    if stars is None:
        return members, classes.select("cls", "copies", "first")
    of = classes.join(stars, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    of = materialize(few(of.select("cls", "first", "copies", "component"), size, TASK_BYTES), "classes")
    return members, of.drop("first").join(of.groupBy("component").agg(F.min("first").alias("first")), "component").select("cls", "copies", "first")


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (the smallest id in its component) and n_copies, the
    number of rows with the same set."""
    members, labels = _grouped(docs, doc_id, text)
    return members.join(labels, "cls", "left").select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("component_id"), F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each component: the smallest id's (a null id counts as the largest), and of rows with
    that id the one whose text has the smallest hash. Rows that are equal in id and text are one. Texts without words
    all stay."""
    members, labels = _grouped(docs, doc_id, text)
    found = members.join(labels, "cls").withColumn("stays", F.col("first") == F.struct(F.col("id").isNull().alias("none"), "id", "tag"))
    found = materialize(found.groupBy("id", "tag").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("c")).where("not stays or c > 1"), "gone")
    found = found.select(F.col("id").alias("__id"), F.col("tag").alias("__tag"), "stays")
    same = docs[doc_id].cast("long").eqNullSafe(found["__id"]) & (F.xxhash64(docs[text]) == found["__tag"])
    kept = docs.join(found.where("not stays"), same, "left_anti")
    twice = found.where("stays")
    if twice.isEmpty():
        return kept
    return kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates([doc_id, text]))
