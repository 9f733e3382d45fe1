"""Repair of conversations' structure, each distinct signature solved once.

A conversation's rows, by turn, become a string of one character a row, its signature: the role's initial (s, u, a; x for
any other), upper case if the text is truncated, d if the row is blank or a duplicate and has to go. Of a row's faults the
first counts: blank (no word), duplicate (role and text seen earlier), truncated (the last character that is not white space
is none of .!?).

The repaired roles' initials are ``(s?(ua)+)?``. Keeping a row costs 0, giving it the role user or assistant 2, deleting it 3,
inserting an empty user or assistant row 2, and a truncated row that stays 1 more. A signature's cheapest audit (K, R, D
and I in order, of equally cheap ones the least in ASCII) is found by recursion over its halves: what the rest costs from
each of four states (nothing yet, after s, after u, after a) goes from right to left, the edits from left to right, and short
parts are remembered with what follows them. From a state each letter leads to one other state, so the least letter among
the cheapest at each step gives the least audit, which also fixes all roles.

Plan: rows are dealt by conversation once and pass sorted through Python, which keeps a row's predecessor only and emits a
row a conversation. Distinct signatures are solved; signatures that more than a thousandth of the conversations share, of
at most 1,000 characters, hence at most 1,000 rows of that size, are joined back by broadcast, the others by a shuffle. For the replay the audits are
laid before their conversations' rows in one sorted stream, so the texts are joined with nothing, and digests are fed row
by row. Of a conversation one character a row (signature and audit, which are the result) is the most that is held.
A digest of one conversation is sequential work: a conversation with a third of all rows is sorted on disk and streamed by one task.

Defined cases: a null or blank text is blank, a null role is one space (no legal initial, so it is given another role or
deleted); a null conversation id is one conversation; null turns come first; ties of a turn go by role, text, then
``copy``; repeated rows are duplicates; a conversation without rows that stay has an empty audit or one of Ds, and no
repaired rows; an empty table gives empty results; texts of any length are whole; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship

_WORDY = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"
_NEVER = 1 << 60
#: States: nothing yet, after s, after u, after a. What each initial leads to, and what a row of no use in itself leads to.
_KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "x": (None,) * 4}
_NEXT = (2, 2, 3, 2)
#: What the end costs: user and assistant are inserted where a conversation may not end.
_END = (0, 4, 2, 0)
#: Longest part of a signature that is worked on and remembered as a whole.
_PART = 24
#: What audits() counts of each conversation.
COUNTS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
#: Broadcast: signatures of more than this share of all conversations, and no longer than that.
HOT_SHARE, HOT_LENGTH = 1000, 1000


def _options(row: str, state: int, after: tuple[int, ...]) -> list[tuple[int, str, int]]:
    """(cost with all that follows, letter, next state) of the edits that use up a row, by letter."""
    late, to = int(row.isupper()), _KEEP[row.lower()][state] if row != "d" else None
    out = [(3 + after[state], "D", state)]
    if to is not None:
        out.append((late + after[to], "K", to))
    if row != "d":
        out.append((2 + late + after[_NEXT[state]], "R", _NEXT[state]))
    return out


def _step(row: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """What a row and all that follows cost from each state; inserted rows may come before it."""
    plain = [min(c for c, _, _ in _options(row, state, after)) for state in range(4)]
    u, a = min(plain[2], 2 + plain[3]), min(plain[3], 2 + plain[2])
    return min(plain[0], 2 + u), min(plain[1], 2 + u), u, a


@lru_cache(maxsize=1 << 16)
def _short(part: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], ...]:
    """What costs what from each place of a short part on, its end included."""
    out = [after]
    for row in reversed(part):
        out.append(_step(row, out[-1]))
    return tuple(reversed(out))


@lru_cache(maxsize=1 << 16)
def _edited(part: str, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The least of the cheapest audits of a short part, and the state behind it."""
    costs, letters = _short(part, after), []
    for i, row in enumerate(part):
        while True:
            best, options = costs[i][state], _options(row, state, costs[i + 1])
            options.append((2 + costs[i][_NEXT[state]], "I", _NEXT[state]))
            letter, state = min((letter, to) for cost, letter, to in options if cost == best)
            letters.append(letter)
            if letter != "I":
                break
    return "".join(letters), state


def _before(part: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """What a part and all that follows cost from each state."""
    if len(part) <= _PART:
        least = min(after)  # taken off, so that more parts are remembered
        return tuple(x + least for x in _short(part, tuple(x - least for x in after))[0])
    half = len(part) // 2
    return _before(part[:half], _before(part[half:], after))


def _audit(part: str, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    if len(part) <= _PART:
        least = min(after)
        return _edited(part, state, tuple(x - least for x in after))
    half = len(part) // 2
    left, state = _audit(part[:half], state, _before(part[half:], after))
    right, state = _audit(part[half:], state, after)
    return left + right, state


def solve(signature: str) -> tuple[int, str]:
    """The cost and the audit of a signature."""
    letters, state = _audit(signature, 0, _END)
    return _before(signature, _END)[0], letters + "I" * (_END[state] // 2)


def damage(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text), nulls as one space, with planted faults and ``copy``, by a checksum of
    conversation and turn: 5 % dropped, 5 % emptied, 5 % without .!?, 5 % repeated, 5 % with the role user."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    out = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return out.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))


def _prepared(rows: DataFrame) -> DataFrame:
    """The five columns, without nulls in role, text and copy, dealt by conversation."""
    copy = F.coalesce(F.col("copy").cast("long"), F.lit(0)) if "copy" in rows.columns else F.lit(0).cast("long")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role"), text("text"), copy.alias("copy"))


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


_STATS = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, signature string"


def _signed(batches):
    """A row a conversation, from rows sorted by conversation and turn."""
    import pyarrow as pa

    names = [c.split()[0] for c in _STATS.split(", ")]
    none = object()
    conv, done = none, []

    def close():
        if conv is not none:
            gaps = high - low + 1 - turns if turns else 0
            done.append((conv, gaps, *faults, illegal, "".join(chars)))

    def out():
        columns = list(zip(*done, strict=True)) if done else [[]] * len(names)
        kinds = [*[pa.int64()] * 6, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for c, turn, initial, fault in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if conv is none or c != conv:
                close()
                conv, faults, illegal, chars, before, turns, low, high = c, [0, 0, 0], 0, [], None, 0, None, None
            if turn is not None and turn != high:  # turns come in order
                turns, low, high = turns + 1, turn if low is None else low, turn
            illegal += before is not None and before + initial not in ("su", "ua", "au")
            before = initial
            if fault < 3:
                faults[fault] += 1
            own = initial if initial in ("s", "u", "a") else "x"
            chars.append("d" if fault < 2 else own.upper() if fault == 2 else own)
        if done:
            yield out()
            done = []
    close()
    if done:
        yield out()


def signatures(rows: DataFrame) -> DataFrame:
    """A row a conversation: gaps in its turns, faults, illegal neighbours and its signature."""
    ship(rows.sparkSession)
    rows = _prepared(rows).repartition("conv_id")
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("turn", "copy")) > 1
    rows = rows.withColumn("again", again).sortWithinPartitions("conv_id", "turn", "role", "text", "copy")
    fault = F.when(~F.col("text").rlike(_WORDY), 0).when(F.col("again"), 1).when(~F.col("text").rlike(_ENDED), 2).otherwise(3)
    return rows.select("conv_id", "turn", _initial(F.col("role")).alias("initial"), fault.alias("fault")).mapInArrow(_signed, _STATS)


def _solved(batches):
    for df in batches:
        found = [solve(s) for s in df["signature"]]
        yield df.assign(cost=[c for c, _ in found], audit=[a for _, a in found])


def audits(rows: DataFrame) -> DataFrame:
    """What signatures() gives, with each conversation's cost and audit. Distinct signatures are solved once."""
    stats = materialize(signatures(rows), "signatures")
    total = stats.count()
    counted = stats.groupBy("signature").agg(F.count(F.lit(1)).alias("n"))
    solved = materialize(counted.mapInPandas(_solved, "signature string, n bigint, cost bigint, audit string"), "solved")
    is_hot = (F.col("n") * HOT_SHARE > total) & (F.length("signature") <= HOT_LENGTH)
    hot, rest = (solved.where(c).select("signature", "cost", "audit") for c in (is_hot, ~is_hot))
    common = stats.join(F.broadcast(hot), "signature")
    rare = stats.join(F.broadcast(hot.select("signature")), "signature", "left_anti").join(rest, "signature")
    return common.unionByName(rare)


def _replayed(batches) -> Iterator[tuple[object, Iterator[tuple[str, str]]]]:
    """(conversation, role, text) of the repaired rows, from rows sorted behind their conversation's audit; with role and
    text null once a conversation begins."""
    audit, conv = "", None
    at = place = skip = 0

    def given():  # roles by place: s only where it is kept, so the number of rows that stay tells who comes first
        return "assistant" if (place - skip) % 2 else "user"

    def inserted():
        nonlocal at, place
        while at < len(audit) and audit[at] == "I":
            yield conv, given(), ""
            at, place = at + 1, place + 1

    for batch in batches:
        for c, own, role, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if own is not None:
                yield from inserted()
                audit, conv, at, place = own, c, 0, 0
                skip = (len(audit) - audit.count("D")) % 2
                yield conv, None, None
                continue
            yield from inserted()
            letter, at = audit[at], at + 1
            if letter != "D":
                yield conv, role if letter == "K" else given(), text
                place += 1
    yield from inserted()


def _repaired(batches):
    import pyarrow as pa

    def out():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["conv_id", "place", "role", "text"])

    rows, size, place = [], 0, 0
    for conv, role, text in _replayed(batches):
        if role is None:
            place = 0
            continue
        rows.append((conv, place, role, text))
        place, size = place + 1, size + len(text)
        if size > 1 << 20 or len(rows) >= 10_000:
            yield out()
            rows, size = [], 0
    if rows:
        yield out()


def _digested(batches):
    import pyarrow as pa

    def out():
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string())], names=["conv_id", "repaired_sha256"])

    ids, found, digest, first = [], [], None, True
    for conv, role, text in _replayed(batches):
        if role is None:
            if digest:
                found.append(digest.hexdigest())
            if len(ids) >= 10_000:
                yield out()
                ids, found = [], []
            ids.append(conv)
            digest, first = hashlib.sha256(), True
            continue
        digest.update(f"{role}:{text}".encode() if first else f"\n{role}:{text}".encode())
        first = False
    if digest:
        found.append(digest.hexdigest())
        yield out()


def _behind_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    ship(rows.sparkSession)
    head = audits.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).cast("long").alias("copy"), "audit")
    both = _prepared(rows).withColumn("audit", F.lit(None).cast("string")).unionByName(head)
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "text", "copy")
    return both.select("conv_id", "audit", "role", "text")


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text: the rows after their conversation's edits."""
    return _behind_audits(rows, audits).mapInArrow(_repaired, "conv_id bigint, place bigint, role string, text string")


def repaired_digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the repaired ``role:text`` joined by line feeds, of rows that pass one by one."""
    return _behind_audits(rows, audits).mapInArrow(_digested, "conv_id bigint, repaired_sha256 string")
