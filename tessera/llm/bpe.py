"""BPE encoding and decoding with tree concatenation.

A text is cut where its pre-tokenization surely ends: before a space or a line feed between two characters that are
not white space (a line feed there is a token of its own), between a letter or digit and the ASCII punctuation that
ends a piece, and around special tokens. Pieces so cut are encoded on their own and the ids joined, which is exactly
the encoding of the whole. Arrow cuts a batch's texts and finds the distinct pieces; only those are encoded, and
their ids are dealt to all places at once. Nothing is kept from batch to batch.

A piece that stays long has no such place (an address, a hash, a script written without spaces). Its
pre-tokens are found first, and each long one is halved down to LEAF bytes; all leaves are encoded in one call of the
library, which deals them to its threads, and the halves are put together level by level. At each join
a window around it is re-encoded from its bytes; it grows until its first token is the left side's token at
that place and its last token the right side's. A BPE sequence is the encoding of its text if and only if each
neighbouring pair of tokens is, so such an agreement makes the whole exact, whatever the cut. Ordinary prose never
gets there: only pre-tokens over a quarter of LEAF characters do.

Defined cases: null text is the empty text with no ids; a special token's string in a text is that token;
any characters round-trip, as the alphabet has all bytes; a text of any length is encoded whole; repeated rows are
encoded again each; extra columns pass through, but columns that are added replace columns of their names; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .common import ship, trim

#: Bytes of a leaf, and pieces longer than this are long.
LEAF = 2048
#: Bytes of text encoded at once.
BATCH = 8 << 20
#: The same where ids become Python lists or strings beside them.
DIGEST_BATCH = 3 << 20
#: Threads of the library in a worker, where the environment names no number: as many as a small executor's cores.
THREADS = "2"
_TAIL = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes for U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encodes and decodes as the tokenizers library does with one byte-level BPE file."""

    def __init__(self, path: str, leaf: int = LEAF):
        os.environ.setdefault("RAYON_NUM_THREADS", THREADS)
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.leaf = leaf
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        alphabet = byte_alphabet()
        self.to_char = {b: c for c, b in alphabet.items()}
        vocab = spec["model"]["vocab"]
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.pre = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.raw = Tokenizer(self.tokenizer.model)  # without pre-tokens

    # Long pre-tokens: bytes in, ids out.

    def _leaves(self, parts: list[bytes]) -> list[list[int]]:
        chars = ["".join([self.to_char[b] for b in p]) for p in parts]
        return [e.ids for e in self.raw.encode_batch(chars, add_special_tokens=False)]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the text of left followed by that of right."""
        if not left or not right:
            return left or right
        reach = 2
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            window = self._leaves([b"".join(self.bytes[i] for i in left[a:] + right[:b])])[0]
            # A side that is wholly inside the window has nothing outside it to agree with.
            if (a == 0 or window[0] == left[a]) and (b == len(right) or window[-1] == right[b - 1]):
                return left[:a] + window + right[b:]
            reach *= 2

    def tree(self, text: bytes) -> list[int]:
        """The ids of one long pre-token."""
        n = 1
        while len(text) / n > self.leaf:
            n *= 2
        cuts = [len(text) * i // n for i in range(n + 1)]
        level = self._leaves([text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
        while len(level) > 1:
            level = [self.join(level[i], level[i + 1]) for i in range(0, len(level), 2)]
        return level[0]

    def _long(self, piece: str) -> bytes:
        out: list[int] = []
        short: list[str] = []
        spans = [piece[a:b] for _, (a, b) in self.pre.pre_tokenize_str(piece)]
        for p in spans:
            if len(p) <= self.leaf // 4:
                short.append(p)
                continue
            out += self._together(short)
            short = []
            out += self.tree(p.encode())
        return np.array(out + self._together(short), "<u4").tobytes()

    def _together(self, pre_tokens: list[str]) -> list[int]:
        return [t.id for p in pre_tokens for t in self.tokenizer.model.tokenize("".join(self.to_char[b] for b in p.encode()))]

    # Pieces between safe cuts: they follow a space, or begin with the line feed that they follow.

    def _known(self, pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each distinct piece, with its space or line feed, begin and how many they are."""
        import pyarrow as pa
        import pyarrow.compute as pc

        spaced = pc.binary_join_element_wise(pc.if_else(pc.starts_with(pieces, "\n"), "", " "), pieces, "")
        ends = np.frombuffer(spaced.buffers()[1], np.int32)[: len(spaced) + 1]
        data = memoryview(spaced.buffers()[2] or b"")
        # Some hundreds a text: the library's cost is the same, and its threads share them.
        cuts = [*range(0, len(spaced), 500), len(spaced)]
        texts = [str(data[ends[i] : ends[j]], "utf-8") for i, j in zip(cuts, cuts[1:], strict=False)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] or [np.zeros(0, "<u4")])
        stops = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
        stops[0] = 0
        return ids, stops[:-1], np.diff(stops)

    def _places(self, texts):
        """The distinct pieces of texts, and what each is made of: pieces and tails to encode, which two of them make
        each distinct piece, which pieces no safe cut makes, the piece at each place, and where each text's begin."""
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        at = lists.offsets.to_numpy().astype(np.int64)
        found = lists.flatten().dictionary_encode()
        whole, flags = found.dictionary, lambda x: x.to_numpy(zero_copy_only=False).astype(bool)
        first, second, last = pc.utf8_slice_codeunits(whole, 0, 1), pc.utf8_slice_codeunits(whole, 1, 2), pc.utf8_slice_codeunits(whole, -1)
        blank = lambda x: flags(pc.utf8_is_space(x)) | flags(pc.equal(x, ""))
        odd = blank(last) | blank(first) & ~(flags(pc.equal(first, "\n")) & ~blank(second))
        # A letter or digit before the closing punctuation: it is encoded apart from it, else the piece is whole.
        trimmed = pc.utf8_rtrim(whole, characters=_TAIL)
        trimmed = pc.if_else(pc.utf8_is_alnum(pc.utf8_slice_codeunits(trimmed, -1)), trimmed, whole)
        core = pc.if_else(pa.array(odd), "", trimmed).dictionary_encode()
        # The punctuation itself, from the pieces' last bytes.
        size = pc.binary_length(whole).to_numpy() - pc.binary_length(trimmed).to_numpy()
        stops = np.frombuffer(whole.buffers()[1], np.int32)[1 + whole.offset : 1 + whole.offset + len(whole)]
        ends = np.cumsum(size)
        chars = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[np.repeat(stops - ends, size) + np.arange(ends[-1] if len(ends) else 0)]
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        tail = pa.StringArray.from_buffers(len(whole), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(chars))).dictionary_encode()
        return core.dictionary, tail.dictionary.to_pylist(), core.indices.to_numpy(), tail.indices.to_numpy(), odd, whole, found.indices.to_numpy(), at

    def encode_column(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of an Arrow column's texts, end to end, and where each text's begin and end."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts, n = pc.fill_null(texts, "").cast(pa.string()), len(texts)
        cores, tails, core_of, tail_of, odd, whole, place, at = self._places(texts)
        # A text's beginning is encoded as it is. Texts with odd pieces or special tokens are cut with care.
        heads = whole.take(pa.array(place[at[:-1]])).to_numpy(zero_copy_only=False).tolist()
        strange = odd[place]
        strange[at[:-1]] = np.array([h[-1:].strip() == "" for h in heads], bool) & (np.diff(at) > 1)
        careful = np.zeros(n, bool)
        careful[np.repeat(np.arange(n), np.diff(at))[strange]] = True
        for s in self.special:
            careful |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        # Units to encode: nothing, distinct cores, long cores, tails, beginnings.
        short = pc.utf8_length(cores).to_numpy() <= self.leaf // 4
        filled = pc.binary_length(cores).to_numpy() > 0
        ids, start, held = self._known(cores.filter(pa.array(short & filled)))
        core_at = np.zeros(len(cores), np.int32)
        core_at[short & filled] = 1 + np.arange(len(start))
        core_at[~short] = base = 1 + len(start) + np.arange(int((~short).sum()))
        units = [self._long(c if c[0] == "\n" else " " + c) for c in cores.filter(pa.array(~short)).to_pylist()]
        tail_at = 1 + len(start) + len(base) + np.arange(len(tails), dtype=np.int32)
        units += [self._start(t) for t in tails]
        head_at = 1 + len(start) + len(units) + np.arange(n, dtype=np.int32)
        slow = iter(texts.filter(pa.array(careful)).to_pylist())
        units += [self._careful(next(slow)) if c else self._start(h) for h, c in zip(heads, careful.tolist(), strict=True)]
        more = np.fromiter(map(len, units), np.int64, len(units)) // 4
        start = np.concatenate([[0], start, len(ids) + np.cumsum(more) - more])
        held = np.concatenate([[0], held, more])
        ids = np.concatenate([ids, np.frombuffer(b"".join(units), "<u4")])
        # Each piece is two units; those of all places are laid end to end.
        spots = np.empty((len(place), 2), np.int32)
        spots[:, 0], spots[:, 1] = core_at[core_of][place], tail_at[tail_of][place]
        spots[np.repeat(careful, np.diff(at))] = 0
        spots[at[:-1], 0], spots[at[:-1], 1] = head_at, 0
        spots = spots.ravel()
        many = held[spots]
        stops = np.cumsum(many)
        kind = np.int32 if max(len(ids), stops[-1] if len(stops) else 0) < 1 << 30 else np.int64
        begin = np.repeat((start[spots] - stops + many).astype(kind), many)
        begin += np.arange(len(begin), dtype=kind)
        return ids[begin], np.concatenate([[0], stops[2 * at[1:] - 1]])

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        import pyarrow as pa

        if not texts:
            return []
        ids, offsets = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(offsets.tolist(), offsets.tolist()[1:], strict=False)]

    def _careful(self, text: str) -> bytes:
        out = []
        for p in self.split.split(text) if self.split else [text]:
            if p in self.special:
                out.append(np.uint32(self.special[p]).tobytes())
            elif p:
                first, *rest = _SAFE.split(p)
                out.append(self._start(first))
                at = [i for i, x in enumerate(rest) if any(c.isspace() for c in x)]
                for a, b in zip([-1, *at], [*at, len(rest)], strict=True):
                    out += [self._start(" " + x) for x in rest[a + 1 : b]]
                    if b < len(rest):
                        out.append(self._start(" " + rest[b]))
        return b"".join(out)

    def _start(self, piece: str) -> bytes:
        if not piece:
            return b""
        if len(piece) > self.leaf // 4:
            return self._long(piece)
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec a worker and file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def slices(column, most: int = 4 << 20) -> Iterator[slice]:
    """Ranges of an Arrow text column with about ``most`` bytes each, one text at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += int(n)
    if len(sizes) > start:
        yield slice(start, len(sizes))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs with ids, the text's token ids as array<int>."""
    return _mapped(docs, path, text, "ids array<int>", _ids)


def digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs with n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256, of the decoded ids."""
    return _mapped(docs, path, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", _digests)


def _ids(c: Codec, ids: np.ndarray, offsets: np.ndarray):
    import pyarrow as pa

    return {"ids": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))}


def _digests(c: Codec, ids: np.ndarray, offsets: np.ndarray):
    import pyarrow as pa

    numbers = [str(i) for i in range(len(c.bytes))]
    spans = list(zip(offsets.tolist(), offsets.tolist()[1:], strict=False))
    return {
        "n_tokens": pa.array(np.diff(offsets)),
        "ids_sha256": pa.array([hashlib.sha256(",".join([numbers[i] for i in ids[a:b].tolist()]).encode()).hexdigest() for a, b in spans], pa.string()),
        "decoded_sha256": pa.array([hashlib.sha256(c.decode(ids[a:b]).encode()).hexdigest() for a, b in spans], pa.string()),
    }


def _mapped(docs: DataFrame, path: str, text: str, added: str, make) -> DataFrame:
    from pyspark.sql.types import StructType

    ship(docs.sparkSession)
    extra = StructType.fromDDL(added)
    docs = docs.drop(*extra.names)
    schema = StructType([*docs.schema.fields, *extra.fields])

    def run(batches):
        import pyarrow as pa

        c = codec(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for s in slices(column, DIGEST_BATCH):
                part = batch.slice(s.start, s.stop - s.start)
                new = make(c, *c.encode_column(column[s]))
                yield pa.RecordBatch.from_arrays([*part.columns, *(new[n] for n in extra.names)], names=[*part.schema.names, *extra.names])
        trim()

    return docs.mapInArrow(run, schema)
