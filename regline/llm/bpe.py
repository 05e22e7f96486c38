"""Byte-level BPE encoding and decoding.

A text is cut by the tokenizer's pattern; each match is encoded on its own.
A segment tree over the match's byte positions holds, for every live position,
the rank of the pair that starts there; its root is the leftmost pair of the
smallest rank. A merge updates the pair's own position and its live
neighbours, each in logarithmic time, so a match of n bytes takes O(n log n).
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from regline.llm.common import text_or_empty
from regline.session import ship_package

#: Encoded matches that a worker remembers before it starts afresh.
REMEMBERED = 200_000
#: Matches merged together, and characters of text cut at a time; both bound memory.
MERGED, CHARACTERS = 4_000, 1_000_000


def parse_ranks(file: bytes) -> dict[bytes, int]:
    """A ``.tiktoken`` vocabulary: base64 token, space, rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file.splitlines() if line.strip())}


def _next_power_of_two(n: int) -> int:
    return 1 << max(n - 1, 0).bit_length()


def merge_pieces(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one match of the pattern."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    leaves = _next_power_of_two(n)
    none = len(ranks) * leaves * 2  # larger than any key
    # A node's key is rank * leaves + position: the smallest is the leftmost minimum.
    tree = [none] * (2 * leaves)
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[leaves + i] = rank * leaves + i
    for node in range(leaves - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left <= right else right

    def update(position: int, key: int) -> None:
        node = leaves + position
        tree[node] = key
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left <= right else right
            if tree[node] == least:
                return
            tree[node] = least
            node >>= 1

    # A live position is the first byte of a token; end[i] is where it stops.
    end = list(range(1, n + 1))
    before = list(range(-1, n))  # the live position to the left, by position
    while tree[1] < none:
        i = tree[1] % leaves
        j = end[i]  # the token that is swallowed
        stop = end[i] = end[j]
        update(j, none)
        if stop < n:
            before[stop] = i
            rank = get(piece[i : end[stop]])
            update(i, none if rank is None else rank * leaves + i)
        else:
            update(i, none)
        left = before[i]
        if left >= 0:
            rank = get(piece[left:stop])
            update(left, none if rank is None else rank * leaves + left)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class Merger:
    """``merge_pieces`` for many short matches at once: one segment tree per row of an array.

    In every round each unfinished row makes its next merge, so the rounds
    number as many as the longest match's merges.
    """

    NONE = np.iinfo(np.int64).max

    def __init__(self, ranks: dict[bytes, int]):
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {
            ranks[token[:i]] << 32 | ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)

    def _keys(self, left: np.ndarray, right: np.ndarray, position: np.ndarray, bits: int) -> np.ndarray:
        """Rank of each pair of tokens and its position in one number; NONE if it isn't a token."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.merged[at] << bits | position, self.NONE)

    def merge(self, pieces: list[bytes], bits: int) -> list[bytes]:
        """Packed ids of matches of at most ``1 << bits`` bytes."""
        n, w = len(pieces), 1 << bits
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        places = np.arange(w)
        live = places < lengths[:, None]
        token = np.zeros((n, w + 1), np.int64)  # one place more, for what lies past the end
        token[:, :w][live] = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.tile(np.arange(1, w + 2), (n, 1))
        before = np.tile(np.arange(-1, w), (n, 1))
        tree = np.full((n, 2 * w), self.NONE)
        paired = places < lengths[:, None] - 1
        row, place = np.nonzero(paired)
        tree[:, w:][paired] = self._keys(token[row, place], token[row, place + 1], place, bits)
        for level in range(bits - 1, -1, -1):
            size = 1 << level
            tree[:, size : 2 * size] = np.minimum(tree[:, 2 * size : 4 * size : 2], tree[:, 2 * size + 1 : 4 * size : 2])
        rows = np.flatnonzero(tree[:, 1] < self.NONE)
        while len(rows):
            least = tree[rows, 1]
            i = least & (w - 1)
            token[rows, i] = least >> bits
            j = after[rows, i]
            stop = after[rows, j]
            live[rows, j] = False
            after[rows, i] = stop
            before[rows, stop.clip(max=w)] = i
            left = before[rows, i]
            ahead = np.where(stop < lengths[rows], self._keys(token[rows, i], token[rows, stop.clip(max=w)], i, bits), self.NONE)
            behind = np.where(left >= 0, self._keys(token[rows, left], token[rows, i], left, bits), self.NONE)
            nodes = [j + w, i + w, np.where(left >= 0, left, j) + w]  # without a left neighbour, the dead place again
            for node, key in zip(nodes, (self.NONE, ahead, behind), strict=True):
                tree[rows, node] = key
            for _ in range(bits):
                nodes = [node >> 1 for node in nodes]
                for node in nodes:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            rows = rows[tree[rows, 1] < self.NONE]
        packed = token[:, :w][live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(axis=1) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Codec:
    """Encodes texts to packed little-endian unsigned 32-bit ids, and back."""

    #: Matches of at most so many bytes (as powers of two) are merged together; longer ones one by one.
    TOGETHER = (3, 4, 5, 6)

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.matches = regex.compile(pattern).findall
        self.merger = Merger(ranks)
        self.known: dict[str, bytes] = {}
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def _learn(self, matches: list[str]) -> None:
        """Encode matches not met before and remember them."""
        by_size: dict[int, list[str]] = {}
        for match in matches:
            piece = match.encode()
            if (whole := self.ranks.get(piece)) is not None:
                self.known[match] = struct.pack("<I", whole)
            else:
                by_size.setdefault(next((b for b in self.TOGETHER if len(piece) <= 1 << b), 0), []).append(match)
        for match in by_size.pop(0, []):
            ids = merge_pieces(match.encode(), self.ranks)
            self.known[match] = struct.pack(f"<{len(ids)}I", *ids)
        for bits, some in by_size.items():
            for at in range(0, len(some), MERGED):
                part = some[at : at + MERGED]
                self.known.update(zip(part, self.merger.merge([m.encode() for m in part], bits), strict=True))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        found = [self.matches(text) for text in texts]
        self._learn([m for m in set().union(*found) if m not in self.known])
        get = self.known.__getitem__
        return [b"".join(map(get, matches)) for matches in found]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@cache
def _codec(vocabulary: bytes, pattern: str) -> Codec:
    return Codec(parse_ranks(vocabulary), pattern)


class Tokenizer:
    """Column functions of one vocabulary; its file (under 1 MB) is sent to the executors once."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        ship_package(spark)
        with open(path, "rb") as file:
            self.vocabulary = spark.sparkContext.broadcast(file.read())
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        """Ids of a text as little-endian unsigned 32-bit integers in a binary; a null text has none."""
        vocabulary, pattern = self.vocabulary, self.pattern

        def encoded(texts: pa.Array) -> pa.Array:
            codec = _codec(vocabulary.value, pattern)
            return pa.concat_arrays([pa.array(codec.encode_all(part), pa.binary()) for part in _parts(texts)])

        return F.arrow_udf(encoded, "binary")(text_or_empty(text))

    def decode(self, ids: Column) -> Column:
        """The bytes that packed ids stand for; null stands for none."""
        vocabulary, pattern = self.vocabulary, self.pattern

        def decoded(packed: pa.Array) -> pa.Array:
            codec = _codec(vocabulary.value, pattern)
            return pa.array([codec.decode(p.as_py()) for p in packed], pa.binary())

        return F.arrow_udf(decoded, "binary")(F.coalesce(ids, F.lit(bytearray())))

    def round_trip(self, text: Column) -> Column:
        """A struct of ``ids`` as by ``encode`` and ``decoded``, the bytes that ``decode`` gives for them, in one pass."""
        vocabulary, pattern = self.vocabulary, self.pattern

        def both(texts: pa.Array) -> pa.Array:
            codec = _codec(vocabulary.value, pattern)
            done = []
            for part in _parts(texts):
                ids = pa.array(codec.encode_all(part), pa.binary())
                decoded = pa.array([codec.decode(p.as_py()) for p in ids], pa.binary())
                done.append(pa.StructArray.from_arrays([ids, decoded], ["ids", "decoded"]))
            return pa.concat_arrays(done)

        return F.arrow_udf(both, "ids binary, decoded binary")(text_or_empty(text))


def _parts(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in order, about CHARACTERS at a time; one list at least."""
    part, size = [], 0
    for value in texts:
        part.append(value.as_py())
        size += len(part[-1])
        if size >= CHARACTERS:
            yield part
            part, size = [], 0
    yield part


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("bigint")
