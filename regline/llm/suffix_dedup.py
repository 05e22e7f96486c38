"""Substring de-duplication with suffix arrays.

Every byte in a string of LENGTH bytes that also starts in a document with a
smaller id is removed; strings are judged on the input.

1. Of texts that are equal as a whole only those with the smallest id go on;
   the others go whole.
2. Anchors narrow the text down: of the GRAM-byte grams in a string of LENGTH
   bytes the one with the smallest hash is its anchor, so equal strings have
   equal anchors. Anchors met in one document only can't be in a repeat.
3. The stretch of text around each other anchor (all strings it is the anchor
   of) travels, ordered by anchor, so that equal strings mostly meet in one
   shard of bounded size. An anchor that very many documents hold spreads over
   several shards.
4. Each shard sorts the suffixes of its distinct stretches (Larsson-Sadakane:
   groups of equal prefixes are refined by the ranks that many bytes further
   on, which doubles the prefix each time) and takes the common prefixes of
   neighbours (Kasai). Neighbours with LENGTH bytes in common are one string,
   and its smallest id is known.
5. For anchors at the ends of a shard, which may go on in others, the shard's
   sorted strings are sent to be merged: each list's strings are found in the
   whole by binary search, and smaller ids come back to the occurrences that
   had none in their own shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regline.llm.bitmap import Bitmap
from regline.llm.common import free_name, text_or_empty, with_python, written
from regline.plans.ingest import sql_conf

#: Bytes of a repeated string.
LENGTH = 50
#: Bytes of an anchor.
GRAM = 24
#: Strings between whose grams one anchor is chosen.
SPREAD = LENGTH - GRAM + 1
#: Bytes of text in which anchors are sought at a time, and bytes of distinct stretches in a shard.
CHUNK_BYTES = 1 << 18
SHARD_BYTES = 2 << 20
BATCH_ROWS = "2000"
NO_ID = (1 << 63) - 1  # stands for a null id, which comes last

_MIX = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)


def _gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on; sums of doubled lengths, modulo 2^64."""
    part = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
    power, size, whole, done = 0x9E3779B97F4A7C15, 1, None, 0
    while True:
        if GRAM & size:
            if whole is None:
                whole = part
            else:  # the part before, ``size`` bytes, then what there was
                n = len(codes) - done - size + 1
                whole = part[:n] * np.uint64(pow(0x9E3779B97F4A7C15, done, 1 << 64)) + whole[size : size + n]
            done += size
        if done == GRAM:
            break
        part = part[:-size] * np.uint64(power) + part[size:]
        power, size = power * power % (1 << 64), size * 2
    whole = whole ^ (whole >> np.uint64(32))
    whole *= _MIX
    return whole ^ (whole >> np.uint64(29))


def anchors(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For some bytes (LENGTH at least), runs of strings with one anchor: the anchor's hash, the place of the run's
    first string, and how many strings it has."""
    hashes = _gram_hashes(codes)
    least = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)  # of equal hashes the first
    size = 1
    while size * 2 <= SPREAD:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < SPREAD:
        least = np.minimum(least[: size - SPREAD], least[SPREAD - size :])
    at = (least & _LOW).astype(np.int64)
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    return hashes[at[starts]], starts, np.diff(np.append(starts, len(at)))


def _located(batches: Iterator[pa.RecordBatch], copied: Bitmap) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, tuple]]:
    """By chunks of texts: the rows and their bytes, where these end, and the runs of strings.

    Rows that may be copies are left out unless they are ``sure`` to be the first.
    """
    for batch in batches:
        hashes = batch.column(2).to_numpy().view(np.uint64)
        batch = batch.filter(pa.array(batch.column(3).to_numpy(zero_copy_only=False) | ~copied.has(hashes)))
        texts = [t.as_buffer().to_pybytes() for t in batch.column(1)]
        begin = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= CHUNK_BYTES or i == len(texts) - 1:
                data = b"".join(texts[begin : i + 1])
                if len(data) >= LENGTH:
                    codes = np.frombuffer(data, np.uint8)
                    ends = np.cumsum([len(t) for t in texts[begin : i + 1]])
                    found = _inside(anchors(codes), ends)
                    yield batch.slice(begin, i + 1 - begin), codes, ends, found
                begin, size = i + 1, 0


def _inside(found: tuple, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs without the strings that reach into the next text: row, anchor, start, number."""
    hashes, starts, sizes = found
    # A run over the end of a text is cut there; what starts in the next text is a run of its own.
    row = np.searchsorted(ends, starts, "right")
    last = np.searchsorted(ends, starts + sizes - 1, "right")
    parts = last - row + 1
    run = np.repeat(np.arange(len(starts)), parts)
    row = row[run] + np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
    begins = np.append(0, ends)
    first = np.maximum(starts[run], begins[row])
    stop = np.minimum((starts + sizes)[run], ends[row] - LENGTH + 1)
    there = stop > first
    return row[there], hashes[run][there], first[there], (stop - first)[there]


class _Anchors:
    def __init__(self, copied: Bitmap):
        self.copied = copied

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each anchor of a chunk once, and whether it is in more than one of its texts."""
        for _, _, _, (row, hashes, _, _) in _located(batches, self.copied):
            order = np.lexsort((row, hashes))
            hashes, row = hashes[order], row[order]
            first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
            many = np.maximum.reduceat(row, first) != row[first] if len(first) else np.array([], bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[first].view(np.int64)), pa.array(many.astype(np.int32) + 1)], ["anchor", "n"]
            )


def _binary(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all places in some spans, one span after the other."""
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


STRETCH = "anchor bigint, id bigint, hash bigint, start int, stretch binary"


class _Stretches:
    def __init__(self, copied: Bitmap, shared: Bitmap):
        self.copied, self.shared = copied, shared

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, codes, ends, (row, hashes, first, n) in _located(batches, self.copied):
            there = self.shared.has(hashes)
            row, hashes, first, n = row[there], hashes[there], first[there], n[there]
            lengths = n + LENGTH - 1
            begins = np.append(0, ends)[row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.view(np.int64)),
                    rows.column(0).take(pa.array(row)),
                    rows.column(2).take(pa.array(row)),
                    pa.array((first - begins).astype(np.int32)),
                    _binary(lengths, codes[_spans(first, lengths)]),
                ],
                ["anchor", "id", "hash", "start", "stretch"],
            )


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Places in the order of the suffixes from each on."""
    n = len(codes)
    words = _words(codes)
    order = np.argsort(words[:n])
    rank = _ranks(words[order], order)
    size = 8
    unsorted = _in_groups(rank, order)
    while len(unsorted):
        # Larsson-Sadakane: only groups that are not yet single are sorted again, by the rank ``size`` places on.
        places = order[unsorted]
        after = n - places - size  # past the end: the shorter suffix first
        there = after > 0
        after[there] = rank[places[there] + size] + 1
        key = (rank[places] << 34) + after
        sub = np.argsort(key)
        key, places = key[sub], places[sub]
        order[unsorted] = places
        new = np.diff(key, prepend=key[0] - 1) != 0
        group = np.maximum.accumulate(np.where(new, unsorted, 0))
        rank[places] = group
        size *= 2
        unsorted = unsorted[_not_single(new)]
    return order


def _words(codes: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a number, in byte order; one place more for each byte of padding."""
    padded = np.concatenate([codes, np.zeros(LENGTH + 16, np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        padded = padded[:-size] << np.uint64(8 * size) | padded[size:]
    return padded


def _ranks(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    return rank


def _not_single(new: np.ndarray) -> np.ndarray:
    """Of sorted rows, given where groups begin: which are in a group of two or more."""
    return ~(new & np.append(new[1:], True))


def _in_groups(rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    ranks = rank[order]
    return np.flatnonzero(_not_single(np.diff(ranks, prepend=-1) != 0))


#: Places that one lane of ``common_prefixes`` goes through.
LANE = 64


def common_prefixes(codes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of the order, the bytes (LENGTH at most) it has in common with the place before.

    Kasai: from one byte of the text to the next, the common prefix gets
    shorter by one byte at most. Many lanes, LANE bytes apart, go through the
    text together.
    """
    n = len(order)
    before = np.empty(n, np.int64)
    before[order] = np.append(-1, order[:-1])
    words = _words(codes)
    common = np.zeros(n, np.int64)
    length = np.zeros(-(-n // LANE), np.int64)
    for step in range(LANE):
        place = np.arange(step, n, LANE)
        length = np.maximum(length[: len(place)] - 1, 0)
        live = np.flatnonzero(before[place] >= 0)
        length[before[place] < 0] = 0
        while len(live):
            a, b, h = place[live], before[place[live]], length[live]
            differ = words[a + h] ^ words[b + h]
            alike = np.zeros(len(live), np.int64)
            for k in range(1, 9):
                alike += differ < np.uint64(1 << (64 - 8 * k)) if k < 8 else differ == 0
            h = np.minimum(h + alike, LENGTH)
            length[live] = h
            live = live[(alike == 8) & (h < LENGTH)]
        common[place] = length
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    by_order = np.empty(n, np.int64)
    by_order[rank] = common
    return by_order


def smallest_ids(stretches: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each string of LENGTH bytes in some stretches the smallest id of a stretch that has it.

    Returns the ids, stretch by stretch; then the places of one string of each
    kind, in sorted order, and the number of the kind of each string.
    """
    codes = np.frombuffer(b"".join(stretches), np.uint8)
    lengths = np.fromiter(map(len, stretches), np.int64, len(stretches))
    n = lengths - LENGTH + 1
    places = _spans(np.cumsum(lengths) - lengths, n)
    order = suffix_array(codes)
    kinds = np.empty(len(codes), np.int64)
    kinds[order] = np.cumsum(common_prefixes(codes, order) < LENGTH)
    _, first, kind = np.unique(kinds[places], return_index=True, return_inverse=True)
    least = np.full(len(first), NO_ID)
    np.minimum.at(least, kind, np.repeat(ids, n))
    return least[kind], places[first], kind


FOUND = (
    "what string, id bigint, hash bigint, start int, n int, "  # repeat: strings to remove
    "shard string, part int, strings binary, places binary, ids binary, "  # strings of spread anchors, to be merged
    "stretch int"  # open: strings that may yet be repeats, with the place of the first in its shard's merged ones
)
_FOUND_TYPES = {
    "what": pa.string(), "id": pa.int64(), "hash": pa.int64(), "start": pa.int32(), "n": pa.int32(), "shard": pa.string(),
    "part": pa.int32(), "strings": pa.binary(), "places": pa.binary(), "ids": pa.binary(), "stretch": pa.int32(),
}


def _found(rows: int, /, **columns) -> pa.RecordBatch:
    """Rows of FOUND; columns not given are null."""
    arrays = [pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in _FOUND_TYPES.items()]
    return pa.RecordBatch.from_arrays(arrays, list(_FOUND_TYPES))


def _runs(ids: np.ndarray, starts: np.ndarray, n: np.ndarray, at: np.ndarray, least: np.ndarray, gone: bool = True):
    """Runs of strings to be removed (or, not ``gone``, of the others): the occurrence of each, its start and number.

    ``ids``, ``starts``, ``n``: of occurrences; ``at``: where the smallest ids of an occurrence's strings begin in ``least``.
    """
    owner = np.repeat(np.arange(len(ids)), n)
    wanted = (least[_spans(at, n)] < ids[owner]) == gone
    first = np.diff(owner, prepend=-1) != 0
    last = np.append(first[1:], True)[: len(first)]
    begins = np.flatnonzero(wanted & (first | ~np.append(False, wanted[:-1])[: len(wanted)]))
    stops = np.flatnonzero(wanted & (last | ~np.append(wanted[1:], False)[: len(wanted)]))
    place = np.cumsum(n) - n
    return owner[begins], starts[owner[begins]] + begins - place[owner[begins]], stops - begins + 1


class _Shards:
    """What repeats in each shard, from stretches in the order of their anchors."""

    def __init__(self, parts: int, shard_bytes: int = SHARD_BYTES):
        self.parts, self.shard_bytes = parts, shard_bytes

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, shard = TaskContext.get().partitionId(), 0
        held, distinct, size = [], {}, 0
        for batch in batches:
            anchors = batch.column(0).to_numpy()
            stretches = batch.column(4).to_pylist()
            begin = 0
            numbers = np.empty(len(stretches), np.int64)
            for i, key in enumerate(zip(anchors.tolist(), stretches, strict=True)):
                if key not in distinct:
                    if size >= self.shard_bytes:
                        held.append((batch.slice(begin, i - begin), numbers[begin:i].copy()))
                        yield from self._judged(f"{partition}-{shard}", held, distinct)
                        held, distinct, size, begin, shard = [], {}, 0, i, shard + 1
                    distinct[key] = len(distinct)
                    size += len(key[1])
                numbers[i] = distinct[key]
            held.append((batch.slice(begin), numbers[begin:].copy()))
        if distinct:
            yield from self._judged(f"{partition}-{shard}", held, distinct)

    def _judged(self, shard: str, held: list, distinct: dict) -> Iterator[pa.RecordBatch]:
        number = np.concatenate([x for _, x in held])
        ids, hashes, starts = (np.concatenate([b.column(c).to_numpy() for b, _ in held]) for c in (1, 2, 3))
        first_ids = np.full(len(distinct), NO_ID)
        np.minimum.at(first_ids, number, ids)
        stretches = [s for _, s in distinct]
        anchors = np.fromiter((a for a, _ in distinct), np.int64, len(distinct))
        n = np.fromiter(map(len, stretches), np.int64, len(stretches)) - LENGTH + 1
        least, places, kind = smallest_ids(stretches, first_ids)
        at = np.cumsum(n) - n
        owner, start, size = _runs(ids, starts, n[number], at[number], least)
        yield _found(len(owner), what=["repeat"] * len(owner), id=ids[owner], hash=hashes[owner], start=start, n=size)
        # The first and the last anchor may go on in other shards, with smaller ids.
        spread = (anchors == anchors[0]) | (anchors == anchors[-1])
        yield from self._merged(shard, b"".join(stretches), np.repeat(spread, n), least, places, kind)
        still = np.flatnonzero(spread[number])
        of = number[still]
        owner, start, size = _runs(ids[still], starts[still], n[of], at[of], least, gone=False)
        begin = (np.cumsum(np.where(spread, n, 0)) - np.where(spread, n, 0))[of[owner]] + start - starts[still[owner]]
        owner = still[owner]
        yield _found(
            len(owner), what=["open"] * len(owner), id=ids[owner], hash=hashes[owner], start=start, n=size,
            shard=[shard] * len(owner), stretch=begin,
        )

    def _merged(self, shard: str, data: bytes, spread: np.ndarray, least, places, kind) -> Iterator[pa.RecordBatch]:
        """The distinct strings of spread anchors by a hash, each part in sorted order, and the places that have them."""
        place = np.cumsum(spread) - 1
        strings = np.flatnonzero(spread)
        kinds, inverse = np.unique(kind[strings], return_inverse=True)
        codes = np.frombuffer(data, np.uint8)
        bytes_of = codes[places[kinds][:, None] + np.arange(LENGTH)]
        part = _words_hash(bytes_of) % np.uint64(self.parts)
        ids = np.full(len(kinds), NO_ID)
        np.minimum.at(ids, inverse, least[strings])
        # Kinds are numbered in sorted order, so a stable order by part keeps each part sorted.
        deal = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[deal], np.arange(self.parts + 1))
        places_of = np.argsort(inverse, kind="stable")
        ends = np.cumsum(np.bincount(inverse, minlength=len(kinds)))
        for p in np.unique(part).tolist():
            mine = deal[bounds[p] : bounds[p + 1]]
            counts = np.diff(ends, prepend=0)[mine]
            spots = place[strings[places_of[_spans(ends[mine] - counts, counts)]]]
            owners = np.repeat(np.arange(len(mine)), counts)
            yield _found(
                1, what=["strings"], shard=[shard], part=[p], strings=[bytes_of[mine].tobytes()],
                ids=[ids[mine].tobytes()], places=[np.stack([owners, spots]).astype(np.int32).tobytes()],
            )


def _words_hash(rows: np.ndarray) -> np.ndarray:
    total = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        total = total * _MIX + rows[:, k].astype(np.uint64) + np.uint64(1)
    return total ^ (total >> np.uint64(31))


MERGED = "shard string, places binary, ids binary"


def _merge(lists: pa.Table) -> pa.Table:
    """The smallest id of each string in several shards' sorted lists; back to each shard, by place."""
    lists = lists.combine_chunks()
    each = [np.frombuffer(s.as_buffer(), f"S{LENGTH}") for s in lists["strings"]]
    whole = np.unique(np.concatenate(each))
    least = np.full(len(whole), NO_ID)
    at = [np.searchsorted(whole, strings) for strings in each]
    for where, ids in zip(at, lists["ids"], strict=True):
        np.minimum.at(least, where, np.frombuffer(ids.as_buffer(), np.int64))
    rows = []
    for where, places in zip(at, lists["places"], strict=True):
        owners, spots = np.frombuffer(places.as_buffer(), np.int32).reshape(2, -1)
        rows.append((spots.tobytes(), least[where[owners]].tobytes()))
    return pa.table(
        [lists["shard"], pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())],
        ["shard", "places", "ids"],
    )


REPEAT = "id bigint, hash bigint, start int, n int"


def _settle(occurrences: pa.Table, merged: pa.Table) -> pa.Table:
    """Open occurrences of a shard against the merged ids of its strings."""
    places = [np.frombuffer(p.as_buffer(), np.int32) for p in merged["places"]]
    least = np.empty(sum(map(len, places)), np.int64)
    for spots, ids in zip(places, merged["ids"], strict=True):
        least[spots] = np.frombuffer(ids.as_buffer(), np.int64)
    ids, hashes, starts, n, at = (occurrences[c].to_numpy() for c in ("id", "hash", "start", "n", "stretch"))
    owner, start, size = _runs(ids, starts, n.astype(np.int64), at.astype(np.int64), least)
    columns = [pa.array(ids[owner]), pa.array(hashes[owner]), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32))]
    return pa.table(columns, ["id", "hash", "start", "n"])


def _cut(texts: pa.Array, starts: pa.Array, ns: pa.Array) -> pa.Array:
    """The bytes kept, how many are gone and in how many runs; null where nothing goes."""
    rows = []
    for text, start, n in zip(texts, starts, ns, strict=True):
        if not start.is_valid:
            rows.append(None)
            continue
        codes = np.frombuffer(text.as_buffer(), np.uint8)
        begin, n = start.values.to_numpy(), n.values.to_numpy()
        change = np.zeros(len(codes) + 1, np.int64)
        np.add.at(change, begin, 1)
        np.add.at(change, begin + n + LENGTH - 1, -1)
        gone = np.cumsum(change[:-1]) > 0
        runs = int((gone & ~np.append(False, gone[:-1])).sum())
        rows.append({"kept": codes[~gone].tobytes(), "n_removed": int(gone.sum()), "n_spans": runs})
    return pa.array(rows, pa.struct([("kept", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]))


def repeats(texts: DataFrame, copied: Bitmap, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``id, hash, start, n``: ``n`` strings from byte ``start`` on, in the row with that id and hash, also start in a
    row with a smaller id. ``texts``: id, text, hash, and whether a row counts even if its hash is ``copied``."""
    spark = texts.sparkSession
    with_python(texts)
    with sql_conf(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS}):
        met = texts.mapInArrow(_Anchors(copied).rows, "anchor bigint, n int").groupBy("anchor").agg(F.sum("n").alias("n"))
        shared = written(met.where("n > 1").select("anchor"), "anchors")
        stretches = texts.mapInArrow(_Stretches(copied, Bitmap(shared, F.col("anchor"))).rows, STRETCH)
        # The last two keys spread the occurrences of an anchor that very many documents hold.
        dealt = stretches.repartitionByRange("anchor", "stretch", "id").sortWithinPartitions("anchor", "stretch")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = written(dealt.mapInArrow(_Shards(parts, shard_bytes).rows, FOUND), "repeats")
        merged = written(
            found.where("what = 'strings'").select("shard", "part", "strings", "places", "ids").groupBy("part").applyInArrow(_merge, MERGED),
            "merged",
        )
        still = found.where("what = 'open'").select("id", "hash", "start", "n", "shard", "stretch")
        settled = still.groupBy("shard").cogroup(merged.groupBy("shard")).applyInArrow(_settle, REPEAT)
        return written(found.where("what = 'repeat'").select("id", "hash", "start", "n").unionByName(settled), "all-repeats")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """``docs`` with three more columns: ``kept`` (the bytes left, as binary: a cut may split a character),
    ``n_removed`` and ``n_spans`` (runs removed).

    Ids are taken as longs; a null id is larger than any other, and null ids
    are equal. Rows with one id never take from each other. A null text is
    empty. No documents give no rows. A new column whose name ``docs`` has gets
    underscores before it.
    """
    names = {c: f"d_{i}" for i, c in enumerate(docs.columns)}
    text = text_or_empty(F.col(names[text_col]))
    rows = docs.select(*(F.col(c).alias(names[c]) for c in docs.columns)).select(
        "*",
        F.coalesce(F.col(names[id_col]).cast("bigint"), F.lit(NO_ID)).alias("id"),
        text.alias("text"),
        F.xxhash64(text).alias("hash"),
    )
    with_python(docs)
    digest = F.unhex(F.sha2("text", 256))
    copies = rows.select("id", "hash", digest.alias("digest")).groupBy("hash", "digest")
    copies = copies.agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    copies = written(copies.select("hash", F.col("digest").alias("c_digest"), "first"), "copies")
    # The bitmaps keep texts out of joins that can't concern them.
    copied = Bitmap(copies, F.col("hash"))
    met = rows.where(copied.column(F.col("hash"))).select("id", "text", "hash", digest.alias("digest"))
    met = met.join(copies.drop("hash"), F.col("digest") == F.col("c_digest"), "left")
    firsts = met.where("first IS NULL OR first = id").select("id", "text", "hash", F.lit(True).alias("sure"))
    texts = rows.select("id", "text", "hash", F.lit(False).alias("sure")).unionByName(firsts)
    found = repeats(texts, copied, shard_bytes)
    later = met.where("first < id").select("id", "hash").distinct().withColumn("spans", F.lit(None).cast("array<struct<start:int,n:int>>"))
    spans = found.groupBy("id", "hash").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    spans = written(spans.unionByName(later), "spans")
    touched = Bitmap(spans, F.xxhash64("id", "hash")).column(F.xxhash64("id", "hash"))
    some = rows.withColumn("touched", touched)
    spans = spans.select(F.col("id").alias("s_id"), F.col("hash").alias("s_hash"), "spans")
    met = some.where("touched").join(spans, (F.col("id") == F.col("s_id")) & (F.col("hash") == F.col("s_hash")), "left")
    cut = F.arrow_udf(_cut, "kept binary, n_removed bigint, n_spans bigint")
    met = met.withColumn("cut", cut(F.col("text"), F.col("spans.start"), F.col("spans.n")))
    size, none = F.octet_length("text").cast("bigint"), F.lit(0).cast("bigint")
    all_bytes = F.col("text").cast("binary")
    # Without spans: a copy of a text with a smaller id.
    whole = F.col("s_id").isNotNull() & F.col("spans").isNull() & (size >= LENGTH)
    changed = {
        "kept": F.when(whole, F.lit(bytearray())).otherwise(F.coalesce("cut.kept", all_bytes)),
        "n_removed": F.when(whole, size).otherwise(F.coalesce("cut.n_removed", none)),
        "n_spans": F.when(whole, F.lit(1).cast("bigint")).otherwise(F.coalesce("cut.n_spans", none)),
    }
    plain = {"kept": all_bytes, "n_removed": none, "n_spans": none}

    def named(part: DataFrame, new: dict) -> DataFrame:
        own = (F.col(at).alias(c) for c, at in names.items())
        return part.select(*own, *(column.alias(free_name(docs, c)) for c, column in new.items()))

    return named(some.where("NOT touched"), plain).unionByName(named(met, changed))
