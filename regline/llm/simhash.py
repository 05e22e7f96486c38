"""SimHash near-duplicates by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most four bits, cut into three
segments, have a segment that differs in at most one bit. Every fingerprint is
therefore indexed under its segments with one bit removed (64 keys in all);
fingerprints that share a key are compared. Equal texts collapse to one
fingerprint first.

Within a key, the fingerprints are sorted and each is compared with its
nearest neighbours, which compares a small bucket whole. What a larger bucket
leaves uncompared is finished after a first round of components: only
fingerprints of different components are joined, so a large group of near
copies costs about its size and not its square, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regline.llm.common import free_name, text_or_empty, with_python, written
from regline.llm.graph import components

SHINGLE_WORDS = 4
SEED = 42
MAX_DISTANCE = 4
#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Bits of the longest segment that remain when one is removed.
KEY_BITS = 21
#: Each fingerprint of a key is compared with so many before it; larger buckets are finished by a join.
NEIGHBOURS = 48
#: Rows of sorted keys that a task compares at a time.
CHUNK = 250_000
#: Hashes whose bits are counted at a time.
HASHES = 1 << 17


def shingle_hashes(text: str, words: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of every run of ``words`` words, repeats included; of the whole sequence if it is shorter."""
    from xxhash import xxh64_intdigest

    found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not found:
        return []
    joined = b" ".join(found)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)]
    if len(found) < words:
        return [xxh64_intdigest(joined, SEED)]
    return [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :], strict=False)]


def _bit_counts(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit set; 64 counts, lowest bit first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES):
        part = np.array(hashes[at : at + HASHES], "<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprint_of(text: str) -> int:
    """Signed 64-bit SimHash: a bit is 1 if set in over half the hashes."""
    hashes = shingle_hashes(text)
    bits = _bit_counts(hashes) * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: Column) -> Column:
    """SimHash of a text column as a signed long; null and wordless texts give zero."""
    udf = F.arrow_udf(lambda texts: pa.array([fingerprint_of(t.as_py()) for t in texts], pa.int64()), "bigint")
    return udf(text_or_empty(text))


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def variants(fingerprints: DataFrame) -> DataFrame:
    """``fp`` -> ``(key, fp)`` for each of the 64 bits: the bit's number and its segment without it.

    Bit number and segment fit into 27 bits.
    """
    bit = F.col("bit")
    first = F.when(bit < SEGMENTS[1][0], SEGMENTS[0][0]).when(bit < SEGMENTS[2][0], SEGMENTS[1][0]).otherwise(SEGMENTS[2][0])
    width = F.when(bit < SEGMENTS[1][0], SEGMENTS[0][1]).otherwise(SEGMENTS[1][1])
    parts = fingerprints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit")).select(
        "fp", "bit", (bit - first).alias("at"), first.alias("first"), width.alias("width")
    )
    return parts.select(
        F.expr(
            "CAST((CAST(bit AS BIGINT) << {k}) "
            "| (((shiftrightunsigned(fp, first) & ((1L << width) - 1)) >> (at + 1)) << at) "
            "| (shiftrightunsigned(fp, first) & ((1L << at) - 1)) AS INT)".format(k=KEY_BITS)
        ).alias("key"),
        "fp",
    )


def own_bit(x: np.ndarray) -> np.ndarray:
    """The bit under which a pair with these differing bits is compared: of the first segment that
    differs in at most one bit, the differing bit, or else the segment's first."""
    out = np.full(len(x), -1, np.int64)
    for first, width in reversed(SEGMENTS):
        part = (x >> np.uint64(first)) & np.uint64((1 << width) - 1)
        count = np.bitwise_count(part)
        position = np.bitwise_count(part - np.uint64(1)).astype(np.int64)  # of a single bit: its place
        out = np.where(count == 0, first, np.where(count == 1, first + position, out))
    return out


def _spanning(pairs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Those pairs that connect what earlier ones have not."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for a, b in pairs:
        if (ra := root(a)) != (rb := root(b)):
            parent[ra] = rb
            yield a, b


def compare_sorted(keys: np.ndarray, fps: np.ndarray, neighbours: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of equal key, and which rows belong to buckets left unfinished.

    ``keys`` is sorted. Buckets are unfinished if they have more than
    ``neighbours + 1`` rows, or may go on before the first or after the last row.
    """
    n = len(keys)
    x = fps.view(np.uint64)
    links = []
    for step in range(1, min(neighbours, n - 1) + 1):
        at = np.flatnonzero(keys[step:] == keys[:-step])
        if not len(at):
            break
        differ = x[at] ^ x[at + step]
        near = np.bitwise_count(differ) <= MAX_DISTANCE
        at, differ = at[near], differ[near]
        at = at[own_bit(differ) == keys[at] >> KEY_BITS]
        links.append(np.stack([fps[at], fps[at + step]], axis=1))
    pairs = np.concatenate(links) if links else np.empty((0, 2), np.int64)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, n])
    unfinished = sizes > neighbours + 1
    unfinished[[0, -1]] = True
    return np.array(list(_spanning(pairs.tolist())), np.int64).reshape(-1, 2), np.repeat(unfinished, sizes)


def _comparer(neighbours: int, chunk_rows: int):
    """Sorted ``(key, fp)`` -> links ``(null, a, b)`` and rows of unfinished buckets ``(key, fp, null)``."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= chunk_rows:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
        if rows:
            yield pa.Table.from_batches(held)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            keys, fps = (chunk[c].to_numpy() for c in ("key", "fp"))
            pairs, unfinished = compare_sorted(keys, fps, neighbours)
            left = int(unfinished.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None] * len(pairs) + keys[unfinished].tolist(), pa.int32()),
                    pa.array(np.r_[pairs[:, 0], fps[unfinished]], pa.int64()),
                    pa.array(pairs[:, 1].tolist() + [None] * left, pa.int64()),
                ],
                ["key", "a", "b"],
            )

    return compare


def _with_component(rows: DataFrame, labels: DataFrame, fp: str = "fp") -> DataFrame:
    """Add ``comp``: the component of ``fp``, or itself where it has no links."""
    labels = labels.withColumnRenamed("node", fp)
    return rows.join(labels, fp, "left").withColumn("comp", F.coalesce("component", fp)).drop("component")


def linked_components(fingerprints: DataFrame, neighbours: int = NEIGHBOURS, chunk_rows: int = CHUNK) -> DataFrame:
    """Distinct ``fp`` rows -> ``(fp, comp)``: the smallest fingerprint, as a signed number, that links reach.

    ``neighbours`` and ``chunk_rows`` divide the work; the result doesn't depend on them.
    """
    with_python(fingerprints)
    keyed = variants(fingerprints)
    tasks = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ranges of (key, fp) cut even a key that a third of all fingerprints share.
    ordered = keyed.repartitionByRange(tasks, "key", "fp").sortWithinPartitions("key", "fp")
    compared = written(ordered.mapInArrow(_comparer(neighbours, chunk_rows), "key int, a bigint, b bigint"), "compared")
    links = compared.where("key IS NULL").select("a", "b")
    first = components(links)

    members = compared.where("key IS NOT NULL").select("key", F.col("a").alias("fp"))
    members = written(_with_component(members, first), "members")
    sizes = members.groupBy("key", "comp").count()
    # The component with most members of a bucket, where it has several. Pairs within it need no look.
    main = written(
        sizes.groupBy("key")
        .agg(F.max_by("comp", F.struct("count", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"))
        .where("comps > 1")
        .select("key", "main"),
        "buckets",
    )
    open_members = members.join(main, "key")
    rest = open_members.where("comp <> main").select("key", F.col("fp").alias("a"), F.col("comp").alias("comp_a"))
    every = open_members.select(F.col("key").alias("key_b"), F.col("fp").alias("b"), F.col("comp").alias("comp_b"))
    met = (F.col("key") == F.col("key_b")) & (F.col("comp_a") != F.col("comp_b")) & (_distance("a", "b") <= MAX_DISTANCE)
    across = written(rest.join(every, met).select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct(), "across")
    second = components(across)
    at_first = _with_component(fingerprints.select("fp"), first).withColumnRenamed("comp", "fp_first")
    return _with_component(at_first, second, "fp_first").select("fp", "comp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, fp, component_id``, the smallest id among all rows that links reach.

    Fingerprints link at MAX_DISTANCE or fewer differing bits. Null, empty and
    wordless texts have fingerprint zero and link like any other. Null ids do
    not count as smallest; where a component has no other, component_id is
    null. Repeated rows each get a row. No rows give no rows.
    """
    rows = _fingerprints(docs, id_col, text_col)
    grouped = _grouped(rows)
    least = grouped.groupBy("comp").agg(F.min("best.id").alias("component_id"))
    of_fp = written(grouped.join(least, "comp").select("fp", "component_id"), "components")
    return rows.join(of_fp, "fp").select("id", "fp", "component_id")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(text_or_empty(text))


def _fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    with_python(docs)
    text = F.col(text_col)
    return written(
        docs.select(
            F.col(id_col).cast("bigint").alias("id"), _text_hash(text).alias("text_hash"), fingerprint(text).alias("fp")
        ),
        "fingerprints",
    )


def _grouped(rows: DataFrame) -> DataFrame:
    """``(fp, best, comp)``: per distinct fingerprint its first row, by id (null last) and hash of the text."""
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("best")
    groups = written(rows.groupBy("fp").agg(first), "groups")
    return written(linked_components(groups).join(groups, "fp"), "grouped")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the row with the smallest id (null last), with all its columns.

    Of rows that share this id, the one with the smallest hash of its text stays.
    """
    key = free_name(docs, "id_and_text")
    kept = (
        _grouped(_fingerprints(docs, id_col, text_col))
        .groupBy("comp")
        .agg(F.min("best").alias("best"))
        .select(_row_key(F.col("best.id"), F.col("best.text_hash")).alias(key))
    )
    rows = docs.withColumn(key, _row_key(F.col(id_col).cast("bigint"), _text_hash(F.col(text_col))))
    return rows.join(kept, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def _row_key(ident: Column, text_hash: Column) -> Column:
    return F.concat_ws(" ", text_hash.cast("string"), ident.cast("string"))
