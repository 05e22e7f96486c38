"""Phrase collocations, counted in suffix subtrees of vertically partitioned prefixes.

The suffixes of every piece, cut to MAX_WORDS words, are leaves. Leaves are put
into groups by a prefix of their words: the first word alone where its leaves
fit the memory budget, more words where they don't. Each group's subtree is
built by itself, by sorting its leaves, and a node's count is the total of the
leaves below it; nodes above the prefix of their leaves were counted when the
prefixes were chosen.

Before that, two passes count words and pairs of neighbours, and a suffix ends
where a word or a pair is too rare to be in any phrase that is reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regline.llm.bitmap import Bitmap
from regline.llm.common import text_or_empty, with_python, written

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: Percent of a phrase's count from which a longer candidate around it drops it.
COVERED = 100
#: Leaves that a task holds at once, unless there are few in all.
GROUP_LEAVES = 1 << 20
#: Bytes of text that a pass takes at a time.
CHUNK_BYTES = 4 << 20
NO_LANGUAGE = "und"

# A-Z lower-cased, every piece separator a line feed, tab a space.
_CLEAN = bytearray(range(256))
_CLEAN[65:91] = range(97, 123)
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _CLEAN[_c] = 10
_CLEAN[9] = 32
_CLEAN = bytes(_CLEAN)
_BREAK = b"\xff"  # not in any UTF-8 text


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], list[bytes], np.ndarray]]:
    """By language: the words of some texts in order, the distinct ones, and the place of each word among these.

    The first distinct word stands for the end of a piece.
    """
    for batch in batches:
        held, size = {}, 0
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            data = text.as_buffer().to_pybytes().translate(_CLEAN)
            held.setdefault(lang.as_py(), []).append(data)
            size += len(data)
            if size >= CHUNK_BYTES:
                yield from _numbered(held)
                held, size = {}, 0
        yield from _numbered(held)


def _numbered(held: dict[str, list[bytes]]) -> Iterator[tuple[str, list[bytes], list[bytes], np.ndarray]]:
    for lang, texts in held.items():
        words = (b"\n" + b"\n".join(texts)).replace(b"\n", b" " + _BREAK + b" ").split()
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        yield lang, words, list(number), np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, _, distinct, codes in _chunks(batches):
        n = np.bincount(codes, minlength=len(distinct))[1:]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(n), pa.string()), _strings(distinct[1:]), pa.array(n)], ["lang", "word", "n"]
        )


def _hashes(lang: str, distinct: list[bytes]) -> np.ndarray:
    """XXH64 as Spark's ``xxhash64(lang, word)`` gives it."""
    from xxhash import xxh64_intdigest

    seed = xxh64_intdigest(lang.encode(), 42)
    return np.fromiter((xxh64_intdigest(w, seed) for w in distinct), np.uint64, len(distinct))


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class _Pairs:
    """Pairs of frequent words, by their places in a chunk."""

    def __init__(self, words: Bitmap):
        self.words = words

    def hashes(self, lang: str, distinct: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        hashes = _hashes(lang, distinct)
        usable = self.words.has(hashes)
        usable[0] = False
        return hashes, usable

    def counts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, _, distinct, codes in _chunks(batches):
            hashes, usable = self.hashes(lang, distinct)
            there = usable[codes]
            at = np.flatnonzero(there[:-1] & there[1:])
            pairs, n = np.unique(codes[at] << 32 | codes[at + 1], return_counts=True)
            pairs = _pair_hash(hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])


class _Leaves(_Pairs):
    """Suffixes of two words or more in which every pair may be frequent, and how often each is in a chunk."""

    def __init__(self, words: Bitmap, pairs: Bitmap, max_words: int):
        super().__init__(words)
        self.pairs, self.max_words = pairs, max_words

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, distinct, codes in _chunks(batches):
            hashes, usable = self.hashes(lang, distinct)
            there = usable[codes]
            at = np.flatnonzero(there[:-1] & there[1:])
            at = at[self.pairs.has(_pair_hash(hashes[codes[at]], hashes[codes[at + 1]]))]
            linked = np.zeros(len(codes), np.int64)
            linked[at] = 1
            run = linked.copy()
            for _ in range(self.max_words - 2):
                run[:-1] = linked[:-1] * (1 + run[1:])
            length = run[at] + 1
            leaf = codes[at]
            for d in range(1, self.max_words):
                longer = np.flatnonzero(length > d)
                key = leaf << 32
                key[longer] |= codes[at[longer] + d]  # never 0, which ends a piece
                leaf = np.unique(key, return_inverse=True)[1]
            _, first, n = np.unique(leaf, return_index=True, return_counts=True)
            begins, lengths = at[first].tolist(), length[first]
            text = [b" ".join(words[b : b + k]) for b, k in zip(begins, lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), _strings(text), pa.array(lengths.astype(np.int32)), pa.array(n)],
                ["lang", "suffix", "words", "n"],
            )


def _subtree(leaves: pa.Table, min_count: int) -> pa.Table:
    """The frequent nodes of a group: ``lang, phrase, words, f``, at or below the prefix of their leaves."""
    leaves = leaves.combine_chunks()
    parts = pc.split_pattern(leaves["suffix"], " ").combine_chunks()
    length = leaves["words"].to_numpy().astype(np.int64)
    depth, n = leaves["depth"].to_numpy(), leaves["n"].to_numpy()
    codes = parts.flatten().dictionary_encode().indices.to_numpy()
    width = int(length.max(initial=0))
    tree = np.full((len(length), width + 1), -1, np.int64)
    tree[:, 0] = leaves["lang"].combine_chunks().dictionary_encode().indices.to_numpy()
    begins = np.cumsum(length) - length
    tree[np.repeat(np.arange(len(length)), length), np.arange(len(codes)) - np.repeat(begins, length) + 1] = codes
    order = np.lexsort(tree.T[::-1])
    tree, length, depth, n = tree[order], length[order], depth[order], n[order]
    suffixes = leaves["suffix"]
    new = np.ones(len(length), bool)
    new[1:] = (tree[1:, :2] != tree[:-1, :2]).any(axis=1)
    found = {"lang": [], "phrase": [], "words": [], "f": []}
    for d in range(2, width + 1):
        new[1:] |= tree[1:, d] != tree[:-1, d]
        starts = np.flatnonzero(new)
        f = np.add.reduceat(n, starts)
        for i in np.flatnonzero((length[starts] >= d) & (depth[starts] <= d) & (f >= min_count)).tolist():
            row = int(order[starts[i]])
            found["lang"].append(leaves["lang"][row].as_py())
            found["phrase"].append(" ".join(suffixes[row].as_py().split(" ")[:d]))
            found["words"].append(d)
            found["f"].append(int(f[i]))
    return pa.table(found, pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())]))


def _with_prefix(leaves: DataFrame, budget: int, max_words: int) -> tuple[DataFrame, list[DataFrame]]:
    """``leaves`` with ``depth``, the number of words of the prefix that deals them out, and the counts of the
    nodes above those prefixes.

    Tasks look prefixes with too many leaves up in a bitmap. Another prefix that it takes for one of them is dealt
    out by one word more as well, and its node is counted here in the same way.
    """
    above = []
    leaves = leaves.withColumn("depth", F.lit(1))
    for d in range(1, max_words):
        prefix = F.substring_index("suffix", " ", d)
        # Only leaves of a prefix that was split before can have too many again.
        open_leaves = leaves.where((F.col("depth") == d) & (F.col("words") >= d))
        over = open_leaves.groupBy("lang", prefix.alias("phrase")).agg(F.count(F.lit(1)).alias("leaves"))
        over = written(over.where(F.col("leaves") > budget).select("lang", "phrase"), "split-prefixes")
        if over.isEmpty():  # so that no longer prefix can have more either
            break
        split = Bitmap(over, F.xxhash64("lang", "phrase")).column(F.xxhash64("lang", prefix))
        split = (F.col("depth") == d) & (F.col("words") >= d) & split
        leaves = leaves.withColumn("depth", F.when(split, d + 1).otherwise(F.col("depth")))
        if d > 1:
            counted = leaves.where(F.col("depth") > d).groupBy("lang", prefix.alias("phrase")).agg(F.sum("n").alias("f"))
            above.append(written(counted.select("lang", "phrase", F.lit(d).alias("words"), "f"), "split-counts"))
    return leaves, above


def phrase_counts(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    group_leaves: int = GROUP_LEAVES,
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, f`` of every phrase of 1 to ``max_words`` words found ``min_count`` times or more, and
    ``lang, n``, the words of each language.

    Null texts are empty, a null language is NO_LANGUAGE. Overlapping
    occurrences count. No documents give no rows.
    """
    spark = docs.sparkSession
    with_python(docs)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE))
    texts = docs.select(lang.alias("lang"), text_or_empty(F.col(text_col)).alias("text"))
    counted = texts.mapInArrow(_word_counts, "lang string, word string, n bigint")
    words = written(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    frequent = words.where(F.col("n") >= min_count)
    known = Bitmap(frequent, F.xxhash64("lang", "word"))
    pairs = texts.mapInArrow(_Pairs(known).counts, "pair bigint, n bigint")
    pairs = written(pairs.groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count).select("pair"), "pairs")
    leaves = _Leaves(known, Bitmap(pairs, F.col("pair")), max_words)
    leaves = written(texts.mapInArrow(leaves.rows, "lang string, suffix string, words int, n bigint"), "leaves")
    total = leaves.count()
    # Groups are smaller than memory asks for where the tasks would be fewer than the session's.
    budget = max(1, min(group_leaves, total // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    leaves, above = _with_prefix(leaves, budget, max_words)
    group = F.pmod(F.xxhash64("lang", F.expr("substring_index(suffix, ' ', depth)")), F.lit(-(-2 * total // budget) or 1))
    nodes = (
        leaves.withColumn("group", group)
        .groupBy("group")
        .applyInArrow(
            lambda leaves: _subtree(leaves, min_count), "lang string, phrase string, words int, f bigint"
        )
    )
    for over in above:
        nodes = nodes.unionByName(over.where(F.col("f") >= min_count))
    single = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), F.col("n").alias("f"))
    return written(nodes.unionByName(single), "phrases"), words.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    covered: int = COVERED,
    group_leaves: int = GROUP_LEAVES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of two words or more.

    Of a phrase of count ``a`` cut in two with counts ``l`` and ``r`` the score
    is ``floor(1000 * a * n / (l * r))``; the cut with the lowest score counts,
    of equal ones the first. Phrases inside a longer candidate with ``covered``
    percent of their count or more are left out. Order: score and count
    descending, then the phrase's bytes.
    """
    counts, totals = phrase_counts(docs, lang_col, text_col, min_count, max_words, group_leaves)
    candidates = counts.where("words > 1")
    split = F.split("phrase", " ")

    def joined(first, length):
        return F.array_join(F.slice(split, first, length), " ")

    cuts = (
        candidates.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
        .withColumn("left", joined(F.lit(1), F.col("k")))
        .withColumn("right", joined(F.col("k") + 1, F.col("words") - F.col("k")))
    )
    left = counts.select(F.col("lang"), F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select(F.col("lang"), F.col("phrase").alias("right"), F.col("f").alias("r"))
    # Products pass 64 bits; 38 digits hold them to 10^12 occurrences of 10^13 words.
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    exact = {c: f"CAST({c} AS DECIMAL(15, 0))" for c in "alrn"}
    score = F.expr(f"CAST(1000 AS DECIMAL(4, 0)) * {exact['a']} * {exact['n']} div ({exact['l']} * {exact['r']})")
    scored = scored.withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("c"))
    inside = candidates.where("words > 2").select(
        "lang", F.col("f").alias("around"), split.alias("w"), F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("k")
    )
    inside = inside.select("lang", "around", "w", "k", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)).alias("i"))
    inside = inside.select("lang", F.expr("array_join(slice(w, i, k), ' ')").alias("phrase"), "around")
    around = inside.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = lowest.select("lang", "phrase", "c.*").join(around, ["lang", "phrase"], "left")
    kept = kept.where(F.col("around").isNull() | (100 * F.col("around") < covered * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
