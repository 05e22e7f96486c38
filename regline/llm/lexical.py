"""Ranked lexical search over posting lists cut into blocks of similar documents.

Documents are dealt out in shards of bounded size, similar ones together. In a
shard each term's posting list is clustered by document similarity into blocks
(geometric blocking): some of its documents serve as pivots and every document
goes to the most similar one, compared in a random projection of the weighted
terms. A block stores the coordinatewise maximum of its documents' vectors,
rounded up to a byte; its product with a query bounds every score in the block.

A search first scores, per item and shard, the block with the highest bound.
The lowest of the best scores found so is a threshold that the true answer
can't be under. Then blocks whose bound is below it are skipped, and the
documents of all others are scored exactly. Nothing is skipped on a guess, so
the result is that of scoring every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regline.llm.bitmap import Bitmap
from regline.llm.common import text_or_empty, with_python, written
from regline.plans.ingest import sql_conf
from regline.session import fresh_dir

TOP = 50
#: Characters that are not part of a term.
BETWEEN = "\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F"
#: Documents of a shard, fewer if they would have more than SHARD_CELLS cells with the shard's terms.
SHARD_DOCS = 256
SHARD_CELLS = 1 << 18
#: Documents of a block, about.
BLOCK = 64
#: Dimensions in which documents are compared.
DIMENSIONS = 32
#: Items searched at once: their terms are sent to the tasks.
ITEMS_AT_ONCE = 1000
#: Bytes of text that are counted at a time.
CHUNK_BYTES = 1 << 20
#: Documents and shards that a task takes at a time; a shard's row is a few MB.
BATCH_DOCS, BATCH_SHARDS = "200", "2"
#: Of a bitmap of the queries' terms: few other terms get into the index.
BITS_EACH = 4096
#: A writer looks at its buffers after 100 rows at first, which is much for rows of this size.
LARGE_ROWS = {
    "parquet.enable.dictionary": "false",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size.row.check.min": "1",
    "parquet.block.size.row.check.min": "1",
}
NO_ID = (1 << 63) - 1  # stands for a null id, which comes last

_CLEAN = bytearray(b" " * 128) + bytes(range(128, 256))
for _c in range(128):
    if chr(_c).isalnum():
        _CLEAN[_c] = ord(chr(_c).lower())
_CLEAN = bytes(_CLEAN)
_END = b"\x00"  # between texts; not part of any term

COUNTED = "id bigint, n bigint, terms array<string>, tfs array<bigint>"
SHARD = (
    "ids array<bigint>, terms array<string>, ends binary, places binary, impacts binary, "
    "block_terms binary, block_ends binary, members binary, step bigint, summary binary"
)


def terms_of(text: Column) -> Column:
    """The distinct terms of a text; null has none."""
    lower = F.translate(text_or_empty(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.regexp_extract_all(lower, F.lit(f"[^{BETWEEN}]+"), F.lit(0)))


class _Counter:
    """Per text its number of terms, and the counts of those in a set."""

    def __init__(self, wanted: Bitmap):
        self.wanted = wanted

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            held, size, begin = [], 0, 0
            for i, text in enumerate(batch.column(1)):
                held.append(text.as_buffer().to_pybytes().translate(_CLEAN))
                size += len(held[-1])
                if size >= CHUNK_BYTES or i == len(ids) - 1:
                    yield self._counted(ids[begin : i + 1], held)
                    held, size, begin = [], 0, i + 1

    def _counted(self, ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        from xxhash import xxh64_intdigest

        words = (b" " + _END + b" ").join([b"", *texts]).split()  # each text begins with a mark
        distinct = list(dict.fromkeys([_END, *words]))
        number = {w: i for i, w in enumerate(distinct)}
        codes = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        text = np.cumsum(codes == 0) - 1
        n = np.bincount(text, minlength=len(texts)) - 1
        wanted = self.wanted.has(np.fromiter((xxh64_intdigest(w, 42) for w in distinct), np.uint64, len(distinct)))
        wanted[0] = False
        there = wanted[codes]
        found, tfs = np.unique(text[there] << 32 | codes[there], return_counts=True)
        ends = np.searchsorted(found >> 32, np.arange(len(texts) + 1)).astype(np.int32)
        terms = pa.array(distinct, pa.binary()).cast(pa.string()).take(pa.array(found & 0xFFFFFFFF))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(n), pa.ListArray.from_arrays(ends, terms), pa.ListArray.from_arrays(ends, pa.array(tfs))],
            ["id", "n", "terms", "tfs"],
        )


def _blocks_of(places: np.ndarray, docs: np.ndarray, spots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posting lists cut into blocks. ``places`` and ``docs``: term and document of each posting; ``spots``: where
    documents lie. Returns each block's term, where its documents end, and the documents."""
    order = np.argsort(places, kind="stable")
    places, docs = places[order], docs[order]
    cluster = np.zeros(len(places), np.int64)
    starts = np.flatnonzero(np.diff(places, prepend=-1))
    sizes = np.diff(np.append(starts, len(places)))
    for start, size in zip(starts[sizes > BLOCK].tolist(), sizes[sizes > BLOCK].tolist(), strict=True):
        near = spots[docs[start : start + size]]
        pivots = near[np.random.default_rng(size).permutation(size)[: -(-size // BLOCK)]]
        cluster[start : start + size] = (near @ pivots.T).argmax(axis=1)
    order = np.lexsort((cluster, places))
    places, docs, cluster = places[order], docs[order], cluster[order]
    first = np.flatnonzero(np.diff(places << 32 | cluster, prepend=-1))
    return places[first], np.append(first[1:], len(docs)), docs


class _Builder:
    """Shards from documents as they come."""

    def __init__(self, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = [], set()
        for batch in batches:
            for doc in batch.to_pylist():
                seen.update(doc["terms"])
                held.append(doc)
                if len(held) >= SHARD_DOCS or len(held) * len(seen) >= SHARD_CELLS:
                    yield self._shard(held)
                    held, seen = [], set()
        if held:
            yield self._shard(held)

    def _shard(self, docs: list[dict]) -> pa.RecordBatch:
        from xxhash import xxh64_intdigest

        terms = list(dict.fromkeys(t for doc in docs for t in doc["terms"]))
        number = {t: i for i, t in enumerate(terms)}
        sizes = np.fromiter((len(doc["terms"]) for doc in docs), np.int64, len(docs))
        places = np.fromiter((number[t] for doc in docs for t in doc["terms"]), np.int64, sizes.sum())
        tfs = np.fromiter((tf for doc in docs for tf in doc["tfs"]), np.int64, sizes.sum())
        lengths = np.fromiter((doc["n"] for doc in docs), np.int64, len(docs))
        m = 50 + (50 * lengths * self.n_docs) // self.n_terms
        owner = np.repeat(np.arange(len(docs)), sizes)
        impacts = (1_000_000_000 * tfs) // (1000 * tfs + 20 * m[owner])
        step = int(impacts.max()) // 255 + 1
        levels = np.zeros((len(docs), len(terms)), np.uint8)
        levels[owner, places] = -(-impacts // step)
        signs = np.random.default_rng(xxh64_intdigest(terms[0])).choice(np.float32([-1, 1]), (len(terms), DIMENSIONS))
        spots = levels.astype(np.float32) @ signs
        spots /= np.linalg.norm(spots, axis=1, keepdims=True) + 1e-9
        block_terms, block_ends, members = _blocks_of(places, owner, spots)
        begins = np.append(0, block_ends[:-1])
        summary = np.empty((len(block_ends), len(terms)), np.uint8)
        for a in range(0, len(block_ends), BLOCK):
            b = min(a + BLOCK, len(block_ends))
            part = levels[members[begins[a] : block_ends[b - 1]]]
            summary[a:b] = np.maximum.reduceat(part, begins[a:b] - begins[a], axis=0)
        row = {
            "ids": [doc["id"] for doc in docs],
            "terms": terms,
            "ends": np.cumsum(sizes).tobytes(),
            "places": places.astype(np.int32).tobytes(),
            "impacts": impacts.astype(np.int32).tobytes(),
            "block_terms": block_terms.astype(np.int32).tobytes(),
            "block_ends": block_ends.astype(np.int64).tobytes(),
            "members": members.astype(np.int32).tobytes(),
            "step": step,
            "summary": zstandard.compress(summary.tobytes(), 1),  # few of a block's coordinates are not zero
        }
        types = [pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.binary()] * 6, pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], list(row))


class _Shard:
    """A shard against a block of items."""

    def __init__(self, row: dict, items: list[tuple[int, list[str], list[int]]]):
        self.ids = np.array(row["ids"], np.int64)
        number = {t: i for i, t in enumerate(row["terms"])}
        ends = np.frombuffer(row["ends"], np.int64)
        self.matrix = np.zeros((len(self.ids), len(number)))
        owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        self.matrix[owner, np.frombuffer(row["places"], np.int32)] = np.frombuffer(row["impacts"], np.int32)
        self.ends = np.frombuffer(row["block_ends"], np.int64)
        self.members = np.frombuffer(row["members"], np.int32)
        self.step = row["step"]
        self.summary = np.frombuffer(zstandard.decompress(row["summary"]), np.uint8).reshape(len(self.ends), len(number))
        block_terms = np.frombuffer(row["block_terms"], np.int32)  # in ascending order
        self.items = []
        for _, terms, weights in items:
            pairs = [(number[t], w) for t, w in zip(terms, weights, strict=True) if t in number]
            places, weights = np.array([p for p, _ in pairs], np.int64), np.array([w for _, w in pairs], np.float64)
            begin, end = np.searchsorted(block_terms, places), np.searchsorted(block_terms, places, "right")
            blocks = np.concatenate([np.arange(a, b) for a, b in zip(begin.tolist(), end.tolist(), strict=True)] or [begin])
            self.items.append((places, weights, blocks))

    def bounds(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        """The blocks of the item's terms, and what no score in each can pass. All sums are whole and under 2^53."""
        places, weights, blocks = self.items[item]
        return blocks, self.summary[np.ix_(blocks, places)].astype(np.float64) @ weights * self.step

    def scores(self, item: int, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents in some blocks and their exact scores."""
        inside = np.zeros(len(self.ids), bool)
        for b in blocks.tolist():
            inside[self.members[self.ends[b - 1] if b else 0 : self.ends[b]]] = True
        docs = np.flatnonzero(inside)
        places, weights, _ = self.items[item]
        return docs, self.matrix[np.ix_(docs, places)] @ weights


def _best(ids: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:top]
    return ids[order], scores[order]


class _Searcher:
    """Each item's best documents of a task. Without thresholds only the block with the highest bound is scored."""

    def __init__(self, items, top: int, thresholds: dict[int, int] | None = None):
        self.items, self.top, self.thresholds = items, top, thresholds

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = self.items.value
        nothing = (np.array([], np.int64), np.array([], np.float64))
        best = [nothing] * len(items)
        for batch in batches:
            for row in batch.to_pylist():
                shard = _Shard(row, items)
                for k, (number, _, _) in enumerate(items):
                    blocks, bounds = shard.bounds(k)
                    if self.thresholds is None:
                        blocks = blocks[bounds.argmax() :][:1] if len(blocks) else blocks
                    else:
                        blocks = blocks[bounds >= self.thresholds.get(number, 1)]
                    if len(blocks):
                        docs, scores = shard.scores(k, blocks)
                        ids, old = best[k]
                        best[k] = _best(np.append(ids, shard.ids[docs]), np.append(old, scores), self.top)
        for k, (number, _, _) in enumerate(items):
            ids, scores = best[k]
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(ids), pa.int64()), pa.array(ids), pa.array(scores.astype(np.int64))],
                    ["item", "id", "score"],
                )


class Index:
    """Shards over all documents, for the terms of ``queries``; any of these queries can be searched for.

    The index holds every document with such a term, and the counts that
    weights need are those of all documents.
    """

    def __init__(self, docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_col: str = "text"):
        spark = docs.sparkSession
        with_python(docs)
        asked = queries.select(F.explode(terms_of(F.col(query_col))).alias("term")).distinct()
        counter = _Counter(Bitmap(asked, F.xxhash64("term"), BITS_EACH))
        texts = docs.select(
            F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), text_or_empty(F.col(text_col)).alias("text")
        )
        with sql_conf(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_DOCS}):
            counted = written(texts.mapInArrow(counter.rows, COUNTED), "counted")
        totals = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        self.n_docs = totals.docs
        hashes = F.transform("terms", lambda t: F.xxhash64(t))
        again = F.transform("terms", lambda t: F.xxhash64(t, F.lit(1)))
        # Documents that share much likely share the smallest hash of a term; the last key spreads equal documents.
        keys = [F.array_min(hashes), F.array_min(again), F.xxhash64("id", "n")]
        some = counted.where(F.size("terms") > 0)
        dealt = some.select("*", *(k.alias(f"key{i}") for i, k in enumerate(keys)))
        dealt = dealt.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "key0", "key1", "key2")
        dealt = dealt.sortWithinPartitions("key0", "key1", "key2").select("id", "n", "terms", "tfs")
        with sql_conf(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_DOCS}):
            path = fresh_dir(spark, "shards")
            dealt.mapInArrow(_Builder(self.n_docs, totals.terms or 1).rows, SHARD).write.options(**LARGE_ROWS).parquet(path)
            self.shards = spark.read.schema(SHARD).parquet(path)
        self.frequencies = written(some.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "dfs")
        self.spark = spark

    def weighted(self, items: DataFrame, query_col: str) -> DataFrame:
        """``items`` with ``terms`` and their ``weights``; terms that no document holds are left out."""
        df, n = F.col("df").cast("double"), F.lit(float(self.n_docs))
        weight = F.floor(1000 * F.ln((2 * n + 2) / (2 * df + 1))).cast("bigint")
        pairs = items.select("item", F.explode(terms_of(F.col(query_col))).alias("term")).join(self.frequencies, "term")
        return pairs.groupBy("item").agg(F.collect_list(F.struct("term", weight.alias("weight"))).alias("terms"))

    def search(self, queries: DataFrame, id_col: str = "item_id", query_col: str = "text", top: int = TOP) -> DataFrame:
        """``item_id, rank, doc_id, score``: for each row of ``queries`` its ``top`` documents with a score above 0,
        highest first, equal scores by id, null ids last. Null queries and such without a known term find nothing."""
        items = written(
            queries.select(
                F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"), F.col(query_col).alias("query")
            ),
            "items",
        )
        weighted = written(self.weighted(items, "query"), "weighted")
        found = []
        block = []
        for row in weighted.toLocalIterator():
            block.append((row.item, [p.term for p in row.terms], [p.weight for p in row.terms]))
            if len(block) == ITEMS_AT_ONCE:
                found.append(self._search(block, top))
                block = []
        if block or not found:
            found.append(self._search(block, top))
        best = found[0]
        for more in found[1:]:
            best = best.unionByName(more)
        ids = F.nullif(F.col("id"), F.lit(NO_ID))
        return best.join(items, "item").select("item_id", "rank", ids.alias("doc_id"), "score")

    def _ranked(self, rows: DataFrame, top: int) -> DataFrame:
        order = Window.partitionBy("item").orderBy(F.desc("score"), "id")
        return rows.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= top)

    def _search(self, block: list, top: int) -> DataFrame:
        sent = self.spark.sparkContext.broadcast(block)
        with sql_conf(self.spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_SHARDS}):
            seeds = written(self.shards.mapInArrow(_Searcher(sent, top).rows, "item bigint, id bigint, score bigint"), "seeds")
            lowest = self._ranked(seeds, top).where(F.col("rank") == top).select("item", "score")
            thresholds = {row.item: max(1, row.score) for row in lowest.collect()}  # one for each item of the block
            searcher = _Searcher(sent, top, thresholds)
            rows = written(self.shards.mapInArrow(searcher.rows, "item bigint, id bigint, score bigint"), "found")
        return self._ranked(rows.where("score > 0"), top)
