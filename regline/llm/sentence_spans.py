"""Substring de-duplication by sliding sentence spans.

From every sentence on, a run of SPAN consecutive sentences (of more, where
they have fewer than MIN_WORDS words) is hashed, the hashes are joined over all
documents, and every sentence that lies in a repeated run other than the run's
first occurrence is removed. First is the smallest id, then hash of the text,
then position.

In scripts written without spaces (Chinese, Japanese, Thai and the like) each
character is a word, of which UNSPACED count as one for all lengths.
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

#: Sentences in a run.
SPAN = 3
#: A sentence of more words is cut after every word whose hash CUT divides. The places depend on the
#: words alone, so a long passage is cut alike wherever it stands and whatever was changed before it.
SENTENCE_WORDS = 16
CUT = 5
#: Runs of fewer words go on until they have as many.
MIN_WORDS = 10
#: Characters of a script without spaces that count as one word.
UNSPACED = 4
#: Texts hashed at a time; a text has as many hashes as sentences.
BATCH_ROWS = "2000"

# ASCII white space, and bytes that end a sentence.
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_STOP = np.isin(np.arange(256), list(b".!?"))


# By their first two bytes: UTF-8 characters of scripts without spaces, full-width forms and stops included.
_ALONE = np.zeros(1 << 16, bool)
for _from, _to in (
    (0xE0B8, 0xE0BF),  # Thai, Lao, Tibetan
    (0xE180, 0xE182),  # Myanmar
    (0xE19E, 0xE19F),  # Khmer
    (0xE2BA, 0xEA93),  # CJK, kana, Yi
    (0xEFA4, 0xEFAB),  # CJK compatibility
    (0xEFBC, 0xEFBF),  # full-width and half-width forms
    (0xF0A0, 0xF0BF),  # CJK extensions
):
    _ALONE[_from : _to + 1] = True
_WIDE_STOPS = [int.from_bytes(c.encode()) for c in "。！？｡"]


def _words(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Where words start and end, and which are characters of a script without spaces (None: no word is)."""
    in_word = ~_SPACE[codes]
    edges = np.flatnonzero(np.diff(in_word, prepend=False, append=False))
    long = np.flatnonzero(codes >= 0xE0)
    alone = long[_ALONE[codes[long].astype(np.int64) << 8 | codes[long + 1]]]
    if not len(alone):
        return edges[::2], edges[1::2], None
    begins = np.zeros(len(codes) + 1, bool)
    begins[edges[::2]] = True
    begins[alone] = True
    begins[alone + np.where(codes[alone] < 0xF0, 3, 4)] = True
    begins[:-1] &= in_word
    begins[-1] = False
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(in_word & (begins[1:] | ~np.append(in_word[1:], False))) + 1
    return starts, ends, np.isin(starts, alone)


def cut_text(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of a UTF-8 text start (with the text's length last) and end, the words at which sentences start
    (with the number of words last), and the length of the text up to each of these, in characters without spaces.

    A sentence ends with a word that ends in ``.``, ``!`` or ``?`` before
    another, with a full-width stop, or before a line feed; long ones are cut
    further.
    """
    codes = np.frombuffer(data.lower(), np.uint8)
    starts, ends, alone = _words(codes)
    if not len(starts):
        return np.array([len(data)]), np.array([], np.int64), np.array([0]), np.array([0])
    follows = np.append(starts[1:], len(data))
    feeds = np.concatenate([[0], np.cumsum(codes == 10)])
    stop = (_STOP[codes[ends - 1]] & (ends < len(data))) | (feeds[follows] > feeds[ends])
    # The sum of a word's bytes decides; a prefix sum gives it.
    sums = np.concatenate([[0], np.cumsum(codes, dtype=np.int64)])
    cut = (sums[ends] - sums[starts]) % CUT == 0
    units = np.arange(len(starts) + 1) * UNSPACED
    if alone is not None:
        units = np.concatenate([[0], np.cumsum(np.where(alone, 1, UNSPACED))])
        # Of characters, two together decide, and as many fewer are cut after.
        char = np.where(alone, sum(codes[np.minimum(starts + i, len(codes) - 1)].astype(np.int64) << 8 * (2 - i) for i in range(3)), 0)
        cut = np.where(alone, (char * 31 + np.append(0, char[:-1])) % 1_000_003 % (CUT * UNSPACED) == 0, cut)
        stop |= np.isin(char, _WIDE_STOPS)
    stop[-1] = True
    last = np.flatnonzero(stop)
    long = np.diff(units[last + 1], prepend=0) > SENTENCE_WORDS * UNSPACED
    bounds = np.flatnonzero(stop | (cut & np.repeat(long, np.diff(last, prepend=-1)))) + 1
    bounds = np.concatenate([[0], bounds])
    return np.append(starts, len(data)), ends, bounds, units[bounds]


def run_stops(units: np.ndarray) -> np.ndarray:
    """The sentence at which the run that starts at each sentence stops; one value for each start that has a whole run."""
    starts = np.arange(len(units) - 1)
    stops = np.maximum(starts + SPAN, np.searchsorted(units, units[:-1] + MIN_WORDS * UNSPACED))
    return stops[stops < len(units)]


def _parts(data: bytes) -> tuple[list[bytes], np.ndarray]:
    """The sentences, with what separates them, so that joined they give the text; and the lengths up to each."""
    starts, _, bounds, units = cut_text(data)
    edges = [0, *starts[bounds[1:]].tolist()]
    return [data[a:b] for a, b in zip(edges, edges[1:], strict=False)], units


def sentences(text: str) -> list[str]:
    return [part.decode("utf-8", "surrogatepass") for part in _parts(text.encode("utf-8", "surrogatepass"))[0]]


def span_hashes(text: str) -> tuple[bytes, int]:
    """XXH3-128 of the words of the run that starts at each sentence, one after the other, and the number of sentences;
    white space and ASCII case don't count."""
    from xxhash import xxh3_128_digest

    data = text.encode("utf-8", "surrogatepass").lower()
    starts, ends, bounds, units = cut_text(data)
    words = data.split()
    if len(words) < len(ends):
        words = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=False)]
    plain = b" ".join(words)
    at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])[bounds]
    stops = run_stops(units)
    hashes = (xxh3_128_digest(plain[a : b - 1]) for a, b in zip(at[: len(stops)].tolist(), at[stops].tolist(), strict=True))
    return b"".join(hashes), len(bounds) - 1


def without_spans(text: str, starts: list[int]) -> tuple[str, int]:
    """The text without the runs that start at these sentences, and how many sentences are gone."""
    parts, units = _parts(text.encode("utf-8", "surrogatepass"))
    stops = run_stops(units)
    gone = {i for start in starts for i in range(start, stops[start])}
    kept = b"".join(part for i, part in enumerate(parts) if i not in gone)
    return kept.decode("utf-8", "surrogatepass"), len(gone)


RUNS = "id bigint, text_hash bigint, n_sentences bigint, runs binary"
SPANS = "hi bigint, lo bigint, id bigint, text_hash bigint, start int"
MARKED = "id bigint, text_hash bigint, start int, hi bigint, lo bigint, part int"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's number of sentences and the hashes of its runs, one after the other."""
    for batch in batches:
        rows = [span_hashes(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([n for _, n in rows], pa.int64()),
                pa.array([hashes for hashes, _ in rows], pa.binary()),
            ],
            ["id", "text_hash", "n_sentences", "runs"],
        )


def _halves(runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The first and the second 8 bytes of all hashes, and how many there are to each text."""
    each = [np.frombuffer(r.as_buffer(), np.uint64) for r in runs]
    both = np.concatenate(each) if each else np.array([], np.uint64)
    return both.reshape(-1, 2), np.fromiter((len(e) // 2 for e in each), np.int64, len(each))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        halves, _ = _halves(batch.column(0))
        lo, n = np.unique(halves[:, 1], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(lo.view(np.int64)), pa.array(n.astype(np.int32))], ["lo", "n"])


class _Repeated:
    """The runs that may be repeated, a row each."""

    def __init__(self, known: Bitmap):
        self.known = known

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves, n = _halves(batch.column(2))
            there = np.flatnonzero(self.known.has(halves[:, 1]))
            owner = np.repeat(np.arange(len(n)), n)[there]
            start = there - (np.cumsum(n) - n)[owner]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(halves[there, i].copy().view(np.int64)) for i in (0, 1)),
                    batch.column(0).take(pa.array(owner)),
                    batch.column(1).take(pa.array(owner)),
                    pa.array(start.astype(np.int32)),
                ],
                ["hi", "lo", "id", "text_hash", "start"],
            )


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted spans, those at another place than the first of their run. Rows that are repeated are one place.

    Whether a task's first span is one depends on the task before. It comes
    with its run and the task's number; so does the last run, without a place.
    """
    from pyspark import TaskContext

    part, last, moved = TaskContext.get().partitionId(), None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        if last is None:
            yield _marked(batch.slice(0, 1), part)
            last = batch.slice(0, 1)
        # The row before goes first; ``moved`` says whether it is at another place than its run's first.
        rows = [np.append(before.to_numpy(), now.to_numpy()) for before, now in zip(last.columns, batch.columns, strict=True)]
        same = np.ones(len(rows[0]), bool)
        same[1:] = (rows[0][1:] == rows[0][:-1]) & (rows[1][1:] == rows[1][:-1])
        moves = np.zeros(len(same), bool)
        moves[1:] = same[1:] & np.logical_or.reduce([c[1:] != c[:-1] for c in rows[2:]])
        moves[0] = moved
        number = np.arange(len(same))
        again = np.maximum.accumulate(np.where(moves, number, -1)) >= np.maximum.accumulate(np.where(same, 0, number))
        yield _marked(batch.take(pa.array(np.flatnonzero(again[1:]))), None)
        last, moved = batch.slice(batch.num_rows - 1), bool(again[-1])
    if last is not None:
        nowhere = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int32())]
        columns = [*nowhere, last.column(0), last.column(1), pa.array([part], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "text_hash", "start", "hi", "lo", "part"])


def _marked(rows: pa.RecordBatch, part: int | None) -> pa.RecordBatch:
    n = rows.num_rows
    of = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())] if part is None else [rows.column(0), rows.column(1)]
    columns = [rows.column(2), rows.column(3), rows.column(4), *of, pa.array([part] * n, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, ["id", "text_hash", "start", "hi", "lo", "part"])


def _cleaned(texts: pa.Array, starts: pa.Array) -> pa.Array:
    """Null for a text that nothing is taken from; such texts don't become Python objects."""
    rows = [without_spans(t.as_py(), s.as_py()) if s.is_valid else (None, 0) for t, s in zip(texts, starts, strict=True)]
    columns = zip(*rows, strict=True) if rows else [()] * 2
    return pa.StructArray.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64()), strict=True)], ["text", "n_removed"]
    )


LAST = (1 << 63) - 1  # stands for a null id, which comes last


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, n_sentences, starts``: per document its number of sentences and those at which a repeated run
    other than its first starts (null: none).

    Rows equal in id and text are one document. Ids are taken as longs; a null
    id is the largest long.
    """
    spark = docs.sparkSession
    with_python(docs)
    text = text_or_empty(F.col(text_col))
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    with sql_conf(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS}):
        runs = written(texts.mapInArrow(_runs, RUNS), "runs")
        # Most runs are unique. Half a hash is enough to drop them; which of the others are equal is decided by all of it.
        counted = runs.select("runs").mapInArrow(_counted, "lo bigint, n int").groupBy("lo").agg(F.sum("n").alias("n"))
        repeated = written(counted.where("n > 1").select("lo"), "repeated-runs")
        spans = runs.select("id", "text_hash", "runs").mapInArrow(_Repeated(Bitmap(repeated, F.col("lo"))).rows, SPANS)
        # Dealt out by all columns, so that a run that very many documents share spreads over tasks.
        order = ["hi", "lo", "id", "text_hash", "start"]
        dealt = spans.repartitionByRange(*order).sortWithinPartitions(*order)
        marked = written(dealt.mapInArrow(_again, MARKED), "repeats")
    ends = marked.where("part IS NOT NULL AND start IS NULL").groupBy("hi", "lo").agg(F.min("part").alias("first_part"))
    begins = marked.where("part IS NOT NULL AND start IS NOT NULL").join(ends, ["hi", "lo"]).where("first_part < part")
    again = marked.where("part IS NULL").unionByName(begins.drop("first_part"))
    starts = again.groupBy("id", "text_hash").agg(F.collect_set("start").alias("starts"))
    one_each = runs.select("id", "text_hash", "n_sentences").distinct()
    return one_each.join(starts, ["id", "text_hash"], "left")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "n_removed", total: str | None = None
) -> DataFrame:
    """``docs`` with the text cleaned, and one more column, ``name``: sentences removed. With ``total``, a column of
    that name before it: sentences the text had.

    Null ids come last in the order that says which occurrence is first. Null
    texts become empty; a text loses nothing but whole sentences. No documents
    give no rows. If ``docs`` has a column ``name`` or ``total``, underscores
    are put before the new one.
    """
    spans = repeated_spans(docs, id_col, text_col).select(
        F.col("id").alias("s_id"), F.col("text_hash").alias("s_hash"), "n_sentences", "starts"
    )
    columns = [F.col(c).alias(f"d_{i}") for i, c in enumerate(docs.columns)]
    at = {c: f"d_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*columns).withColumn("d_text", text_or_empty(F.col(at[text_col])))
    rows = rows.withColumn("d_hash", F.xxhash64("d_text"))
    ident = F.coalesce(F.col(at[id_col]).cast("bigint"), F.lit(LAST))
    met = rows.join(spans, (ident == F.col("s_id")) & (F.col("d_hash") == F.col("s_hash")), "left")
    cleaned = met.withColumn("cleaned", F.arrow_udf(_cleaned, "text string, n_removed bigint")(F.col("d_text"), F.col("starts")))
    text = F.coalesce("cleaned.text", "d_text")
    kept = [text.alias(c) if c == text_col else F.col(at[c]).alias(c) for c in docs.columns]
    if total:
        kept.append(F.col("n_sentences").alias(free_name(docs, total)))
    return cleaned.select(*kept, F.col("cleaned.n_removed").alias(free_name(docs, name)))
