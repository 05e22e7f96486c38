"""Quality rules: word and line statistics, and compression bands.

zstandard ratios (compressed over plain bytes) of the whole text and of each
fixed chunk must lie within limits that depend on the length: text below them
repeats itself, text above them is hardly compressible (encoded or random
data).

The upper limits lie between two measured distributions (level 3): the largest
ratios of sf0.1 texts with MIN_WORDS words, and the smallest of random base64
in MIN_WORDS words or more of 8 to 76 characters (of 4 characters in brackets):

    bytes          clean    base64
    257 to 512     0.745    0.826 (0.789)
    513 to 1024    0.698    0.777 (0.740)
    1025 to 2048   0.592    0.753 (0.717)
    2049 to 4096   0.520    0.742 (0.706)
    chunk          0.488    0.742 (0.706)

Random hexadecimal digits carry half a byte a character (0.51 to 0.56 from
1 KB on), too near clean text for the bands to tell them apart.
"""

from __future__ import annotations

from collections import Counter
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from regline.llm.common import text_or_empty

LEVEL = 3
CHUNK_BYTES = 4096
#: Up to this many bytes: smallest and largest ratio of a whole text. Very short texts are
#: mostly frame and literals, so their ratio may exceed 1. Over CHUNK_BYTES the chunks have
#: the stricter upper limit.
WHOLE_LIMITS = (
    (256, 0.38, 2.5),
    (512, 0.36, 0.78),
    (1024, 0.34, 0.73),
    (2048, 0.31, 0.70),
    (4096, 0.31, 0.68),
    (16384, 0.29, 0.74),
    (float("inf"), 0.27, 0.72),
)
#: The same for a chunk.
CHUNK_LIMITS = (0.31, 0.68)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = frozenset(b"#*$%&|<>")

FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "whole_ratio double, least_chunk_ratio double, largest_chunk_ratio double, base_failed boolean, kept boolean"
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a run of WINDOW words found more than once, the first included."""
    runs = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    counts = Counter(runs)
    if len(counts) == len(runs):
        return 0
    again = np.fromiter((counts[run] > 1 for run in runs), bool, len(runs))
    covered = np.zeros(len(words), bool)
    for i in range(WINDOW):
        covered[i : i + len(runs)] |= again
    return int(covered.sum())


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = data.split(b"\n")
    worded = list(compress(lines, map(bytes.split, lines)))
    return len(worded) - len(set(worded))


def ratios(data: bytes, compressor) -> tuple[float, float, float]:
    """Of the whole, and the least and largest of the chunks (of the whole if there is none). An empty text has 1.

    The last chunk is the text's last CHUNK_BYTES bytes and may overlap the one before, so every byte lies in a whole chunk.
    """
    if not data:
        return 1.0, 1.0, 1.0
    whole = len(compressor.compress(data)) / len(data)
    if len(data) <= CHUNK_BYTES:
        return whole, whole, whole
    starts = [*range(0, len(data) - CHUNK_BYTES, CHUNK_BYTES), len(data) - CHUNK_BYTES]
    chunks = [data[at : at + CHUNK_BYTES] for at in starts]
    each = [len(compressor.compress(chunk)) / len(chunk) for chunk in chunks]
    return whole, min(each), max(each)


def within_bands(size: int, whole: float, least: float, largest: float) -> bool:
    low, high = next((low, high) for upto, low, high in WHOLE_LIMITS if size <= upto)
    if not low <= whole <= high:
        return False
    return size <= CHUNK_BYTES or CHUNK_LIMITS[0] <= least and largest <= CHUNK_LIMITS[1]


def judge_text(text: str, compressor) -> tuple:
    """The values of FIELDS."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at ASCII white space only
    # Continuation bytes of UTF-8 are no code points of their own.
    in_words = np.frombuffer(b"".join(words), np.uint8)
    word_chars = int(len(in_words) - np.count_nonzero((in_words & 0xC0) == 0x80))
    symbols = sum(map(data.count, (bytes([s]) for s in SYMBOLS)))
    repeat = repeated_words(words)
    whole, least, largest = ratios(data, compressor)
    failed = len(words) < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * len(words)
    kept = not failed and within_bands(len(data), whole, least, largest)
    return len(words), word_chars, symbols, repeated_lines(data), repeat, whole, least, largest, failed, kept


def judge(text: Column) -> Column:
    """A struct of FIELDS for a text column. A null text counts as empty, which fails the base rules."""

    def judged(texts: pa.Array) -> pa.Array:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=LEVEL)
        rows = [judge_text(t.as_py(), compressor) for t in texts]
        columns = zip(*rows, strict=True) if rows else [()] * 10
        kinds = [pa.int64()] * 5 + [pa.float64()] * 3 + [pa.bool_()] * 2
        names = [field.split()[0] for field in FIELDS.split(", ")]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return F.arrow_udf(judged, FIELDS)(text_or_empty(text))
