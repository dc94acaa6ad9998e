"""Quality rules: compression bands beside counts of words, symbols and repeats.

Whole texts and fixed chunks of them are compressed with zstandard. Text that repeats itself compresses too well, noise
too badly; how well ordinary text compresses depends on its length, so the limits are given for bands of length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seiche.llm.common import chunks, tidy, words

LEVEL = 3
CHUNK = 4096
#: Bytes from which a band begins, and the least ratio (raw to compressed bytes) of ordinary text of that length.
LOWEST = (
    (0, 0.0), (256, 1.05), (362, 1.15), (512, 1.25), (724, 1.35), (1024, 1.4), (1448, 1.45), (2048, 1.5), (2896, 1.55),
    (4096, 1.6), (5792, 1.65), (8192, 1.7), (16384, 1.75), (32768, 1.8),
)
#: The most: so much at 256 bytes, and so many times that for each time the length doubles. Set by eye on 1,918 licences,
#: manuals and notes in English (of 300 to 400,000 bytes): about the 99th percentile of each length.
HIGHEST, GROWTH = 2.4, 1.2
#: The share of the chunks that may be outside the band of their length, the shortest chunk.
CHUNKS_OUTSIDE, LEAST_CHUNK = 0.3, 256
SYMBOLS = re.compile(rb"[#*$%&|<>]")
CONTINUATION = bytes(range(0x80, 0xC0))


def repeated_words(w: list[bytes], size: int = 3) -> int:
    """Words in windows of `size` words that occur twice or more in the text, the first occurrence included."""
    n = len(w)
    if n <= size:
        return 0
    ids: dict[bytes, int] = {}
    v = np.fromiter((ids.setdefault(x, len(ids)) for x in w), np.int64, n)
    key = v[: n - size + 1]
    for k in range(1, size):  # exact: a window is a pair of the number of its beginning and of its next word
        if k > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(ids) + v[k : n - size + 1 + k]
    _, of, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = np.concatenate((count[of] >= 2, np.zeros(size - 1, bool)))
    covered = twice.copy()
    for k in range(1, size):
        covered[k:] |= twice[:-k]
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def chunk_size(size: int) -> int:
    """Bytes in a chunk: CHUNK, or for shorter texts the largest of its halves that fits three times; 0: too short."""
    c = CHUNK
    while c > size // 3:
        c //= 2
    return c if c >= LEAST_CHUNK else 0


def ratios(text: bytes, pack) -> tuple[float, int, int, float, float]:
    """The whole text's ratio; chunks, how many are outside the band of their length; the least and the most chunk ratio.
    What is left after the full chunks is judged by a chunk that ends where the text ends."""
    if not text:
        return 0.0, 0, 0, 0.0, 0.0
    whole, c = len(text) / len(pack(text)), chunk_size(len(text))
    if not c:
        return whole, 0, 0, 0.0, 0.0
    starts = [*range(0, len(text) - c + 1, c), *([len(text) - c] if len(text) % c else [])]
    each = [c / len(pack(text[a : a + c])) for a in starts]
    low, high = band(c)
    return whole, len(each), sum(not low <= r <= high for r in each), min(each), max(each)


def band(size: int) -> tuple[float, float]:
    """The least and the most ratio of ordinary text of so many bytes."""
    return next(low for least, low in reversed(LOWEST) if size >= least), HIGHEST * GROWTH ** max(0.0, math.log2(max(size, 1) / 256))


def within_bands(size: int, whole: float, full: int, outside: int) -> bool:
    low, high = band(size)
    return low <= whole <= high and outside <= CHUNKS_OUTSIDE * full


SCHEMA = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, zstd_ratio double, n_chunks bigint, n_chunks_outside bigint, chunk_ratio_min double, chunk_ratio_max double, base_failed boolean, kept boolean"


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id with the counts and ratios of its whole text, base_failed (under 50 words, or over half the words in
    repeated windows of three) and kept (not base_failed, and within the compression bands). Null and empty texts: no words,
    base fails. One pass, no shuffle; a row needs memory for its own text, however long. An empty table gives no rows. Other
    columns are ignored; repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        for part, texts in chunks(batches, "text"):
            rows = []
            for t in texts:
                w = words(t)
                letters = sum(map(len, w))
                # code points: bytes that don't continue a character
                letters = len(b"".join(w).translate(None, CONTINUATION)) if letters else 0
                again = repeated_words(w)
                whole, full, outside, least, most = ratios(t, pack)
                failed = len(w) < 50 or 100 * again > 50 * len(w)
                rows.append((len(w), letters, len(SYMBOLS.findall(t)), repeated_lines(t), again, whole, full, outside, least, most, failed, not failed and within_bands(len(t), whole, full, outside)))
            cols = list(zip(*rows))
            kinds = [pa.int64()] * 5 + [pa.float64()] + [pa.int64()] * 2 + [pa.float64()] * 2 + [pa.bool_()] * 2
            yield pa.record_batch([part.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", *(x.split()[0] for x in SCHEMA.split(", "))])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(tidy(run), f"doc_id bigint, {SCHEMA}")
