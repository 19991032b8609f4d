"""Quality rules: counts of words, symbols and repetitions, and compression bands.

The method's verdict: a text is compressed whole, and in fixed chunks, by zstandard. Repetitive
text compresses too well and random text too badly; how well prose compresses depends on its
length and on how many bytes its letters take, so each length has a band of allowed ratios of its
own, for each of three widths of letters. The ratio is bytes over compressed bytes. Short texts
carry the codec's own overhead, which their bands allow for.

``fit`` takes the bands from documents known to be good; without any, fixed ones hold. A text is
rejected if the ratio of the whole lies outside its band, or if more than ``max_bad_share`` of its
bytes lie in chunks outside the band of their length. What compresses as prose of its length does
is not rejected: hexadecimal digits, for one, only from about 4,000 bytes on.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.textbatch import Texts, Words, mix, slices

#: Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"


#: Lengths, in bytes, up to which a class goes; the last has no end.
LENGTHS = (64, 96, 128, 192, 256, 384, 512, 768, 1024, 1536, 2048, 3072, 4096, 8192, 16384, 1 << 62)
#: Bytes a letter takes on average, up to which a text is narrow or middling; others are wide.
WIDTHS = (1.5, 2.25)
Limits = tuple[tuple[int, float, float], ...]

# Fixed values: (bytes up to, least ratio, most ratio) of narrow, middling and wide letters. The
# narrow ones hold prose in Latin letters with a margin of 6 to 8 % below and 20 % and more above; the
# others lie just above random letters of that width.
PROSE: tuple[Limits, ...] = (
    ((64, 0.70, 1.30), (128, 0.78, 1.70), (256, 0.95, 2.30), (384, 1.20, 2.30), (512, 1.27, 2.40), (768, 1.33, 2.45),
     (1024, 1.45, 2.50), (1536, 1.53, 2.60), (2048, 1.64, 2.70), (3072, 1.70, 2.80), (4096, 1.78, 2.90), (8192, 1.80, 3.00),
     (16384, 1.95, 3.10), (1 << 62, 2.05, 3.30)),
    ((128, 0.70, 2.50), (512, 1.00, 3.00), (1024, 1.30, 4.00), (4096, 1.55, 4.50), (16384, 1.70, 5.00), (1 << 62, 1.80, 6.00)),
    ((128, 0.60, 2.00), (512, 0.90, 2.50), (1024, 1.05, 3.00), (2048, 1.20, 3.20), (4096, 1.35, 3.50), (16384, 1.48, 4.00),
     (1 << 62, 1.50, 4.50)),
)


@dataclass(frozen=True)
class Bands:
    """Limits of each width of letters, by rising length; the last of each holds for all longer texts."""

    limits: tuple[Limits, ...] = PROSE
    chunk: int = 4096
    max_bad_share: float = 0.3
    level: int = 3

    def of(self, size: int, width: int = 0) -> tuple[float, float]:
        return next((low, high) for upto, low, high in self.limits[width] if size <= upto)


def _width(data: bytes) -> int:
    """0 to 2, by the mean bytes of a character."""
    raw = np.frombuffer(data, np.uint8)
    return bisect.bisect_left(WIDTHS, len(raw) / max(1, np.count_nonzero((raw & 0xC0) != 0x80)))


def _verdict(data: bytes, bands: Bands, codec: zstandard.ZstdCompressor) -> tuple[float | None, float, bool]:
    """Whole ratio, share of bytes in bad chunks, and whether both are within their limits."""
    if not data:
        return None, 0.0, True
    whole, width = len(data) / len(codec.compress(data)), _width(data)
    low, high = bands.of(len(data), width)
    bad = 0
    if len(data) > bands.chunk:
        for start in range(0, len(data), bands.chunk):
            part = data[start:start + bands.chunk]
            least, most = bands.of(len(part), width)
            if not least <= len(part) / len(codec.compress(part)) <= most:
                bad += len(part)
    share = bad / len(data)
    return whole, share, low <= whole <= high and share <= bands.max_bad_share


def fit(docs: DataFrame, good: DataFrame, bands: Bands = Bands(), margin: float = 0.05, least_texts: int = 50) -> Bands:
    """Bands that hold the texts of ``docs`` whose doc_id is in ``good``, with a margin, by length and width of letters.

    A class with fewer than ``least_texts`` texts joins the next longer one; what is left over at the
    end, and widths without any, keep the limits of ``bands``. Chunks count as texts of their
    length. At most ``len(LENGTHS)`` rows a width reach the driver. Null and empty texts count nothing.
    All texts are compressed, so that ids and ratios are joined and no text is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdCompressor(level=bands.level)
        for batch in slices(batches, "text"):
            found, texts = [], Texts.of(batch.column("text"))
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                data = texts.bytes_of(i)
                pieces = [data] if data else []
                if len(data) > bands.chunk:
                    pieces += [data[i:i + bands.chunk] for i in range(0, len(data), bands.chunk)]
                # The last piece of a text may be a few bytes of it and tells nothing.
                found += [(doc_id, _width(data), bisect.bisect_left(LENGTHS, len(p)), len(p) / len(codec.compress(p)))
                          for p in pieces if p is data or len(p) == bands.chunk]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.float64()))],
                                             ["doc_id", "width", "length", "ratio"])

    measured = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, width int, length int, ratio double")
    rows = measured.join(good.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("width", "length").agg(F.count("*").alias("n"), F.min("ratio").alias("low"), F.max("ratio").alias("high")).collect()
    limits = []
    for width, before in enumerate(bands.limits):
        fitted, n, low, high = [], 0, float("inf"), 0.0
        for row in sorted((r for r in rows if r.width == width), key=lambda r: r.length):
            n, low, high = n + row.n, min(low, row.low), max(high, row.high)
            if n >= least_texts:
                fitted.append((LENGTHS[row.length], low * (1 - margin), high * (1 + margin)))
                n, low, high = 0, float("inf"), 0.0
        longest = fitted[-1][0] if fitted else 0
        limits.append((*fitted, *[band for band in before if band[0] > longest]))
    return replace(bands, limits=tuple(limits))


def _distinct_lines(texts: Texts, starts: np.ndarray) -> np.ndarray:
    """Per text, its lines with a word that equal an earlier one."""
    breaks = np.flatnonzero(texts.data == 10)
    begins = np.unique(np.concatenate([texts.bounds[:-1], breaks + 1]))
    begins = begins[begins < len(texts.data)]
    stops = np.concatenate([begins[1:], [len(texts.data)]]) if len(begins) else begins
    worded = np.searchsorted(starts, stops) > np.searchsorted(starts, begins)
    begins, stops = begins[worded], stops[worded]
    ended = (stops > begins) & (texts.data[stops - 1] == 10) if len(stops) else np.zeros(0, bool)
    owner = texts.text_of(begins)
    keys = mix(texts.hashes(begins, stops - ended) + mix(owner.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(keys, return_index=True)
    n = len(texts)
    return np.bincount(owner, minlength=n) - np.bincount(owner[first], minlength=n)


def _repeated_words(words: Words, width: int) -> np.ndarray:
    """Per text, words that lie in a window of ``width`` words found twice or more in it."""
    at, grams = words.grams(width)
    owner = np.searchsorted(words.bounds, at, "right") - 1
    keys = mix(grams + mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    repeated = np.zeros(len(keys), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    edges = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(edges, at[repeated], 1)
    np.add.at(edges, at[repeated] + width, -1)
    covered = np.cumsum(edges[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(covered)])
    return total[words.bounds[1:]] - total[words.bounds[:-1]]


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, ratio double, bad_chunk_share double")


def measure(docs: DataFrame, bands: Bands = Bands(), min_words: int = 10, max_repeat_percent: int = 20,
            width: int = 5) -> DataFrame:
    """One row of counts and verdicts for each row of ``docs``; nothing is shuffled.

    A null or empty text has no words, so it fails; its ratio is null. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdCompressor(level=bands.level)
        symbols = np.zeros(256, bool)
        symbols[list(SYMBOLS)] = True
        for batch in slices(batches, "text"):
            texts = Texts.of(batch.column("text"))
            words = Words.of(texts)
            n_words = words.counts
            inside = np.zeros(len(texts.data) + 1, np.int64)
            np.add.at(inside, words.starts, 1)
            np.add.at(inside, words.ends, -1)
            points = (np.cumsum(inside[:-1]) > 0) & ((texts.data & 0xC0) != 0x80)
            repeats = _repeated_words(words, width)
            failed = (n_words < min_words) | (100 * repeats > max_repeat_percent * n_words)
            verdicts = [_verdict(texts.bytes_of(i), bands, codec) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(texts.per_text(points), pa.int64()),
                pa.array(texts.per_text(symbols[texts.data]), pa.int64()),
                pa.array(_distinct_lines(texts, words.starts), pa.int64()), pa.array(repeats, pa.int64()),
                pa.array(failed), pa.array([bool(ok and not f) for (_, _, ok), f in zip(verdicts, failed)]),
                pa.array([v[0] for v in verdicts], pa.float64()), pa.array([v[1] for v in verdicts], pa.float64()),
            ], [c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
