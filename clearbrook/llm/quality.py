"""Quality rules by compression bands.

Text that says the same again and again compresses far better than prose, and random characters compress far worse.
Every text is compressed whole and in chunks; the ratio of compressed to plain bytes must lie within a band that
depends on the number of bytes, as short texts give the compressor little to find. Chunks find what the whole hides:
a text that is prose for one half and noise for the other.

How well good text compresses depends on its languages. Where labels tell good texts, the bands of whole texts are fitted to
all of these but a fold, class by class of length; classes with few labels, and chunks, have wide bands for any prose.
"""

from __future__ import annotations

import bisect
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbrook.llm.common import ID, TEXT, discard, keep, texts
from clearbrook.operators.quantiles import exact_quantiles

#: Level of the compressor; ratios, and so the bands, hold for this one.
LEVEL = 3
#: Bytes from which a band holds, and its lowest and highest ratio. Shorter texts have no band.
BANDS = ((256, 0.22, 0.90), (1024, 0.20, 0.80), (4096, 0.17, 0.75), (16384, 0.14, 0.72))
#: Bytes of a chunk, and its band. Texts of fewer than four such chunks have short ones, with the band of short texts.
CHUNK, CHUNK_BAND, SHORT_CHUNK = 4096, (0.17, 0.78), 1024
#: A text is rejected when more than this share of its chunks lies outside their band.
CHUNK_SHARE = 1 / 3
#: Good texts of a length class that its band takes at least, and the least bytes of each class, half powers of two.
FIT_LEAST, EDGES = 20, [int(2 ** (k / 2)) for k in range(16, 41)]
#: Share of good texts that a fitted band leaves out on either side, and its margin beyond them.
FIT_SHARE, FIT_MARGIN = 0.002, 0.003
#: Every so many texts are held out of the fit, by the checksum of their id.
FOLDS = 5
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five that occur at least twice in the text, all occurrences counted."""
    if len(words) <= WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.uint64)
    if len(numbers) == len(words):
        return 0
    n = len(words) - WINDOW + 1
    codes = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        codes += (ids[k : k + n] + np.uint64(1)) * _FACTORS[k]
    order = np.argsort(codes, kind="stable")
    same = np.flatnonzero(codes[order][1:] == codes[order][:-1])
    if not len(same):
        return 0
    left, right = order[same], order[same + 1]
    twice = np.zeros(n, dtype=bool)
    if all(np.array_equal(ids[left + k], ids[right + k]) for k in range(WINDOW)):
        twice[left] = twice[right] = True
    else:  # two different windows share a code: compare the windows themselves
        seen: dict[bytes, int] = {}
        for i in range(n):
            first = seen.setdefault(ids[i : i + WINDOW].tobytes(), i)
            if first != i:
                twice[first] = twice[i] = True
    inside = np.zeros(len(words), dtype=bool)
    for k in range(WINDOW):
        inside[k : k + n] |= twice
    return int(inside.sum())


def band_of(size: int, bands: tuple = BANDS) -> tuple[float, float] | None:
    at = bisect.bisect_right([b[0] for b in bands], size) - 1
    return bands[at][1:] if at >= 0 else None


def chunks_of(raw: bytes) -> list[bytes]:
    """All bytes in chunks; none of texts that have less than two short ones.

    A last chunk of less than half the size joins the one before. Short chunks are of nearly equal size, and never three,
    as noise that fills half of a text then fills but one of them, which the share accepts.
    """
    if len(raw) >= 4 * CHUNK:
        edges = [*range(0, len(raw) - CHUNK // 2 + 1, CHUNK), len(raw)]
    else:
        count = len(raw) // SHORT_CHUNK
        count = 2 if count == 3 else count
        edges = [len(raw) * k // count for k in range(count + 1)] if count > 1 else []
    return [raw[a:b] for a, b in zip(edges, edges[1:])]


def compression(raw: bytes, compressor: zstandard.ZstdCompressor, bands: tuple = BANDS) -> tuple[float | None, int, int, int, str]:
    """Ratio of the whole, chunks, chunks below and above their band, and why the text is rejected ('' if it is not)."""
    if not raw:
        return None, 0, 0, 0, ""
    ratio = len(compressor.compress(raw)) / len(raw)
    chunks = low = high = 0
    for part in chunks_of(raw):
        share = len(compressor.compress(part)) / len(part)
        least, most = CHUNK_BAND if len(raw) >= 4 * CHUNK else band_of(len(part))
        chunks, low, high = chunks + 1, low + (share < least), high + (share > most)
    band = band_of(len(raw), bands)
    if band and ratio < band[0]:
        return ratio, chunks, low, high, "repetitive"
    if band and ratio > band[1]:
        return ratio, chunks, low, high, "incompressible"
    if low > CHUNK_SHARE * chunks:
        return ratio, chunks, low, high, "repetitive chunks"
    if high > CHUNK_SHARE * chunks:
        return ratio, chunks, low, high, "incompressible chunks"
    return ratio, chunks, low, high, ""


def base_fails(words: list[bytes]) -> bool:
    return len(words) < MIN_WORDS or 100 * repeated_words(words) > REPEAT_PERCENT * len(words)


def measure(text: str | None, compressor: zstandard.ZstdCompressor, bands: tuple = BANDS) -> tuple:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: exactly at \x20 and \x09-\x0D
    lines = [line for line in raw.split(b"\n") if line.strip()] if words else []
    repeats = repeated_words(words)
    spaces = len(raw) - len(raw.translate(None, b" \t\n\r\x0b\x0c"))
    failed = len(words) < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * len(words)
    ratio, chunks, low, high, reason = compression(raw, compressor, bands)
    return (
        len(words), len(text) - spaces, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
        repeats, failed, not failed and not reason, "base" if failed else reason, ratio, chunks, low, high,
    )


_COLUMNS = (
    ("n_words", pa.int64(), T.LongType()), ("word_chars", pa.int64(), T.LongType()), ("n_symbols", pa.int64(), T.LongType()),
    ("n_dup_lines", pa.int64(), T.LongType()), ("n_repeat_words", pa.int64(), T.LongType()),
    ("base_failed", pa.bool_(), T.BooleanType()), ("kept", pa.bool_(), T.BooleanType()), ("reason", pa.string(), T.StringType()),
    ("zstd_ratio", pa.float64(), T.DoubleType()), ("n_chunks", pa.int64(), T.LongType()),
    ("n_chunks_low", pa.int64(), T.LongType()), ("n_chunks_high", pa.int64(), T.LongType()),
)


def band_class(size: int) -> int:
    """The length class of a fitted band, -1 for texts that are too short for one."""
    return bisect.bisect_right(EDGES, size) - 1


def bands_of_good(fitted: Mapping[int, tuple[int, float, float]]) -> tuple:
    """Bands by length class from good texts' number and outer quantiles; wide ones for classes with few."""
    bands = []
    for at, low in enumerate(EDGES):
        band = band_of(low)
        count, least, most = fitted.get(at, (0, None, None))
        if count >= FIT_LEAST:
            band = max(band[0], least - FIT_MARGIN), max(band[1], most + FIT_MARGIN)
        bands.append((low, float(band[0]), float(band[1])))
    return tuple(bands)


def fit_bands(docs: DataFrame, labels: DataFrame, label: str = "quality") -> tuple:
    """Bands from all documents labelled good, but for a fold of ids.

    Each class of length is one row for the driver: its number of texts and the
    two quantiles, exact. An id with more than one label is good if all are. Without labels the bands are the wide ones.
    """
    good = labels.where(labels[label].isNotNull() & labels[ID].isNotNull()).groupBy(labels[ID].alias("id")).agg(F.min(labels[label]).alias("good"))
    chosen = good.where((F.col("good") == 1) & (F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS != 0)).select("id")
    source = texts(docs)

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            raws = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in batch.column(1)]
            classes = [-1 if base_fails(raw.split()) else band_class(len(raw)) for raw in raws]
            ratios = [len(compressor.compress(raw)) / len(raw) if at >= 0 else None for raw, at in zip(raws, classes)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(classes, pa.int32()), pa.array(ratios, pa.float64())], names=[ID, "class", "ratio"])

    # All texts are measured, as two numbers are sent to the labels and not the texts.
    schema = T.StructType([source.schema[ID], T.StructField("class", T.IntegerType()), T.StructField("ratio", T.DoubleType())])
    measured = source.mapInArrow(run, schema).where("class >= 0")
    measured = keep(measured.join(chosen, measured[ID] == chosen["id"], "left_semi").select("class", "ratio"), "ratios")
    found = exact_quantiles(measured, "ratio", {"least": FIT_SHARE, "most": 1 - FIT_SHARE}, ["class"], count_as="n")
    fitted = {r["class"]: (r["n"], r["least"], r["most"]) for r in found.collect()}
    discard(measured)
    return bands_of_good(fitted) if fitted else BANDS


def quality_report(docs: DataFrame, bands: tuple = BANDS) -> DataFrame:
    """One row per document with its counts, ratios and verdict.

    A null text counts as empty, an empty text has no words, fails the base rule and has no ratio. Rows are judged one
    by one, so equal rows get equal rows, and a null id stays null. Other columns are not read.
    """

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            rows = [measure(text, compressor, bands) for text in batch.column(1).to_pylist()]
            made = [pa.array(column, type=kind) for column, (_, kind, _) in zip(zip(*rows) if rows else [()] * len(_COLUMNS), _COLUMNS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=[ID, *[c[0] for c in _COLUMNS]])

    source = texts(docs)
    schema = T.StructType([source.schema[ID], *[T.StructField(name, kind) for name, _, kind in _COLUMNS]])
    return source.mapInArrow(run, schema)


def keep_quality(docs: DataFrame, bands: tuple = BANDS) -> DataFrame:
    """The documents that pass, with all their columns; one pass without a shuffle."""
    place = docs.columns.index(TEXT)

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            kept = [measure(text, compressor, bands)[6] for text in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(kept, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
