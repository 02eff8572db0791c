"""Packing by minimum bin slack.

Documents become ids, ids are cut into whole windows and one shorter rest each, and rests are packed: a sequence takes
the longest rest that is left, and a subset-sum search over the counts of the other lengths finds those that fill it
closest to its capacity. Sums are bits of one number, so a step of the search is a shift; going back through the
steps tells how many rests of each length were taken.

Pieces are dealt by hash into bins of a fixed mean size that pack by themselves, so that no task holds more than a few
thousand of them whatever the corpus. What this costs is one sequence with more than a little padding for each bin.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbrook.llm.common import ID, TEXT, keep, texts
from clearbrook.llm.tokens import encoder

TOKENIZER, WINDOW, END = "byte_bpe_50k.json", 2048, 1
#: Mean number of pieces that pack together.
BIN = 2048
#: Sequences of a bin have numbers below this, those of different bins differ above it.
NUMBERS = 1 << 24

_PIECE = (("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("doc_tokens", T.LongType()))


def pieces_of(docs: DataFrame, tokenizer: str = TOKENIZER, window: int = WINDOW, end: int = END) -> DataFrame:
    """Whole windows and the rest of each document's ids: id, start, length, checksum of the ids, ids in all."""
    source = texts(docs)
    last = end.to_bytes(4, "little")

    def run(batches):
        ids = encoder(tokenizer)
        for batch in batches:
            at, rows = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                raw = ids.ids(text or "") + last
                total = len(raw) // 4
                for start in range(0, total, window):
                    part = raw[4 * start : 4 * (start + window)]
                    at.append(row)
                    rows.append((start, len(part) // 4, zlib.crc32(part), total))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 4)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names=[ID, *[c for c, _ in _PIECE]])

    return source.mapInArrow(run, T.StructType([source.schema[ID], *[T.StructField(c, kind) for c, kind in _PIECE]]))


def fill(counts: Counter, room: int) -> dict[int, int]:
    """How many pieces of each length fill ``room`` best: the multiset with the largest sum not above it.

    Longer lengths are offered first. The search ends as soon as the room can be filled to the last place.
    """
    goal, mask = 1 << room, (2 << room) - 1
    sums, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, copies = min(counts[length], room // length) if length <= room else 0, 1
        while left > 0 and not sums & goal:  # 1, 2, 4, ... copies at a time reach every number of them
            taken = min(copies, left)
            steps.append((length, taken, sums))
            sums |= (sums << (length * taken)) & mask
            left, copies = left - taken, 2 * copies
        if sums & goal:
            break
    total, chosen = sums.bit_length() - 1, Counter()
    for length, taken, before in reversed(steps):
        if not (before >> total) & 1:
            chosen[length] += taken
            total -= length * taken
    return chosen


def slack_bins(lengths: list[int], window: int) -> list[list[int]]:
    """Sequences as lists of lengths. A pattern that fits is used again while there are pieces for it."""
    counts, bins = Counter(lengths), []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        rest = fill(+counts, window - longest) if longest < window else Counter()
        counts[longest] += 1
        pattern = rest + Counter([longest])
        times = min(counts[length] // n for length, n in pattern.items())
        bins += [sorted(pattern.elements(), reverse=True)] * times
        for length, n in pattern.items():
            counts[length] -= n * times
        counts = +counts
    return bins


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per piece with its sequence and its place there.

    Every document ends with ``end``; a null or empty text is that id alone. Equal rows are documents of their own, a
    null id stays null, no row gives no row. Sequence numbers are unique but not consecutive. A sequence needs padding
    up to ``window`` unless its length is a power of two, which loaders take as it is.
    """
    pieces = keep(pieces_of(docs, tokenizer, window, end), "pieces")
    bins = max(1, -(-pieces.count() // BIN))
    # The row's number spreads equal rows too; it is taken from the written table, whose files do not change.
    dealt = pieces.withColumn("bin", F.pmod(F.xxhash64(F.monotonically_increasing_id(), *pieces.columns), F.lit(bins)))
    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def arrange(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        waiting: dict[int, list[int]] = {}
        for row in np.argsort(lengths, kind="stable"):
            waiting.setdefault(int(lengths[row]), []).append(int(row))
        first = table.column("bin")[0].as_py() * NUMBERS
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for number, lengths_in in enumerate(slack_bins(lengths.tolist(), window)):
            at = 0
            for length in lengths_in:
                row = waiting[length].pop()
                sequence[row], offset[row] = first + number, at
                at += length
        return table.drop_columns(["bin"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return dealt.groupBy("bin").applyInArrow(arrange, schema)
