"""Hard negatives by exact scores of anchors against all vectors.

The vectors are packed into blocks once. Anchors are packed too, into blocks of a fixed number of rows, and a fixed
number of anchor blocks at a time is sent to all executors; every vector block meets each of them once, where the
products are taken modulo several primes and put together again. A task keeps, for each anchor, the best few it has
seen so far, so what it holds and hands on depends on the number of anchors at a time and not on the vectors it reads.
A window over the tasks' results picks the best of all.

There are two such passes: the first finds each anchor's positives; the second the rows of other labels whose scores
lie within the range that a positive's score sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearbrook.llm.common import keep
from clearbrook.llm.residues import scores

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
#: Per cent of the positive's score that a hard negative's score lies between.
LOW, HIGH = 30, 90
#: Vectors of a block and anchors of a block.
ROWS, ANCHORS = 4096, 2048
#: Bytes of anchors that are sent to the executors at a time.
SENT = 32 << 20
#: Anchors that are multiplied with a block of vectors at a time.
_STRIP = 256
_NONE = np.iinfo(np.int64).min


def prepared(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """Id, label and whole-number components, ``floor(scale * x)``, of the rows that take part.

    Those are the rows with a label and a vector whose components are all finite numbers, scaled ones too.
    """
    cells = F.transform(vectors["embedding"].cast("array<double>"), lambda x: x * scale)
    bad = F.exists(cells, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.where(vectors["label"].isNotNull() & vectors["embedding"].isNotNull() & ~F.coalesce(bad, F.lit(False)))
    # From 2**52 up doubles are whole numbers, and further up no 64-bit ones.
    whole = F.transform(cells, lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x))
    return usable.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].cast("long").alias("label"), whole.alias("cells"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as a matrix; what a shorter list lacks counts as zero."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    matrix = np.zeros((len(lengths), width))
    matrix[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return matrix


def blocks(rows: DataFrame, size: int = ROWS) -> DataFrame:
    """The rows packed as (ids, labels, width, matrix), up to ``size`` of one partition in each."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                width = int(np.diff(part.column(2).offsets.to_numpy()).max(initial=0))
                matrix = _matrix(part.column(2), width)
                if (np.abs(matrix) < 1 << 24).all():
                    matrix = matrix.astype(np.float32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "ids": [part.column(0).to_pylist()], "labels": [part.column(1).to_pylist()],
                        "width": [width], "matrix": [matrix.tobytes()],
                    },
                    schema=pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("width", pa.int32()), ("matrix", pa.binary())]),
                )

    return rows.select("vec_id", "label", "cells").mapInArrow(run, "ids array<bigint>, labels array<bigint>, width int, matrix binary")


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids (0 for null), which of them are null, labels and components of a packed block."""
    ids, labels = row["ids"], np.array(row["labels"], np.int64)
    size = len(row["matrix"]) // max(1, len(labels) * row["width"])
    matrix = np.frombuffer(row["matrix"], np.float32 if size == 4 else np.float64).reshape(len(labels), row["width"]).astype(np.float64)
    return np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], bool), labels, matrix


def _even(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices as wide as the wider one."""
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


class Best:
    """For each of a number of lists the first few entries by score, then by id; ids that are null come last."""

    def __init__(self, lists: int, size: int) -> None:
        self.score = np.full((lists, size), _NONE)
        self.id = np.zeros((lists, size), np.int64)
        self.null = np.zeros((lists, size), bool)

    def add(self, at: slice, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Offer entries to the lists ``at``; those of the lowest score there is are none."""
        score, ids, null = (np.concatenate([mine[at], more], axis=1) for mine, more in ((self.score, score), (self.id, ids), (self.null, null)))
        order = np.lexsort((ids, null, -np.maximum(score, _NONE + 1)), axis=1)[:, : self.score.shape[1]]
        for mine, values in ((self.score, score), (self.id, ids), (self.null, null)):
            mine[at] = np.take_along_axis(values, order, axis=1)


def _ranked(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores from the highest down in each row, and their columns; equal scores in the order of the columns."""
    columns = found.shape[1]
    room = (1 << 62) // max(1, columns)
    real = found != _NONE
    if real.any() and np.abs(found[real]).max() >= room:
        order = np.argsort(-np.maximum(found, _NONE + 1), axis=1, kind="stable")
        return np.take_along_axis(found, order, axis=1), order
    keys = np.where(real, found, -room) * columns + (columns - 1 - np.arange(columns))
    keys = np.sort(keys, axis=1)[:, ::-1]
    value = keys // columns
    return np.where(value == -room, _NONE, value), columns - 1 - (keys - value * columns)


def _first(ranked: np.ndarray, order: np.ndarray, begin: np.ndarray, size: int, ids: np.ndarray, null: np.ndarray):
    """``size`` entries from the place ``begin`` of each row, with ids; those beyond the row's end are none."""
    at = begin[:, None] + np.arange(size)
    inside = at < ranked.shape[1]
    at = np.where(inside, at, 0)
    score = np.where(inside, np.take_along_axis(ranked, at, axis=1), _NONE) if ranked.shape[1] else np.full(at.shape, _NONE)
    column = np.take_along_axis(order, at, axis=1) if ranked.shape[1] else np.zeros(at.shape, np.int64)
    return score, ids[column], null[column]


def _limits(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score of a hard negative; by parts, so that a large score times per cent does not overflow."""
    whole, rest = positive // 100, positive % 100
    return whole * low - (-rest * low // 100), whole * high + rest * high // 100


def _positives_of_block(task: Best, at: int, anchors, vectors, found: np.ndarray) -> None:
    ids, null, labels, _ = vectors
    other = ~((anchors[0][:, None] == ids) & (anchors[1][:, None] == null))
    ranked, order = _ranked(np.where((anchors[2][:, None] == labels) & other, found, _NONE))
    entries = _first(ranked, order, np.zeros(len(found), np.int64), task.score.shape[1], ids, null)
    task.add(slice(at, at + len(found)), *entries)


def _negatives_of_block(task: Best, at: int, anchors, vectors, found: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
    ids, null, labels, _ = vectors
    ranked, order = _ranked(np.where(anchors[2][:, None] == labels, _NONE, found))
    per = low.shape[1]
    for k in range(per):
        begin = (ranked > high[:, k, None]).sum(axis=1)
        score, entry_ids, entry_null = _first(ranked, order, begin, task.score.shape[1], ids, null)
        score = np.where(score >= low[:, k, None], score, _NONE)
        task.add(slice(at * per + k, (at + len(found)) * per + k, per), score, entry_ids, entry_null)


def _pass(vectors: DataFrame, anchors: DataFrame, group: list[int], size: int, per: int, share: tuple[int, int] | None) -> DataFrame:
    """What each task keeps: for each anchor and list the best entries among the vectors that the task has read.

    ``anchors`` are packed blocks with ``first``, the number of their first anchor; ``group`` names those to take. With
    ``share``, the per cents of a positive's score, they also have ``limits``: the scores of each anchor's positives,
    one after the other, ``per`` for each anchor; without it the positives themselves are sought.
    """

    def run(batches):
        kept: dict[int, tuple[Best, tuple]] = {}
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                block = _read(row)
                order = np.lexsort((block[0], block[1]))  # equal scores then stand by id, null last
                block = tuple(part[order] for part in block)
                number = row["first"]
                mine = _read({k: row[f"anchor_{k}"] for k in ("ids", "labels", "width", "matrix")})
                if number not in kept:
                    kept[number] = (Best(len(mine[0]) * per, size), mine)
                task = kept[number][0]
                left, right = _even(mine[3], block[3])
                for at in range(0, len(left), _STRIP):
                    strip = tuple(part[at : at + _STRIP] for part in mine)
                    found = scores(left[at : at + _STRIP], right)
                    if share is None:
                        _positives_of_block(task, at, strip, block, found)
                    else:
                        limits = row["limits"][at * per : (at + len(found)) * per]
                        known = np.array([x is not None for x in limits], bool).reshape(-1, per)
                        least, most = _limits(np.array([x or 0 for x in limits], np.int64).reshape(-1, per), *share)
                        _negatives_of_block(task, at, strip, block, found, np.where(known, least, 1), np.where(known, most, _NONE + 1))
        for number, (task, mine) in kept.items():
            place, _ = np.nonzero(task.score != _NONE)
            some = task.score != _NONE
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number + place // per), pa.array((place % per).astype(np.int32)),
                    pa.array(task.score[some]), pa.array(task.id[some], mask=task.null[some]),
                ],
                names=["slot", "list", "score", "vec_id"],
            )

    # Every block of vectors meets each block of anchors once; the join's table is the anchors sent at a time.
    named = anchors.where(F.col("first").isin(group)).select(
        "first", *[F.col(c).alias(f"anchor_{c}") for c in ("ids", "labels", "width", "matrix")], "limits"
    )
    met = vectors.select("*", F.explode(F.array(*map(F.lit, group)).cast("array<bigint>")).alias("first")).join(F.broadcast(named), "first")
    return met.mapInArrow(run, "slot bigint, list int, score bigint, vec_id bigint")


def _best(kept: DataFrame, size: int) -> DataFrame:
    """The first entries of each list over all tasks, with their rank."""
    order = Window.partitionBy("slot", "list").orderBy(F.desc("score"), F.col("vec_id").isNull(), "vec_id")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _numbered(anchors: DataFrame) -> DataFrame:
    """Anchors with consecutive numbers from 0, over partitions of their ids' order.

    Partition sizes, one number for each, are all that the driver sees.
    """
    placed = keep(
        anchors.repartitionByRange("vec_id").sortWithinPartitions("vec_id", "label", "cells")
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "anchors",
    )
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("begin"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("part", (before - F.col("begin")).alias("offset"))
    return placed.join(offsets, "part").select("vec_id", "label", "cells", (F.col("at") + F.col("offset")).alias("slot"))


def _packed(anchors: DataFrame, more: list[Column]) -> DataFrame:
    """Anchors with ``slot`` in blocks of ``ANCHORS``; one group is one block, so its size is bounded."""
    width = F.max(F.size("cells")).alias("width")
    rows = F.array_sort(F.collect_list(F.struct("slot", "vec_id", "label", "cells", *more))).alias("rows")
    return anchors.groupBy(F.floor(F.col("slot") / ANCHORS).alias("block")).agg(width, rows)


def _anchor_blocks(anchors: DataFrame) -> DataFrame:
    """The blocks with matrices of doubles, as the packed vectors have them."""
    extra = [F.col("limits")] if "limits" in anchors.columns else []

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                width, rows = row["width"], row["rows"]
                matrix = np.zeros((len(rows), width))
                for k, r in enumerate(rows):
                    matrix[k, : len(r["cells"])] = r["cells"]
                yield pa.RecordBatch.from_pydict(
                    {
                        "first": [rows[0]["slot"]], "ids": [[r["vec_id"] for r in rows]], "labels": [[r["label"] for r in rows]],
                        "width": [width], "matrix": [matrix.tobytes()], "limits": [[x for r in rows for x in r.get("limits", [])]],
                    },
                    schema=pa.schema([
                        ("first", pa.int64()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("width", pa.int32()),
                        ("matrix", pa.binary()), ("limits", pa.list_(pa.int64())),
                    ]),
                )

    return _packed(anchors, extra).mapInArrow(run, "first bigint, ids array<bigint>, labels array<bigint>, width int, matrix binary, limits array<bigint>")


def _passes(vectors: DataFrame, anchor_blocks: DataFrame, size: int, per: int, share: tuple[int, int] | None = None) -> DataFrame:
    """One pass over the vectors for each group of anchor blocks that together stay within ``SENT`` bytes."""
    weights = anchor_blocks.select("first", (F.length("matrix") + 8 * (F.size("ids") + F.size("limits"))).alias("bytes"))
    groups: list[list[int]] = []
    room = 0
    for first, weight in sorted((r["first"], r["bytes"]) for r in weights.toLocalIterator()):
        if not groups or weight > room:
            groups.append([])
            room = SENT
        groups[-1].append(first)
        room -= weight
    parts = [keep(_pass(vectors, anchor_blocks, group, size, per, share), "scored") for group in groups]
    if not parts:
        return vectors.sparkSession.createDataFrame([], "slot bigint, list int, score bigint, vec_id bigint")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """For each anchor and positive the first hard negatives: anchor_id, positive_id, rank, negative_id and both scores.

    Both tables have vec_id, label and cells (whole numbers as doubles) as :func:`prepared` gives them. A positive is a
    row of the anchor's label and another id; a hard negative a row of another label whose score is at least ``low``
    and at most ``high`` per cent of the positive's. Higher scores come first, ties by smaller id, rows without an id
    last. A positive without hard negatives, or with a negative score, gives no row. Repeated rows take part as often
    as they are there, but equal anchors are one. Shorter vectors count as filled with zeros. Scores that 64 bits do
    not hold count as the largest or smallest number that they do. Other columns are not read; empty tables give none.
    """
    packed = keep(blocks(vectors), "vector-blocks")
    numbered = keep(_numbered(anchors.select("vec_id", "label", "cells").distinct()), "numbered-anchors")
    first = keep(_anchor_blocks(numbered), "anchor-blocks")
    partial = _passes(packed, first, positives, 1)
    found = keep(_best(partial, positives).select("slot", "rank", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id")), "positives")
    limits = found.groupBy("slot").agg(F.map_from_entries(F.collect_list(F.struct("rank", "positive_score"))).alias("scored"))
    filled = F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda k: F.try_element_at("scored", k)).alias("limits")
    second = keep(_anchor_blocks(numbered.join(limits, "slot", "left").select("slot", "vec_id", "label", "cells", filled)), "anchor-limits")
    partial = _passes(packed, second, negatives, positives, (low, high))
    best = _best(partial, negatives).select(
        "slot", (F.col("list") + 1).alias("positive_rank"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    rows = best.join(found.withColumnRenamed("rank", "positive_rank"), ["slot", "positive_rank"]).join(
        numbered.select("slot", F.col("vec_id").alias("anchor_id")), "slot"
    )
    return rows.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
