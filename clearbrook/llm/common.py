"""Helpers that several operators of this folder share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbrook.session import scratch_path

ID, TEXT = "doc_id", "text"


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """The id, the text (empty where it is null) and the named columns; nothing else of the input is read."""
    return docs.select(docs[ID], F.coalesce(docs[TEXT], F.lit("")).alias(TEXT), *[docs[c] for c in more])


def keep(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written to the folder all executors share, and read back.

    Cuts lineage so that the loss of an executor does not repeat earlier steps, and lets them be computed once.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Remove the table behind a frame that :func:`keep` returned, once nothing reads it any more."""
    session = frame.sparkSession
    folders = {name.rsplit("/", 1)[0] for name in frame.inputFiles()}
    hadoop = session.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = session.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)


_SHIPPED: set[str] = set()


#: Texts that go to a Python worker at a time; what workers hold follows from it and the longest texts.
BATCH = 500


def ship(spark: SparkSession) -> None:
    """Give the executors this package once a session, for clusters that do not have it installed.

    Also keeps the batches that go to Python small, as texts may be long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"  # Spark serves it from the driver
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _sums(values: Column) -> Column:
    """The sums before each element, and the total as the last."""
    return F.aggregate(
        values, F.array(F.lit(0).cast("long")), lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
    )


def running_sums(lengths: Column) -> Column:
    """For each element of a non-empty array the sum of those before it.

    Two levels: sums of blocks first, then within each block, so that the work grows with the size to the power of
    1.5 at most instead of 2.
    """
    block = 128
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / block).cast("int")),
        lambda b: F.slice(lengths, b * block + 1, F.lit(block)),
    )
    offsets = _sums(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda s, x: s + x)))
    pairs = F.zip_with(blocks, offsets, lambda b, o: F.struct(b.alias("block"), o.alias("offset")))
    whole = F.slice(pairs, 1, F.size(pairs) - 1)  # the last offset is the total
    return F.flatten(
        F.transform(
            whole, lambda p: F.transform(F.slice(_sums(p["block"]), 1, F.size(p["block"])), lambda x: x + p["offset"])
        )
    )


def find(frame: DataFrame, text: str, searches: dict[str, tuple[str, int, Column | None]]) -> DataFrame:
    """Add for each search an array of structs (start, stop, value): its leftmost non-overlapping matches in ``text``.

    A search is a Java expression, the group whose text is the value, and a condition for looking at all (None: always).
    Places are code points, the end exclusive. Where nothing matches, the array is null. ``split`` leaves what lies
    between the matches, so the lengths of both add up to the places.
    """
    steps = {}
    for name, (pattern, group, condition) in searches.items():
        hit = F.rlike(text, F.lit(pattern))
        hit = hit if condition is None else condition & hit
        steps[f"{name}__found"] = F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        if group:
            steps[f"{name}__value"] = F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))
        steps[f"{name}__between"] = F.when(hit, F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long")))
    frame = frame.select("*", *[c.alias(n) for n, c in steps.items()])
    sums = {
        f"{name}__before": F.when(
            F.col(f"{name}__found").isNotNull(),
            running_sums(F.zip_with(f"{name}__found", F.slice(f"{name}__between", F.lit(1), F.size(f"{name}__found")), lambda f, b: F.length(f) + b)),
        )
        for name in searches
    }
    frame = frame.select("*", *[c.alias(n) for n, c in sums.items()])
    places = {}
    for name, (_, group, _) in searches.items():
        value = F.col(f"{name}__value" if group else f"{name}__found")
        zipped = F.arrays_zip(F.col(f"{name}__before").alias("a"), F.slice(f"{name}__between", F.lit(1), F.size(f"{name}__found")).alias("b"), F.col(f"{name}__found").alias("f"), value.alias("v"))
        places[name] = F.when(
            F.col(f"{name}__found").isNotNull(),
            F.transform(zipped, lambda z: F.struct((z["a"] + z["b"]).alias("start"), (z["a"] + z["b"] + F.length(z["f"])).alias("stop"), z["v"].alias("value"))),
        )
    used = {f"{n}__{k}" for n in searches for k in ("found", "value", "between", "before")}
    return frame.select(*[c for c in frame.columns if c not in used], *[c.alias(n) for n, c in places.items()])


def spans_of(found: Column, rank: int, kind: str) -> Column:
    """Matches as sortable spans: by start, then by the kind's rank."""
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["stop"].alias("stop"), F.lit(kind).alias("kind")))


SPANS = "array<struct<start:bigint,rank:int,stop:bigint,kind:string>>"


def no_spans() -> Column:
    return F.array().cast(SPANS)


def span_text(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
