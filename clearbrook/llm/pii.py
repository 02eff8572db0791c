"""Personal data by bootstrapped contextual extraction.

Four kinds are found by their form alone; these are the seeds. What stands before a seed as its label ("Phone no:",
"client id") is a lexical pattern. Patterns and the values that follow them, in all texts, form a graph: a pattern is
as good as the share of its values that are known, a value as good as the patterns that lead to it. Spark scores both
sides in turns, and values of good patterns that have the look of an identifier are found too. Everything is built-in
functions, and no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbrook.llm.common import ID, SPANS, TEXT, discard, find, keep, no_spans, of_kind, span_text, texts

# The base kinds in their order. Possessive and anchored forms of the same expressions: each start is
# tried once, and no text can make the matcher recurse or look at a run of characters again and again.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: What a text needs before the expression of a kind is tried on it.
_MAY = {"email": F.contains, "phone": F.contains, "card": F.rlike}
_SIGN = {"email": "@", "phone": "+", "card": r"[0-9](?:[\x20-]?+[0-9]){13}"}

#: Words that announce a value, up to the value or a blank before it; with a colon after them they are part of a label.
_WORD = r"(?:(?i:number|no|nr|id)(?:[\x20\t]|(?=[+0-9]))|(?i:no|nr)\.(?:[\x20\t:]|(?=[+0-9])))"
#: A label of one or two words, a sign or word that announces a value, and the value, which does not announce another.
ANNOUNCE = rf"(?:[\x20\t]*+[:=]|[\x20\t]++{_WORD})"
LABELLED = (
    r"(?<![\p{L}_])(?:\p{L}++[\x20\t]++)?[\p{L}_]++" + ANNOUNCE + rf"[\x20\t]*+[\"'(]?+(?!(?:\p{{L}}++[\x20\t]++)?{_WORD})"
    + r"([A-Za-z0-9+](?:[^\s\"',;()]*[A-Za-z0-9])?)"
)

#: Known values that a pattern needs, and from which score on patterns and values count.
SUPPORT, PATTERN_SCORE, VALUE_SCORE = 3.0, 0.6, 0.5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)
    doubled = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: (lambda d: F.when(i % 2 == 1, d).when(d < 5, d * 2).otherwise(d * 2 - 9))(F.substring(turned, i, F.lit(1)).cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x) % 10 == 0


def _valid(kind: str) -> Column:
    """The kind's matches that pass what its expression cannot say."""
    if kind == "ip":
        return F.filter(kind, lambda x: F.rlike(x["value"], F.lit(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")))
    if kind == "card":
        long = F.filter(kind, lambda x: F.length(_digits(x["value"])).between(14, 19))
        return F.filter(long, lambda x: _luhn(_digits(x["value"])))
    if kind == "phone":
        return F.filter(kind, lambda x: F.length(_digits(x["value"])).between(10, 15))
    return F.col(kind)


def _span(start: Column, rank: Column, stop: Column, kind: Column) -> Column:
    return F.struct(start.alias("start"), rank.cast("int").alias("rank"), stop.alias("stop"), kind.alias("kind"))


def seeds_and_labels(docs: DataFrame) -> DataFrame:
    """Per row: a number for it, its id, the base spans, and its labelled values.

    A labelled value has its pattern (label and announcement, folded), its place, and the kind and text of the base
    span that it touches, if it does.
    """
    searches = {k: (PATTERNS[k], 0, _MAY[k](F.col(TEXT), F.lit(_SIGN[k])) if k in _MAY else None) for k in KINDS}
    announced = F.rlike(TEXT, F.lit(rf"[:=]|[\x20\t]{_WORD}"))
    found = find(texts(docs), TEXT, searches | {"labelled": (LABELLED, 1, announced), "whole": (LABELLED, 0, announced)})
    found = found.select(ID, *[_valid(k).alias(k) for k in KINDS], F.col("labelled"), F.transform("whole", lambda x: x["value"]).alias("whole"))

    def typed(kind: str) -> Column:
        return F.coalesce(
            F.transform(kind, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["stop"].alias("stop"), F.lit(kind).alias("kind"), x["value"].alias("value"))),
            F.array().cast(SPANS.replace("kind:string", "kind:string,value:string")),
        )

    found = found.select(ID, F.concat(*map(typed, KINDS)).alias("seeds"), "labelled", "whole")

    def pattern_of(whole: Column, value: Column) -> Column:
        """What stands before the value, without quotes, in lower case and with single spaces."""
        before = F.substring(whole, F.lit(1), F.length(whole) - F.length(value))
        return F.trim(F.lower(F.regexp_replace(F.regexp_replace(before, "[\"'(]", ""), r"[\x20\t]+", " ")))

    labels = F.zip_with("labelled", "whole", lambda x, whole: F.struct(
        pattern_of(whole, x["value"]).alias("pattern"), (x["stop"] - F.length(x["value"])).alias("start"), x["stop"].alias("stop"), x["value"].alias("value"),
    ))
    known = F.transform(labels, lambda v: F.struct(
        v["pattern"].alias("pattern"), v["start"].alias("start"), v["stop"].alias("stop"), v["value"].alias("value"),
        F.get(F.filter("seeds", lambda s: (s["start"] < v["stop"]) & (v["start"] < s["stop"])), F.lit(0)).alias("seed"),
    ))
    return found.select(
        F.monotonically_increasing_id().alias("row"), ID,
        F.transform("seeds", lambda s: _span(s["start"], s["rank"], s["stop"], s["kind"])).alias("base"),
        F.when(F.size("labelled") > 0, known).alias("labels"),
    )


def score_patterns(labels: DataFrame) -> DataFrame:
    """(pattern, kind, score) of the patterns that are good enough.

    ``labels`` has pattern, value, seed_kind (null where the value is unknown) and seed_value. Edges are counted once
    per pattern and value, so a text that a third of the rows share weighs as much as any other. Scores of either side only
    grow from turn to turn; turns go on until patterns and their scores, to six digits, stay as they are.
    """
    edges = keep(
        labels.groupBy("pattern", F.lower(F.coalesce("seed_value", "value")).alias("instance"))
        .agg(F.max("seed_kind").alias("kind"), F.max(F.rlike("value", F.lit("[0-9@]"))).alias("alike")),
        "edges",
    )
    values = keep(
        edges.groupBy("instance").agg(F.when(F.max("kind").isNotNull(), 1.0).otherwise(0.0).alias("score")), "values"
    )
    scored = mark = None
    while True:
        support = edges.join(values, "instance").groupBy("pattern").agg(
            F.sum("score").alias("known"), F.count("*").alias("all"),
            *[F.count_if(F.col("kind") == k).alias(k) for k in KINDS],
        )
        kind = F.element_at(F.array_sort(F.array(*[F.struct((-F.col(k)).alias("n"), F.lit(k).alias("kind")) for k in KINDS])), 1)["kind"]
        better = keep(
            support.where((F.col("known") >= SUPPORT) & (F.col("known") / F.col("all") >= PATTERN_SCORE))
            .select("pattern", kind.alias("kind"), (F.col("known") / F.col("all")).alias("score")),
            "patterns",
        )
        if scored is not None:
            discard(scored)
        scored = better
        now = tuple(scored.agg(F.count("*"), F.sum(F.xxhash64("pattern", "kind", F.round("score", 6)).cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
        # Noisy or: a value is unknown only if every pattern that leads to it is wrong.
        miss = F.log1p(-F.least(F.col("score"), F.lit(0.99)))
        reached = edges.where("alike").join(scored.select("pattern", "score"), "pattern").groupBy("instance").agg((1 - F.exp(F.sum(miss))).alias("reached"))
        nearer = values.join(reached, "instance", "left").select(
            "instance", F.when(F.col("score") == 1.0, 1.0).when(F.col("reached") >= VALUE_SCORE, F.col("reached")).otherwise(0.0).alias("score")
        )
        nearer = keep(nearer, "values")
        discard(values)
        values = nearer
    discard(values)
    discard(edges)
    return scored


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base kinds, and all spans.

    Spans that only the patterns find are of the kind like_ and the kind most of the pattern's seeds have. A null or
    empty text has no spans, so the digest is that of the empty string. Rows are told apart by a number of their own,
    so equal rows and null ids keep one row each; equal texts count once as evidence.
    """
    rows = keep(seeds_and_labels(docs), "rows")
    labels = rows.select("row", F.explode("labels").alias("label")).select("row", "label.*")
    unseen = labels.where(F.col("seed").isNull() & F.rlike("value", F.lit("[0-9@]")))
    patterns = score_patterns(labels.select("pattern", "value", F.col("seed.kind").alias("seed_kind"), F.col("seed.value").alias("seed_value")))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")) + len(KINDS) - 1
    more = (
        unseen.join(patterns.select("pattern", "kind"), "pattern")
        .groupBy("row").agg(F.collect_list(_span(F.col("start"), rank, F.col("stop"), F.concat(F.lit("like_"), "kind"))).alias("more"))
    )
    every = F.concat(F.col("base").cast(SPANS), F.coalesce(F.col("more").cast(SPANS), no_spans()))
    return rows.join(more, "row", "left").select(
        ID,
        *[of_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(every).alias("spans"),
    )
