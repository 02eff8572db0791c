"""Text artifacts: fences, embedded JSON, required keys.

Everything but finding the JSON inside prose is a built-in expression.
Balanced brackets are beyond regular expressions, so that one step is a
vectorised function, and texts without any sign of JSON are not sent to it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbrook.fixed_values import (
    EMPTY_FILE_MESSAGE,
    FENCE,
    FENCE_LANGUAGE,
    FINDING_KEYS,
    FINDINGS_ARTIFACT,
    MAX_FENCE_LAYERS,
    MISSING_FILE_MESSAGE,
    NO_JSON_MESSAGE,
    REQUIRED_ARTIFACT_KEYS,
    WHITE_SPACE,
)
from clearbrook.functions.scalars import as_column

# The opening line of a fence, with the white space that may follow it.
_FENCE_OPENING = rf"\A{FENCE}{FENCE_LANGUAGE}[{WHITE_SPACE}]*\n"


def strip_space(text: Column | str) -> Column:
    """White space of every kind off both ends; the middle is not looked at."""
    return F.btrim(as_column(text), F.lit(WHITE_SPACE))


def strip_fences(text: Column | str, layers: int = MAX_FENCE_LAYERS) -> Column:
    """Text inside its outer code fences; NULL becomes the empty string."""
    result = strip_space(F.coalesce(as_column(text), F.lit("")))
    for _ in range(layers):
        result = _strip_one_fence(result)
    return result


def _strip_one_fence(text: Column) -> Column:
    # A one-element transform names the intermediate text once, so that three
    # layers stay three steps instead of doubling the expression each time.
    def unwrap(t: Column) -> Column:
        opening = F.regexp_extract(t, _FENCE_OPENING, 0)
        start = F.length(opening) + 1
        body = F.substring(t, start, F.length(t) - F.length(opening) - len(FENCE))
        fenced = t.startswith(FENCE) & t.endswith(FENCE)
        return F.when(fenced, F.when(opening != "", strip_space(body)).otherwise(t)).otherwise(t)

    return F.get(F.transform(F.array(text), unwrap), F.lit(0))


def _json_finder():
    """The vectorised search, self-contained so that workers need no package."""

    def written(value) -> str:
        text = json.dumps(value, ensure_ascii=False)
        # Half of a surrogate pair is no character; such texts keep the escapes they came with.
        return json.dumps(value) if any("\ud800" <= c <= "\udfff" for c in text) else text

    def first_json(text: str) -> str | None:
        try:
            return written(json.loads(text))
        except (ValueError, RecursionError):
            pass
        for opener in "{[":
            start = text.find(opener)
            if start >= 0:
                try:
                    value, _ = json.JSONDecoder().raw_decode(text, start)
                    return written(value)
                except (ValueError, RecursionError):
                    continue
        return None

    def find_json(texts: pd.Series) -> pd.Series:
        return texts.map(first_json, na_action="ignore")

    return F.pandas_udf(find_json, T.StringType())


_find_json = _json_finder()


def extract_json(text: Column | str) -> Column:
    """The first JSON document in a text, re-written as compact text; NULL if none.

    A text that is JSON as a whole is taken as it is, scalars included.
    Otherwise the first ``{`` is tried, then the first ``[``.
    """
    clean = strip_fences(text)
    promising = clean.contains("{") | clean.contains("[") | clean.rlike(r'^(["\-0-9]|true$|false$|null$|NaN$|Infinity$)')
    return _find_json(F.when(promising, clean))


#: A number of the kind that the parser of Python reads and that of Spark does not, outside strings.
_ODD_NUMBERS = r'("(?:[^"\\]|\\.)*+")|-?\b(?:NaN|Infinity)\b'


def _checkable(document: Column) -> Column:
    """The document as strict JSON: NaN and infinities are null, which no check tells from a number."""
    odd = document.rlike(r"\b(?:NaN|Infinity)\b")
    # A string is put back as it is; a number is not captured and becomes what follows the empty group.
    strict = F.regexp_replace(F.regexp_replace(document, F.lit(_ODD_NUMBERS), F.lit("$1\u0000")), '"\u0000', '"')
    return F.when(odd, F.replace(strict, F.lit("\u0000"), F.lit("null"))).otherwise(document)


def _root_type(document: Column) -> Column:
    """Name of the root's type, by its first character."""
    first = F.substring(document, 1, 1)
    return (
        F.when(first == "{", "dict")
        .when(first == "[", "list")
        .when(first == '"', "str")
        .when(document.isin("true", "false"), "bool")
        .when(document == "null", "NoneType")
        .when(document.rlike(r"^-?[0-9]+$"), "int")
        .otherwise("float")
    )


def _missing(present: Column, required) -> Column:
    return F.array_except(F.array(*[F.lit(k) for k in required]), F.coalesce(present, F.array().cast("array<string>")))


def artifact_violations(path: Column | str, document: Column | str) -> Column:
    """List of schema problems of a JSON document, by the path it stands for."""
    path, document = as_column(path), as_column(document)
    none = F.array().cast("array<string>")
    root = _root_type(document)
    strict = _checkable(document)
    keys = F.json_object_keys(strict)

    problems = none
    for name, required in REQUIRED_ARTIFACT_KEYS.items():
        wrong_root = F.array(F.concat(path, F.lit(": raiz deveria ser objeto JSON, veio "), root))
        absent = F.transform(
            _missing(keys, required),
            lambda k: F.concat(path, F.lit(": chave obrigatória ausente -> '"), k, F.lit("'")),
        )
        problems = F.when(path == name, F.when(root == "dict", absent).otherwise(wrong_root)).otherwise(problems)

    variant = F.try_parse_json(F.when(path.endswith(FINDINGS_ARTIFACT) & (root == "dict"), strict))
    findings = F.try_variant_get(variant, "$.findings", "array<variant>")
    empty = F.array(F.concat(path, F.lit(": 'findings' deve ser lista não-vazia")))

    def item_problems(item: Column, i: Column) -> Column:
        where = F.concat(path, F.lit(": findings["), i.cast("string"), F.lit("]"))
        text = F.to_json(item)
        absent = F.transform(
            _missing(F.json_object_keys(text), FINDING_KEYS),
            lambda k: F.concat(where, F.lit(" sem chave obrigatória '"), k, F.lit("'")),
        )
        return F.when(text.startswith("{"), absent).otherwise(F.array(F.concat(where, F.lit(" não é objeto"))))

    of_findings = F.when(
        path.endswith(FINDINGS_ARTIFACT) & (root == "dict"),
        F.when(F.coalesce(F.size(findings), F.lit(0)) < 1, empty).otherwise(
            F.flatten(F.transform(findings, item_problems))
        ),
    ).otherwise(none)
    return F.concat(problems, of_findings)


def sanitize(path: Column | str, content: Column | str, document: Column | str) -> Column:
    """Struct ``ok``, ``problems``, ``clean`` for one artifact.

    ``document`` is :func:`extract_json` of the content (NULL where none was
    found).  JSON or plain text is told by the path's extension; a NULL content
    is a file that was never written.
    """
    path, content, document = as_column(path), as_column(content), as_column(document)
    text = strip_fences(content)

    def only(message: str) -> Column:
        return F.array(F.concat(path, F.lit(f": {message}")))

    is_json = path.endswith(".json")
    none = F.array().cast("array<string>")
    problems = (
        F.when(content.isNull(), only(MISSING_FILE_MESSAGE))
        .when(is_json & document.isNull(), only(NO_JSON_MESSAGE))
        .when(is_json, artifact_violations(path, document))
        .when(text == "", only(EMPTY_FILE_MESSAGE))
        .otherwise(none)
    )
    clean = F.when(content.isNotNull(), F.when(is_json, document).otherwise(F.nullif(text, F.lit(""))))
    return F.struct((F.size(problems) == 0).alias("ok"), problems.alias("problems"), clean.alias("clean"))


class SchemaError(ValueError):
    """Artifacts that do not have the form they must have."""


def sanitize_strictly(artifacts: DataFrame, path: str = "path", content: str = "content", keep: Sequence[str] = ()) -> DataFrame:
    """Path and clean text of all artifacts, beside the columns to ``keep``; an error that names them if any has a problem.

    Problems are counted on Spark; the first few messages reach the driver.
    """
    judged = artifacts.select(*keep, F.col(path), sanitize(path, content, extract_json(content)).alias("judged"))
    bad = judged.where(~F.col("judged.ok"))
    first = [m for row in bad.orderBy(path).limit(5).collect() for m in row["judged"]["problems"]]
    if first:
        raise SchemaError("; ".join(first))
    return judged.select(*keep, path, F.col("judged.clean").alias("clean"))
