"""License scans by ordered signature rules.

A text is reduced to its words, joined by single spaces, and rules are regular expressions over that. A rule is only
tried where its keyword occurs, which spares nearly all texts nearly all rules. Rules are ordered: where two detections
overlap so that one lies within the other, the one of the better rule stays, or the longer one of equally good rules.
"""

from __future__ import annotations

import bisect
import functools
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clearbrook.llm.common import ID, texts

# The base phrases and their labels.
BASE = ((b"cc by", "cc-by"), (b"general public license", "gpl"), (b"all rights reserved", "reserved"))

_SEPARATORS = bytes(32 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))
_WORDS = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: From raw bytes: A-Z to lower case, everything that is in no word to a space.
TO_WORDS = bytes(_SEPARATORS[_WORDS[b]] if not 65 <= b <= 90 else b + 32 for b in range(256))

#: Licenses by label: what a text calls them, the words of their identifier, and addresses that stand for them.
#: {v} in an entry is filled with each of the versions.
_NAMED = (
    ("apache-{v}", ("1 0", "1 1", "2 0"), r"apache(?: software)? licen[sc]e(?: version| v)? ?{v}", "apache {v}", r"apache org licenses license {v}"),
    ("gpl-{v}", ("1", "2", "3"), r"(?:gnu )?(?:general public licen[sc]e|gpl)(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?{v}(?: 0)?", "gpl {v} 0", r"gnu org licenses (?:old licenses )?gpl {v} 0"),
    ("lgpl-{v}", ("2", "2 1", "3"), r"(?:gnu )?(?:lesser|library) (?:general public licen[sc]e|gpl)(?: version| v)? ?{v}(?: 0)?", "lgpl {v}", r"gnu org licenses (?:old licenses )?lgpl {v}"),
    ("agpl-{v}", ("1", "3"), r"(?:gnu )?affero (?:general public licen[sc]e|gpl)(?: version| v)? ?{v}(?: 0)?", "agpl {v} 0", r"gnu org licenses agpl {v} 0"),
    ("mpl-{v}", ("1 0", "1 1", "2 0"), r"mozilla public licen[sc]e(?: version| v)? ?{v}", "mpl {v}", r"mozilla org mpl {v}"),
    ("epl-{v}", ("1 0", "2 0"), r"eclipse public licen[sc]e(?: version| v)? ?{v}", "epl {v}", r"eclipse org legal epl v?{v}"),
    ("cc-by-{v}", ("1 0", "2 0", "2 5", "3 0", "4 0"), r"(?:creative commons attribution|cc by)(?: licen[sc]e)?(?: version)? {v}", "cc by {v}", r"creativecommons org licenses by {v}"),
    ("cc-by-sa-{v}", ("1 0", "2 0", "2 5", "3 0", "4 0"), r"(?:creative commons attribution share ?alike|cc by sa)(?: licen[sc]e)?(?: version)? {v}", "cc by sa {v}", r"creativecommons org licenses by sa {v}"),
    ("cc-by-nc-{v}", ("1 0", "2 0", "2 5", "3 0", "4 0"), r"(?:creative commons attribution non ?commercial|cc by nc)(?: licen[sc]e)?(?: version)? {v}", "cc by nc {v}", r"creativecommons org licenses by nc {v}"),
    ("cc-by-nd-{v}", ("1 0", "2 0", "2 5", "3 0", "4 0"), r"(?:creative commons attribution no ?deriv\w*|cc by nd)(?: licen[sc]e)?(?: version)? {v}", "cc by nd {v}", r"creativecommons org licenses by nd {v}"),
    ("cc-by-nc-sa-{v}", ("1 0", "2 0", "2 5", "3 0", "4 0"), r"(?:creative commons attribution non ?commercial share ?alike|cc by nc sa)(?: licen[sc]e)?(?: version)? {v}", "cc by nc sa {v}", r"creativecommons org licenses by nc sa {v}"),
    ("cc-by-nc-nd-{v}", ("1 0", "2 0", "2 5", "3 0", "4 0"), r"(?:creative commons attribution non ?commercial no ?deriv\w*|cc by nc nd)(?: licen[sc]e)?(?: version)? {v}", "cc by nc nd {v}", r"creativecommons org licenses by nc nd {v}"),
    ("cc0-1.0", ("1 0",), r"cc0(?: {v})?(?: universal)?", "cc0 {v}", r"creativecommons org publicdomain zero {v}"),
    ("bsd-{v}-clause", ("2", "3", "4"), r"(?:bsd )?{v} clause(?: bsd)? licen[sc]e", "bsd {v} clause", r"opensource org licenses bsd {v} clause"),
    ("artistic-{v}", ("1 0", "2 0"), r"artistic licen[sc]e(?: version| v)? ?{v}", "artistic {v}", r"opensource org licenses artistic (?:license )?{v}"),
    ("eupl-{v}", ("1 1", "1 2"), r"european union public licen[sc]e(?: version| v)? ?{v}", "eupl {v}", r"eupl v?{v}"),
    ("cddl-{v}", ("1 0", "1 1"), r"common development and distribution licen[sc]e(?: version| v)? ?{v}", "cddl {v}", r"opensource org licenses cddl {v}"),
    ("osl-{v}", ("2 1", "3 0"), r"open software licen[sc]e(?: version| v)? ?{v}", "osl {v}", r"opensource org licenses osl {v}"),
    ("gfdl-{v}", ("1 1", "1 2", "1 3"), r"(?:gnu )?free documentation licen[sc]e(?: version| v)? ?{v}", "gfdl {v}", r"gnu org licenses fdl {v}"),
    ("bsl-{v}", ("1 0",), r"boost software licen[sc]e(?: version| v)? ?{v}", "bsl {v}", r"boost org license {v}"),
)
#: Licenses without versions: label, name, identifier.
_PLAIN = (
    ("mit", r"mit licen[sc]e", "mit"), ("isc", r"isc licen[sc]e", "isc"), ("zlib", r"zlib licen[sc]e", "zlib"),
    ("unlicense", r"unlicense", "unlicense"), ("wtfpl", r"(?:wtfpl|do what the \w+ you want to public licen[sc]e)", "wtfpl"),
    ("bsd", r"bsd(?: style)? licen[sc]e", "bsd"), ("apache", r"apache licen[sc]e", "apache"), ("mpl", r"mozilla public licen[sc]e", "mpl"),
    ("gpl", r"gnu general public licen[sc]e", "gpl"), ("lgpl", r"(?:lesser|library) general public licen[sc]e", "lgpl"),
    ("agpl", r"affero general public licen[sc]e", "agpl"), ("epl", r"eclipse public licen[sc]e", "epl"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)", "cc by sa"), ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)", "cc by nc"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv\w*)", "cc by nd"), ("creative-commons", r"creative commons(?: attribution)?(?: licen[sc]e)?", "cc"),
    ("postgresql", r"postgresql licen[sc]e", "postgresql"), ("python", r"python software foundation licen[sc]e", "psf 2 0"),
    ("vim", r"vim licen[sc]e", "vim"), ("ruby", r"ruby licen[sc]e", "ruby"), ("php", r"php licen[sc]e", "php 3 01"), ("openssl", r"openssl licen[sc]e", "openssl"),
    ("ofl", r"(?:sil )?open font licen[sc]e", "ofl 1 1"), ("odbl", r"open (?:data commons open )?database licen[sc]e", "odbl 1 0"),
    ("openrail", r"(?:open)?rail m?(?: licen[sc]e)", "openrail"), ("sspl", r"server side public licen[sc]e", "sspl 1 0"),
    ("busl", r"business source licen[sc]e", "busl 1 1"), ("elastic", r"elastic licen[sc]e", "elastic 2 0"),
)
#: Wordings that stand for a license or a claim without naming one: label, expression, keyword.
_WORDINGS = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "hereby granted"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "warranty"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e", "redistribute"),
    ("lgpl", r"this library is free software you can redistribute it and or modify", "redistribute"),
    ("no-warranty", r"without warranties or conditions of any kind", "warranties"), ("no-warranty", r"without any warranty", "warranty"),
    ("no-warranty", r"provided as is without warrant(?:y|ies)", "warrant"),
    ("public-domain", r"(?:released|dedicated|placed) (?:in|in)?to the public domain", "public domain"), ("public-domain", r"(?:is|are) in the public domain", "public domain"),
    ("copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)*", "copyright"), ("proprietary", r"proprietary and confidential", "proprietary"),
    ("proprietary", r"may not be reproduced (?:or distributed )?without (?:prior )?(?:written )?permission", "reproduced"),
    ("no-training", r"may not be used (?:to train|for training)(?: of)? (?:machine learning|artificial intelligence|ai|language)? ?models?", "may not be used"),
)
#: How a license is claimed around its name, and how good the evidence is (in hundredths).
_CLAIMS = (
    (r"(?:this (?:work|file|program|project|software|code|text) is )?(?:licen[sc]ed|released|distributed|published|available|provided) under (?:the )?(?:terms of )?(?:the )?{name}", 100),
    (r"{name}", 80),
)


#: What a text must contain before the rules of a label are tried on it: one of these.
_KEYWORDS = {
    "apache": ("apache",), "gpl": ("general public", "gpl"), "lgpl": ("lesser", "library"), "agpl": ("affero",), "mpl": ("mozilla",),
    "epl": ("eclipse",), "cc-by": ("cc by", "creative commons"), "cc0-1.0": ("cc0",), "bsd": ("bsd", "clause"), "artistic": ("artistic",),
    "eupl": ("european union",), "cddl": ("common development",), "osl": ("open software",), "gfdl": ("free documentation",),
    "bsl": ("boost",), "mit": ("mit licen",), "isc": ("isc licen",), "zlib": ("zlib licen",), "wtfpl": ("wtfpl", "do what the"),
    "creative-commons": ("creative commons",), "python": ("python software",), "ofl": ("open font",), "odbl": ("database licen",),
    "openrail": ("rail",), "sspl": ("server side",), "busl": ("business source",),
}


def _keywords(label: str) -> tuple[str, ...]:
    """Those of the label or of its longest known beginning; else its first word."""
    known = [k for k in _KEYWORDS if label.startswith(k)]
    return _KEYWORDS[max(known, key=len)] if known else (label.split("-")[0],)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    #: All of these groups must have a word sequence that occurs.
    keywords: tuple[tuple[bytes, ...], ...]
    relevance: int


@functools.cache
def rules() -> tuple[Rule, ...]:
    """All rules, the best first: identifiers, claims and addresses of a version, names, families, loose wordings."""
    found = []

    def add(label, expression, relevance, *groups):
        keywords = tuple(tuple(k.encode() for k in group) for group in groups)
        found.append(Rule(label, re.compile(rf" {expression}(?= )".encode()), keywords, relevance))

    for label, versions, name, identifier, address in _NAMED:
        for version in versions:
            filled, words = label.format(v=version.replace(" ", ".")), identifier.format(v=version)
            for claim, relevance in _CLAIMS:
                add(filled, claim.format(name=name.replace("{v}", version)), relevance - 2, _keywords(filled), *[(" under ",)] * (" under " in claim))
            add(filled, rf"spdx licen[sc]e identifier {words}(?: only| or later)?", 100, ("spdx",))
            add(filled, address.replace("{v}", version), 95, (address.split(" {v}")[0].split(" v?")[0].split(" (?:")[0],))
    for label, name, identifier in _PLAIN:
        for claim, relevance in _CLAIMS:
            add(label, claim.format(name=name), relevance - 10, _keywords(label), *[(" under ",)] * (" under " in claim))
        add(label, rf"spdx licen[sc]e identifier {identifier}", 99, ("spdx",))
    for label, expression, keyword in _WORDINGS:
        add(label, expression, 60, (keyword,))
    return tuple(sorted(found, key=lambda r: -r.relevance))


#: Any detection needs one of these; most texts have none and are done after this.
_GATE = (b"licen", b" cc", b"copyright", b"spdx", b"warrant", b"public domain", b"redistribut", b"proprietary", b"hereby granted", b"unencumbered", b"reproduced", b"may not be used", b"wtfpl", b" gpl", b" lgpl", b" agpl", b" eupl", b"creative commons", b" rail", b"openrail", b"creativecommons", b"boost org", b"mozilla org", b"affero gpl", b"lesser gpl", b"library gpl", b"eclipse org")


def detections(joined: bytes) -> list[tuple[int, int, Rule]]:
    """What the rules find in words joined by spaces, with a space at both ends: space before, space after, rule.

    Rules come in order. Of two detections one of which lies within the other only the better rule's stays, or the
    longer one where the rules are equally good. What stays is not nested, so it is sorted by both ends at once.
    """
    if not any(g in joined for g in _GATE):
        return []
    starts: list[int] = []
    kept: list[tuple[int, int, Rule]] = []
    for rule in rules():
        if not all(any(k in joined for k in group) for group in rule.keywords):
            continue
        for match in rule.pattern.finditer(joined):
            start, end = match.span()
            at = bisect.bisect_left(starts, start)
            if at and kept[at - 1][1] >= end or at < len(kept) and kept[at][0] == start and kept[at][1] >= end:
                continue  # within another one
            until = at
            while until < len(kept) and kept[until][1] <= end:
                until += 1
            if any(k[2].relevance > rule.relevance for k in kept[at:until]):
                continue
            starts[at:until], kept[at:until] = [start], [(start, end, rule)]
    return kept


def scan(text: str | None) -> tuple:
    words = (text or "").encode("utf-8", "surrogatepass").translate(TO_WORDS).split()
    joined = b" " + b" ".join(words) + b" "
    places, base = [], set()
    for phrase, label in BASE:
        before, last, at = 0, 0, joined.find(b" " + phrase + b" ")
        while at >= 0:
            before, last = before + joined.count(b" ", last, at), at
            places.append(before)
            base.add(label)
            at = joined.find(b" " + phrase + b" ", at + 1)
    found = detections(joined)
    spans, before, last = [], 0, 0
    for start, end, rule in found:
        before, last = before + joined.count(b" ", last, start), start
        spans.append(f"{rule.label}:{before}:{before + joined.count(b' ', start, end)}")
    score = max([0.5 if base else 0.0, *[r.relevance / 100 for _, _, r in found]])
    labels = sorted(base | {r.label for _, _, r in found})
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(labels), score, ",".join(spans),
    )


_COLUMNS = (
    ("n_words", pa.int64(), T.LongType()), ("n_base", pa.int64(), T.LongType()), ("first_word", pa.int64(), T.LongType()),
    ("last_word", pa.int64(), T.LongType()), ("base_labels", pa.string(), T.StringType()), ("labels", pa.string(), T.StringType()),
    ("score", pa.float64(), T.DoubleType()), ("detections", pa.string(), T.StringType()),
)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: words, places of the base phrases, all labels, the best evidence, and the detections.

    A detection is written label:first word:word after the last. A text that is null, empty or without words has no
    place (null), no labels (empty) and score 0. Rows are scanned one by one: equal rows get equal rows, a null id
    stays null, other columns are not read.
    """
    source = texts(docs)

    def run(batches):
        for batch in batches:
            rows = [scan(text) for text in batch.column(1).to_pylist()]
            made = [pa.array(c, kind) for c, (_, kind, _) in zip(zip(*rows) if rows else [()] * len(_COLUMNS), _COLUMNS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=[ID, *[c[0] for c in _COLUMNS]])

    return source.mapInArrow(run, T.StructType([source.schema[ID], *[T.StructField(c, kind) for c, _, kind in _COLUMNS]]))
