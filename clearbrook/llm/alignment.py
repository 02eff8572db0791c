"""Alignment of two tokenizers' tokens over the same text.

Both id lists are laid over the text's bytes. Cumulative ends of the tokens are kept in a dictionary from end to index
for either side; ends that both have, found by intersecting the two key sets and sorted, cut both lists into groups.
Within a group every two tokens whose byte ranges overlap are linked. Texts are taken word by word: a single space between
plain characters begins a new token on either side whatever stands around it, so words are aligned independently of each
other, and a worker remembers the words it has aligned.

How often two ids are linked is counted over the corpus. Texts are worked on in bundles, each of which counts its own
pairs first: a pair then goes into the shuffle once for a bundle instead of once for a text, and even a pair that every
text has is a small part of the rows. A bundle is one record, with its texts' links as places in the bundle's pairs, so
the corpus-wide counts come back to it by one join.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import struct
import sys
from array import array
from itertools import accumulate, count

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, pre_tokenizers

from clearbrook.llm.common import ID, keep, texts
from clearbrook.llm.tokens import _AGREED, encoder, place

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A bundle is closed once its texts have this many bytes together, or are this many.
BYTES, TEXTS = 1 << 20, 500
#: Ids of either tokenizer are below this.
_IDS = 1 << 31
#: The bytes of tokens that stand for no text; no text in UTF-8 has them.
_NO_TEXT = b"\xff"
#: Bytes of the words remembered by a worker, and the characters of the longest one; beyond that it forgets them all and
#: begins anew. Half a million words of twelve characters come to about so much.
_REMEMBERED, _LONGEST = 108 << 20, 64
#: Bytes that a word has in a dictionary besides its own and those of what it comes to.
_ENTRY = 56
#: A space between characters that both tokenizers, and all versions of the Unicode tables, take for no white space.
_PLAIN = "[!-~\u00c0-\u024f]"
_BETWEEN = re.compile(f"(?<={_PLAIN}) (?={_PLAIN})")
_ENDS = re.compile(rf"{_PLAIN}(?:.*{_PLAIN})?\Z", re.DOTALL)


def _byte_of() -> dict[str, int]:
    """The byte that each letter of the byte-level alphabet stands for: printable ones for themselves, others in turn."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteLevel:
    """Ids of a byte-level vocabulary; special tokens inside a text are plain text."""

    def __init__(self, name: str) -> None:
        self.library = Tokenizer.from_file(place(name))
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        self.quick = encoder(name).ranked
        letters = _byte_of()
        with open(place(name), encoding="utf-8") as file:
            special = {t["id"] for t in json.load(file)["added_tokens"]}
        self.bytes = [_NO_TEXT] * self.library.get_vocab_size()
        for token, number in self.library.get_vocab().items():
            if number not in special:
                self.bytes[number] = bytes(map(letters.__getitem__, token))

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text after a space."""
        return [
            self.quick(f" {t}") if self.quick and _AGREED.fullmatch(t) else self.library.encode(f" {t}", add_special_tokens=False).ids
            for t in texts
        ]


class Pieces:
    """Ids of a piece vocabulary, which puts a space before the text itself."""

    def __init__(self, name: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=place(name))
        self.bytes: list[bytes] = []
        for number in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(number)
            byte = self.library.is_byte(number)
            self.bytes.append(bytes([int(piece[3:-1], 16)]) if byte else piece.replace("▁", " ").encode("utf-8"))
        #: Whether any piece goes on over a space after other characters.
        self.across = any(b" " in b.lstrip(b" ") for b in self.bytes)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text after a space."""
        return self.library.encode(texts, num_threads=1)


@functools.lru_cache(maxsize=4)
def _side(name: str) -> ByteLevel | Pieces:
    return ByteLevel(name) if name.endswith(".json") else Pieces(name)


@functools.lru_cache(maxsize=4)
def _sizes(name: str) -> list[int]:
    """How many bytes each id has."""
    return [len(b) for b in _side(name).bytes]


def tokens_of(texts: list[str], first: str = FIRST, second: str = SECOND) -> list[tuple[list[int], list[int]] | None]:
    """The ids of both sides for each text after a space; none where the bytes of either are not those of text and space."""
    a, b = _side(first), _side(second)
    bytes_a, bytes_b = a.bytes.__getitem__, b.bytes.__getitem__
    found = []
    for text, left, right in zip(texts, a.encode(texts), b.encode(texts)):
        whole = f" {text}".encode("utf-8", "replace")  # a half of a character pair becomes another byte on either side
        same = b"".join(map(bytes_a, left)) == whole == b"".join(map(bytes_b, right))
        found.append((left, right) if same else None)
    return found


def aligned(left: list[int], right: list[int], first: str = FIRST, second: str = SECOND, words: list[int] | None = None) -> list[tuple]:
    """For each word (tokens of the first side, tokens of the second, groups, groups as text, links).

    ``words`` are the places after the words' last bytes; without it all is one word. A word that does not end where
    tokens of both sides do is one with those after it. A link is both ids as one number.
    """
    sizes_a, sizes_b = _sizes(first), _sizes(second)
    ends_a, ends_b = list(accumulate(map(sizes_a.__getitem__, left))), list(accumulate(map(sizes_b.__getitem__, right)))
    at_a, at_b = dict(zip(ends_a, count(1))), dict(zip(ends_b, count(1)))
    closing = set(words or ends_a[-1:])
    found, groups, links, i, j, begin_a, begin_b = [], [], [], 0, 0, 0, 0
    for end in sorted(at_a.keys() & at_b.keys()):
        k, m = at_a[end], at_b[end]
        if k - i == 1 == m - j:
            groups.append(f"{left[i]}|{right[j]}")
            links.append(left[i] * _IDS + right[j])
        else:
            groups.append(f"{','.join(map(str, left[i:k]))}|{','.join(map(str, right[j:m]))}")
            x, y = i, j
            while x < k and y < m:  # no token is empty, so two of a group overlap until one of them has ended
                links.append(left[x] * _IDS + right[y])
                end_a, end_b = ends_a[x], ends_b[y]
                x += end_a <= end_b
                y += end_b <= end_a
        i, j = k, m
        if end in closing:
            found.append((k - begin_a, m - begin_b, len(groups), ";".join(groups), links))
            groups, links, begin_a, begin_b = [], [], k, m
    return found


#: Tokens of both sides, groups and links, before a word's links and its groups as text.
_HEAD = struct.Struct("<4I")


def _packed(n_a: int, n_b: int, n_groups: int, groups: str, links: list[int]) -> bytes:
    return _HEAD.pack(n_a, n_b, n_groups, len(links)) + array("q", links).tobytes() + f"{groups};".encode()


class Words(dict):
    """What a word comes to: tokens of both sides, groups, links, and the groups as text; none where bytes differ.

    It is one string of bytes for each word, which takes less than half of what tuples and lists do.
    """

    def __init__(self, first: str, second: str) -> None:
        self.names = first, second
        self.held = 0
        side = _side(second)
        #: Whether the second side never joins a word to the one before it.
        self.apart = isinstance(_side(first), ByteLevel) and isinstance(side, Pieces) and not side.across

    def _one_by_one(self, words: list[str]) -> dict[str, bytes | None]:
        return {w: _packed(*aligned(*sides, *self.names)[0]) if sides else None for w, sides in zip(words, tokens_of(words, *self.names))}

    def clear(self) -> None:
        super().clear()
        self.held = 0

    def _learned(self, words: list[str]) -> dict[str, bytes | None]:
        """What words come to that are not known yet, which are then, but for very long ones.

        Words with plain ends are taken as one text with single spaces, which costs less than each by itself.
        """
        plain = [w for w in words if _ENDS.match(w)] if self.apart else []
        made = {}
        if len(plain) > 1:
            sides = tokens_of([" ".join(plain)], *self.names)[0]
            ends = list(accumulate(len(w.encode("utf-8", "replace")) + 1 for w in plain))
            parts = aligned(*sides, *self.names, ends) if sides else []
            if len(parts) == len(plain):
                made = {w: _packed(*p) for w, p in zip(plain, parts)}
        made |= self._one_by_one([w for w in words if w not in made])
        kept = {w: m for w, m in made.items() if len(w) <= _LONGEST}
        self.update(kept)
        self.held += sum(map(sys.getsizeof, kept)) + sum(map(sys.getsizeof, kept.values())) + _ENTRY * len(kept)
        return made

    def text(self, text: str) -> tuple[int, int, int, int, str, np.ndarray]:
        """Tokens of both sides, groups, links, the groups' digest, and the linked ids."""
        words = _BETWEEN.split(text) if self.apart else [text]
        if self.held > _REMEMBERED:
            self.clear()
        new = self._learned([w for w in dict.fromkeys(words) if w not in self]) if text else {}
        try:
            parts = list(map(self.__getitem__, words)) if text else [None]
        except KeyError:  # a very long word
            parts = [new[w] if w in new else self[w] for w in words]
        if None in parts:
            return 0, 0, 0, 0, "", np.empty(0, np.int64)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        whole = np.frombuffer(b"".join(parts), np.uint8)
        heads = whole[(np.cumsum(sizes) - sizes)[:, None] + np.arange(_HEAD.size)].view("<u4").astype(np.int64)
        linking = 8 * heads[:, 3]
        lengths = np.column_stack([np.full(len(parts), _HEAD.size), linking, sizes - linking - _HEAD.size])
        kinds = np.repeat(np.tile(np.arange(3, dtype=np.int8), len(parts)), lengths.ravel())
        linked, groups = whole[kinds == 1].view(np.int64), whole[kinds == 2]
        return *heads.sum(axis=0).tolist(), hashlib.sha256(groups[:-1]).hexdigest(), linked


@functools.lru_cache(maxsize=2)
def words_of(first: str, second: str) -> Words:
    """One per process and pair of tokenizers; what it remembers serves later tasks of the same worker."""
    return Words(first, second)


_DIGITS = {"n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "n_links": T.LongType(), "groups_sha256": T.StringType()}
_ARROW = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string()}


def _bundle(number: int, ids: pa.Array, rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """One record for several texts: their figures, and their links as places in the bundle's own list of pairs."""
    keys = np.concatenate([np.empty(0, np.int64), *[r[5] for r in rows]])
    owner = np.repeat(np.arange(len(rows)), [len(r[5]) for r in rows])
    pairs, slot = np.unique(keys, return_inverse=True)
    uses, times = np.unique(owner * max(1, len(pairs)) + slot, return_counts=True)
    text, slots = uses // max(1, len(pairs)), uses % max(1, len(pairs))
    one = lambda values, kind: pa.ListArray.from_arrays([0, len(values)], pa.array(values, kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()), pa.ListArray.from_arrays([0, len(rows)], ids),
            *[one([r[k] for r in rows], kind) for k, kind in enumerate(_ARROW.values())],
            one(np.searchsorted(text, np.arange(len(rows) + 1)), pa.int32()), one(slots, pa.int32()), one(times, pa.int32()),
            one(pairs, pa.int64()), one(np.bincount(slots, minlength=len(pairs)), pa.int64()),
        ],
        schema=schema,
    )


def bundles(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """The texts aligned, in bundles. A bundle's number is that of its partition and its place there."""
    source = texts(docs)
    kind = source.schema[ID].dataType
    more = {"firsts": T.IntegerType(), "slots": T.IntegerType(), "times": T.IntegerType(), "pairs": T.LongType(), "documents": T.LongType()}
    schema = T.StructType([T.StructField("bundle", T.LongType()), T.StructField("ids", T.ArrayType(kind))]
                          + [T.StructField(n, T.ArrayType(t)) for n, t in {**_DIGITS, **more}.items()])

    def run(batches):
        number, words = TaskContext.get().partitionId() << 32, words_of(first, second)
        arrow = None
        for batch in batches:
            arrow = arrow or pa.schema(
                [("bundle", pa.int64()), ("ids", pa.list_(batch.column(0).type)), *[(n, pa.list_(t)) for n, t in _ARROW.items()]]
                + [(n, pa.list_(pa.int64() if isinstance(t, T.LongType) else pa.int32())) for n, t in more.items()]
            )
            rows, begin, size = [], 0, 0
            for at, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                size += len(text)
                rows.append(words.text(text))
                if size >= BYTES or len(rows) == TEXTS or at + 1 == batch.num_rows:
                    yield _bundle(number, batch.column(0).slice(begin, len(rows)), rows, arrow)
                    number, begin, rows, size = number + 1, at + 1, [], 0

    return source.mapInArrow(run, schema)


def _summed(bundled: DataFrame, kind: T.DataType) -> DataFrame:
    """The figures of each text, its links weighed by the corpus-wide counts."""
    schema = T.StructType([T.StructField(ID, kind)] + [T.StructField(n, t) for n, t in _DIGITS.items()]
                          + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches):
        for batch in batches:
            for row in (batch.slice(k, 1) for k in range(batch.num_rows)):
                part = {n: row.column(n).flatten() for n in row.schema.names if n not in ("bundle", "looked")}
                looked = row.column("looked").flatten()
                n, best, places = (looked.field(k).to_numpy(zero_copy_only=False) if len(looked) else np.empty(0, np.int64) for k in ("n", "best", "slot"))
                counts, tops = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
                counts[places], tops[places] = n, best
                slots, times = part["slots"].to_numpy(), part["times"].to_numpy().astype(np.int64)
                sums = [np.concatenate([[0], np.cumsum(times * value[slots])]) for value in (tops, counts)]
                firsts = part["firsts"].to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [part["ids"], *[part[c] for c in _DIGITS], *[pa.array(s[firsts[1:]] - s[firsts[:-1]]) for s in sums]], names=schema.names
                )

    return bundled.mapInArrow(run, schema)


def align(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """One row per document: tokens of both sides, groups, links, the groups' digest, and sums over its links.

    ``n_best`` are the links whose pair of ids is linked in as many documents as any pair of its first id; ``count_sum``
    adds up for all links the documents that hold the pair. Null and empty texts, and those whose bytes either
    tokenizer changes, have no tokens: all figures are 0 and the digest is empty. Rows that are equal in id and text
    are documents of their own and count as often as they are there; null ids stay. Other columns are not read.
    """
    done = keep(bundles(docs, first, second), "alignments")
    pairs = done.select("bundle", F.posexplode(F.arrays_zip("pairs", "documents")).alias("slot", "found"))
    pairs = pairs.select("bundle", "slot", F.col("found.pairs").alias("pair"), F.col("found.documents").alias("documents"))
    counts = pairs.groupBy("pair").agg(F.sum("documents").alias("n"))
    # An id is linked with no more ids than the other vocabulary has, so a window over it is bounded.
    most = F.max("n").over(Window.partitionBy(F.floor(F.col("pair") / _IDS)))
    rated = counts.select("pair", "n", (F.col("n") == most).cast("long").alias("best"))
    looked = pairs.join(rated, "pair").groupBy("bundle").agg(F.collect_list(F.struct("slot", "n", "best")).alias("looked"))
    return _summed(done.drop("pairs", "documents").join(looked, "bundle", "left"), docs.schema[ID].dataType)
