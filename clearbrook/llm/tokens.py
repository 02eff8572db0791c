"""Encoding by tokenizer files, without the general normalisers and splitters where a text does not need them.

Word layouts drop white space, so words are encoded independently of each other and their counts can be remembered; a
new word of ordinary letters goes straight to the library's model. Vocabularies whose ids are in the order of their
merges are read by the faster of the two libraries for them. A text or word that is not surely of that kind, or a
tokenizer of another layout, goes whole to the library that the file is for.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer, pre_tokenizers

#: Words remembered by a worker; beyond that it forgets them all and begins anew, which bounds its memory.
REMEMBERED = 600_000

#: Letters that all versions of the Unicode tables agree on, and that have one lower-case form of one character.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: What the word layout's pattern comes to over plain characters.
_WORD_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")
#: Characters that the tables of both libraries agree on; assigned long ago, and no rare white space.
_AGREED = re.compile("[\t\n\r -~\xa1-\u024f\u0391-\u03a9\u03b1-\u03c9\u0400-\u045f\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*")


def place(name: str) -> str:
    """The path of a tokenizer: a path as it is, a bare name among the installed public files."""
    return name if "/" in name else public_tokenizers.path(name)


@functools.cache
def version(name: str) -> str:
    """Digest of the tokenizer file, so that counts of another version are never taken for this one's."""
    with open(place(name), "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


class Encoder:
    """A tokenizer of this process, with what it remembers."""

    def __init__(self, name: str) -> None:
        with open(place(name), encoding="utf-8") as file:
            config = json.load(file)
        self.library = Tokenizer.from_file(place(name))
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in config["added_tokens"])
        split, steps = config["pre_tokenizer"], (config["normalizer"] or {}).get("normalizers", [])
        #: Encoded word by word: white space is dropped, so words between it do not see each other.
        self.by_word = plain and [n["type"] for n in steps] == ["NFC", "Replace", "Lowercase"] and split["type"] == "Sequence"
        self.by_word = self.by_word and split["pretokenizers"][0].get("behavior") == "Removed" and split["pretokenizers"][0].get("invert")
        #: Byte-level pieces over the text as it is.
        self.by_bytes = plain and not steps and split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.written = {c: level.pre_tokenize_str(chr(c))[0][0] for c in (10, *range(32, 127), *range(0xC0, 0x100))}
        self.ranked = _ranked(config["model"], self.written, self.special) if self.by_bytes else None
        self.counts: dict[bytes, int] = {}

    def encode(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _count(self, word: bytes) -> int:
        if word.isalpha():  # of bytes: ASCII letters only, which the vocabulary writes as they are
            return len(self.model.tokenize(word.lower().decode("ascii")))
        text = word.decode("utf-8", "replace")
        if not _PLAIN.fullmatch(text) or "<" in text and any(s in text for s in self.special):
            return len(self.encode(text))
        pieces = _WORD_PIECES.findall(text.lower())
        if not text.isascii():
            pieces = [p.translate(self.written) for p in pieces]
        return sum([len(self.model.tokenize(p)) for p in pieces])

    def count(self, text: str) -> int:
        if not self.by_word:
            return len(self.encode(text))
        words = text.encode("utf-8", "surrogatepass").split()  # ASCII white space only, which every library knows
        known = self.counts
        new = [w for w in set(words) if w not in known]
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = set(words)
            known.update((w, self._count(w)) for w in new)
        return sum(map(known.__getitem__, words))

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        for special, number in self.special.items():
            if special in text:
                return _bytes([number]).join(map(self.ids, text.split(special)))
        return _bytes(self.ranked(text) if self.ranked and _AGREED.fullmatch(text) else self.encode(text))


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _ranked(model: dict, written: dict[int, str], special: dict[str, int]):
    """An encoder for vocabularies whose ids are in the order of their merges; None for others."""
    vocabulary, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    places = [vocabulary.get("".join(m)) for m in merges]
    if model.get("end_of_word_suffix") or places != list(range(256, 256 + len(merges))):
        return None
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    plain = {level.pre_tokenize_str(chr(b))[0][0]: b for b in range(128)}
    for high in range(0x80, 0x800, 0x40):  # each lead and trailing byte of two-byte characters
        for c in range(high, high + 0x40):
            plain |= dict(zip(level.pre_tokenize_str(chr(c))[0][0], chr(c).encode()))
    known = {b for b in plain.values()}
    rest = [b for b in range(256) if b not in known]  # bytes that no two-byte character has
    spare = sorted(t for t in vocabulary if len(t) == 1 and t not in plain)
    plain |= dict(zip(spare, rest))
    ranks = {bytes(map(plain.__getitem__, t)): n for t, n in vocabulary.items() if t not in special}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@functools.lru_cache(maxsize=4)
def encoder(name: str) -> Encoder:
    """One per process and tokenizer; what it remembers serves later tasks of the same worker."""
    return Encoder(name)
