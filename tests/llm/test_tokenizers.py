"""Alignment of two tokenizers against every pair of tokens."""

import collections
import gc
import hashlib
import random
import tracemalloc

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clearbrook.llm import alignment
from clearbrook.llm.common import ship
from tests.llm.cases import ROWS, documents

FIRST = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
LETTERS = alignment._byte_of()
ODD = [
    "", " ", "  two  blanks\n\n\ttab", "a▁b", "<|endoftext|> and </s> <s>", "漢字かな交じり文と絵文字😀👍🏽", "naïve café ﬁne Å", "\x00\x01\x7f", "x" * 5000,
    "0123456789 3.14 -1", "don't 'll I've", "  ​", "🇩🇪" * 3, "<0x41>", "ｆｕｌｌ　ｗｉｄｔｈ", "\r\n\r\n", "مرحبا بالعالم", "end ",
]


def _ranges(tokens):
    at, found = 0, []
    for token in tokens:
        found.append((at, at + len(token)))
        at += len(token)
    return found


def _plain(text):
    """(n_a, n_b, groups, links), by comparing ranges."""
    whole = f" {text}".encode()
    a, b = FIRST.encode(f" {text}", add_special_tokens=False).ids, SECOND.encode(text)
    left = [bytes(LETTERS[c] for c in FIRST.id_to_token(i)) for i in a]
    right = [bytes([int(p[3:5], 16)]) if SECOND.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, SECOND.id_to_piece(i)) for i in b)]
    if not text or b"".join(left) != whole or b"".join(right) != whole:
        return 0, 0, None, []
    ra, rb = _ranges(left), _ranges(right)
    links, first = [], 0
    for n, (start, stop) in enumerate(ra):
        while rb[first][1] <= start:
            first += 1
        for m in range(first, len(rb)):
            if rb[m][0] >= stop:
                break
            links.append((a[n], b[m]))
    groups, previous = [], 0
    for end in sorted({e for _, e in ra} & {e for _, e in rb}):
        groups.append([[i for i, r in zip(ids, ranges) if previous < r[1] <= end] for ids, ranges in ((a, ra), (b, rb))] if len(ra) < 400 else end)
        previous = end
    return len(a), len(b), groups, links


@pytest.mark.parametrize("text", ODD)
def test_one_text(text):
    n_a, n_b, groups, links = _plain(text)
    sides = alignment.tokens_of([text])[0] if text else None
    assert (sides is None) == (groups is None)
    if sides:
        ((*sizes, text_of_groups, pairs),) = alignment.aligned(*sides)
        assert sizes == [n_a, n_b, len(groups)]
        assert sorted((p // alignment._IDS, p % alignment._IDS) for p in pairs) == sorted(links)
        if n_a < 400:
            assert text_of_groups == ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
    assert alignment.words_of(alignment.FIRST, alignment.SECOND).text(text)[:4] == (n_a, n_b, len(groups or []), len(links))


def _whole(text):
    """The figures of a text taken as one piece."""
    sides = alignment.tokens_of([text])[0] if text else None
    if not sides:
        return 0, 0, 0, 0, "", []
    ((n_a, n_b, n_groups, groups, links),) = alignment.aligned(*sides)
    return n_a, n_b, n_groups, len(links), hashlib.sha256(groups.encode()).hexdigest(), links


WORDS = ["the", "it's", "'t", "naïve", "x", "3.14", "2024-01-09", "a_b", "<|endoftext|>", "</s>", "▁", "漢字", "😀", "\n", "\t", "\x1c", "\x85", "\xa0", "\u3000",
         "\u200b", "", " ", "  ", "Ä", "ß", "ø.", "(x)", "--", "é", "\u0301", "ﬁ", "the.The", "\r\n", "<0x0A>", "\x00"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(WORDS), st.sampled_from([" ", "", " ", "\n", "  "])), max_size=25))
def test_words_come_to_what_the_whole_text_comes_to(parts):
    text = "".join(a + b for a, b in parts)
    *figures, links = alignment.words_of(alignment.FIRST, alignment.SECOND).text(text)
    assert (*figures, links.tolist()) == _whole(text)


def test_documents_by_words_and_whole(spark, folder):
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect():
        *figures, links = alignment.words_of(alignment.FIRST, alignment.SECOND).text(r["text"] or "")
        assert (*figures, links.tolist()) == _whole(r["text"] or "")


def test_counts_over_the_corpus(spark, monkeypatch):
    ship(spark)
    rows = ROWS + [(100 + k, t) for k, t in enumerate(ODD)] + [(200 + k, "same words here, and the same again") for k in range(40)]
    found = alignment.align(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    plain = {text: _plain(text or "") for _, text in rows}
    held = collections.Counter(pair for _, text in rows for pair in set(plain[text][3]))
    top = collections.Counter()
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    expected = []
    for i, text in rows:
        n_a, n_b, groups, links = plain[text]
        expected.append((i, n_a, n_b, len(groups or []), len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links)))
    got = [(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert {r["groups_sha256"] for r in found if not r["n_a"]} == {""}
    one = next(r for r in found if r["doc_id"] == 200)
    text = ";".join("|".join(",".join(map(str, s)) for s in g) for g in plain["same words here, and the same again"][2])
    assert one["groups_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_bundles_of_any_size_count_alike(spark, folder, monkeypatch):
    ship(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    key = lambda r: r["doc_id"]
    whole = sorted(alignment.align(docs).collect(), key=key)
    sources = docs.repartition(13)
    assert sorted(alignment.align(sources).collect(), key=key) == whole


def test_empty_table(spark):
    assert alignment.align(documents(spark, []).where("false")).collect() == []


def _texts_of_new_words(letters, length, n=60):
    """Texts of 100 words each with plain ends, none of which stands twice."""
    drawn = random.Random(5)
    words = list(dict.fromkeys(f"a{''.join(drawn.choices(letters, k=length))}b" for _ in range(200 * n)))
    return [" ".join(words[100 * k : 100 * k + 100]) for k in range(n)]


@pytest.mark.parametrize("letters, length, most", [("etaoinshrdlu", 8, 300), ("漢字かな交じり文😀", 12, 1200)])
def test_remembered_words_take_the_memory_that_they_are_counted_with(letters, length, most):
    words = alignment.Words(alignment.FIRST, alignment.SECOND)
    words.text("word")
    texts = _texts_of_new_words(letters, length)
    gc.collect()
    tracemalloc.start()
    try:
        for text in texts:
            words.text(text)
        gc.collect()
        taken = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(words) > 5900
    assert taken < most * len(words)
    assert 0.7 * words.held < taken < 1.3 * words.held


def test_words_are_forgotten_by_their_bytes(monkeypatch):
    monkeypatch.setattr(alignment, "_REMEMBERED", 100_000)
    words = alignment.Words(alignment.FIRST, alignment.SECOND)
    sizes = []
    for text in _texts_of_new_words("etaoinшж漢😀", 20):
        *figures, links = words.text(text)
        assert (*figures, links.tolist()) == _whole(text)
        sizes.append(words.held)
    assert max(sizes) < 100_000 + 200_000  # of one text's words
    assert sum(b < a for a, b in zip(sizes, sizes[1:])) > 3
