"""Counting, scanning and encoding operators against plain versions of their contracts."""

import hashlib
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clearbrook.llm import chat, licenses, packing, pii, quality, secretscan, tokencount
from clearbrook.llm.tokens import Encoder
from clearbrook.llm.trigrams import trigram_query
from tests.llm.cases import documents


def _fuzz(seed, parts, count, longest):
    pick = random.Random(seed)
    return ["".join(pick.choice(parts) for _ in range(pick.randint(0, longest))) for _ in range(count)]


# --- tokens and packing -------------------------------------------------------

LETTERS = [*"ab C1 2\n\t .,é́ßİΣσ \x1c\x85漢😀\r'sllÄ#*09", "<|endoftext|>", "<|startoftext|>", "  ", "\n\n", " 's", "the ", " wor"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(name):
    ours, library = Encoder(name), Tokenizer.from_file(public_tokenizers.path(name))
    assert ours.by_word if name.startswith("word") else ours.ranked
    for text in _fuzz(1, LETTERS, 4000, 25):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ours.count(text) == len(expected)
        found = array("I")
        found.frombytes(ours.ids(text))
        assert found.tolist() == expected


def test_counts_come_from_the_cache(spark, tmp_path):
    cache = f"{tmp_path}/cache"
    first = {r["doc_id"]: tuple(r) for r in tokencount.token_counts(documents(spark), cache).collect()}
    stored = spark.read.parquet(cache)
    texts = documents(spark).selectExpr("coalesce(text, '') as t").distinct().count()
    assert stored.count() == texts  # each distinct text once
    again = {r["doc_id"]: tuple(r) for r in tokencount.token_counts(documents(spark), cache).collect()}
    assert again == first and spark.read.parquet(cache).count() == texts  # nothing was encoded again
    changed = stored.selectExpr("tokenizer", "digest", "n_bytes", "n_tokens + 5000 as n_tokens")
    changed.write.parquet(f"{tmp_path}/other")
    assert all(r["over_limit"] for r in tokencount.token_counts(documents(spark), f"{tmp_path}/other").collect())
    other = tokencount.token_counts(documents(spark), cache, tokenizer="byte_bpe_50k.json").collect()
    assert spark.read.parquet(cache).count() == 2 * texts and len(other) == documents(spark).count()


def test_bins_are_filled_to_the_last_place_where_possible():
    pick = random.Random(3)
    for _ in range(60):
        lengths = [pick.randint(1, 64) for _ in range(pick.randint(1, 80))]
        bins = packing.slack_bins(lengths, 64)
        assert Counter(x for b in bins for x in b) == Counter(lengths)
        assert all(sum(b) <= 64 for b in bins)
        # the first sequence has the longest piece and the best possible rest
        best, rest = {0}, sorted(lengths)[:-1]
        for x in rest:
            best |= {s + x for s in best if s + x <= 64 - max(lengths)}
        assert sum(bins[0]) == max(lengths) + max(best)


def test_packing_keeps_every_id_once(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(texts)
    for doc, parts in pieces.items():
        ids, at = [*library.encode(texts[doc], add_special_tokens=False).ids, 1], 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(array("I", ids[at : at + r["length"]]).tobytes())
            at += r["length"]
        assert at == len(ids)
    used = []
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.WINDOW
        used.append(at)
    assert sum(packing.WINDOW - u for u in used) < 0.02 * sum(used)


# --- quality ------------------------------------------------------------------


def test_quality_counts(spark, folder):
    space = re.compile(r"[^\x20\x09-\x0D]+")

    def plain(text):
        words = space.findall(text)
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        inside = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
        lines = [x for x in text.split("\n") if space.search(x)]
        failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed

    texts = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    texts += _fuzz(2, ["a ", "b ", "c\n", "a b c d e ", "#", "|", "\x0b", "\x85", "é"], 300, 60)
    rows = {r["doc_id"]: r for r in quality.quality_report(documents(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain(text)
        assert not (r["kept"] and r["base_failed"])


def test_compression_bands():
    import base64

    pick = random.Random(4)
    prose = " ".join("".join(pick.choice("etaoinshrdlu") for _ in range(pick.randint(1, 9))) for _ in range(4000))
    noise = base64.b85encode(pick.randbytes(20000)).decode()
    compressor = quality.zstandard.ZstdCompressor(level=quality.LEVEL)
    verdict = lambda text: quality.compression(text.encode(), compressor)[4]
    assert verdict(prose) == verdict(prose[:300]) == verdict("short") == verdict("") == ""
    assert verdict("once more and " * 200) == "repetitive"
    assert verdict(noise) == "incompressible"
    assert verdict(prose[:26000] + noise[:16000]) == "incompressible chunks"
    assert verdict(prose[:12000] + "again " * 3000) in ("repetitive", "repetitive chunks")


def test_every_part_of_a_text_is_judged():
    import base64

    pick = random.Random(13)
    prose = " ".join("".join(pick.choice("etaoinshrdlu") for _ in range(pick.randint(1, 9))) for _ in range(4000))
    noise = base64.b85encode(pick.randbytes(20000)).decode()
    compressor = quality.zstandard.ZstdCompressor(level=quality.LEVEL)
    verdict = lambda text: quality.compression(text.encode(), compressor)[4]
    for size in (2048, 3000, 3500, 5000, 6000, 8191, 9000, 12000, 13000, 20000):
        assert verdict(prose[:size]) == ""
        assert verdict(prose[: size // 2] + noise[: size // 2]) in ("incompressible", "incompressible chunks")
    for size in (0, 1, 2047, 2048, 2559, 3500, 6000, 8191, 8192, 16383, 16384, 50000):
        parts = quality.chunks_of(b"x" * size)
        assert len(parts) != 1 and sum(map(len, parts)) == (size if size >= 2048 else 0)
        assert all(len(p) >= quality.SHORT_CHUNK for p in parts)


def test_documents_of_good_quality_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    report = {r["doc_id"]: r for r in quality.quality_report(docs).collect()}
    kept = {r["doc_id"] for r in quality.keep_quality(docs).collect()}
    assert kept == {i for i, r in report.items() if r["kept"]}
    assert all(r["kept"] for r in report.values() if not r["base_failed"])  # the corpus has no other kind of junk


# --- licenses -----------------------------------------------------------------


def test_license_base_counts(spark):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
    texts = _fuzz(5, ["cc ", "by ", "CC-BY ", "General Public License, ", "all ", "rights ", "reserved. ", "é", "x ", "\n"], 400, 30)
    rows = {r["doc_id"]: r for r in licenses.license_scan(documents(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        words = word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        places, labels = [], set()
        for phrase, label in phrases:
            wanted = phrase.split()
            here = [k for k in range(len(words)) if words[k : k + len(wanted)] == wanted]
            places += here
            labels |= {label} if here else set()
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(places, default=None), max(places, default=None))
        assert r["base_labels"] == ",".join(sorted(labels)) and labels <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}), ("SPDX-License-Identifier: GPL-2.0-or-later", {"gpl-2"}),
        ("Released under the MIT License.", {"mit"}), ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc-4.0"}),
        ("GNU Lesser General Public License v2.1", {"gpl", "lgpl-2.1"}), ("Copyright (c) 2019 Somebody. All rights reserved.", {"copyright", "reserved"}),
        ("an ordinary sentence about a license plate", set()), ("Mozilla Public License 2.0 or the MIT license", {"mpl-2.0", "mit"}),
    ],
)
def test_license_rules(text, labels):
    found = licenses.scan(text)
    assert set(filter(None, found[5].split(","))) == labels


def _examples(parsed):
    """Texts that match a parsed expression: each choice once, optional parts out and in, classes by their first member."""
    made = [""]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            parts = [chr(value)]
        elif name == "IN":
            first, what = value[0]
            parts = [chr(what[0] if isinstance(what, tuple) else what)] if str(first) in ("LITERAL", "RANGE") else ["1" if "DIGIT" in str(what) else "x"]
        elif name == "BRANCH":
            parts = [x for choice in value[1] for x in _examples(choice)]
        elif name == "SUBPATTERN":
            parts = _examples(value[3])
        elif name == "MAX_REPEAT":
            parts = [x * max(value[0], n) for x in _examples(value[2]) for n in (0, 1)]
        else:
            assert name == "ASSERT"
            parts = [""]
        made = [a + b for a in made for b in dict.fromkeys(parts)]
    return list(dict.fromkeys(made))


def test_every_rule_passes_the_gate():
    pick = random.Random(12)
    for rule in licenses.rules():
        examples = _examples(re._parser.parse(rule.pattern.pattern.decode()))
        for example in pick.sample(examples, min(len(examples), 60)):
            joined = example.encode() + b" "
            assert rule.pattern.search(joined), example
            assert all(any(k in joined for k in group) for group in rule.keywords), (rule.label, example)
            assert any(g in joined for g in licenses._GATE), (rule.label, example)
    assert licenses.scan("See https://www.eclipse.org/legal/epl-2.0 for more.")[5] == "epl-2.0"


def test_no_detection_lies_within_another():
    assert len(licenses.rules()) > 300
    text = " licensed under the apache license version 2 0 apache license mit license gnu general public license version 3 "
    spans = [(a, b) for a, b, _ in licenses.detections(text.encode())]
    assert spans and not any(a <= c and d <= b for a, b in spans for c, d in spans if (a, b) != (c, d))


# --- secrets ------------------------------------------------------------------

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
SECRETS = ['token = "', "password", "passwd:", "API_KEY=", "apikey: ", "secret=", "AKIA", "ABCDEFGH1234567", "abcdef0123456789", "0f" * 9, " ", '"', "'", "é", "😀", "=", ":", "ghp_", "a" * 36, "-----BEGIN RSA PRIVATE KEY-----", "eyJ", "https://u:p@h", "Bearer ", "Z" * 30, "\n", "İ", "K"]


def _digest(spans):
    return hashlib.sha256(",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans)).encode()).hexdigest()


def test_secret_spans(spark):
    def plain(text):
        spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        return spans + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]

    texts = [*_fuzz(6, SECRETS, 800, 14), "0123456789abcdef " * 700]
    for r in secretscan.secret_scan(documents(spark, list(enumerate(texts)))).collect():
        expected = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == _digest(expected), texts[r["doc_id"]]
        assert r["n_hex"] == sum(s[3] == "hex" for s in expected)
        kinds = {s.split(":")[0] for s in r["spans"].split(",")}
        assert ("private_key" in kinds) == ("-----BEGIN RSA PRIVATE KEY-----" in texts[r["doc_id"]])


def test_trigram_queries():
    assert trigram_query("[0-9a-f]{16,}") == []
    assert trigram_query("AKIA[A-Z0-9]{14,}") == [frozenset({frozenset({"aki", "kia"})})]
    assert frozenset({"tok", "oke", "ken"}) in trigram_query(secretscan.BASE[0].pattern)[0]
    # whatever matches a rule fulfils its query
    for rule in secretscan.RULES:
        for text in [t for t in _fuzz(7, SECRETS, 3000, 8) if re.search(rule.pattern, t)]:
            for clause in trigram_query(rule.pattern):
                assert any(all(t in text.lower() for t in choice) for choice in clause), (rule.kind, text)


# --- personal data ------------------------------------------------------------


def _luhn(digits):
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in twice) % 10 == 0


def test_personal_data_base(spark):
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v, d: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v, d: all(int(x) <= 255 for x in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v, d: 14 <= len(d) <= 19 and _luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v, d: 10 <= len(d) <= 15),
    )
    parts = ["a.b@c.de", "@", ".com", "x@y", "+1 (555) 123-4567", "+49", "1.2.3.4", "255.255", ".", "300.1.1.1", "4111 1111 1111 1111", "4111-1111", "5500000000000004", " ", "é", "😀", "_d", "12", "0", "-", "(", ")", "Phone: ", "\n", "000255.0.0.1", "+1234567890123456"]
    texts = [*_fuzz(8, parts, 800, 12), "1" * 20000, "a." * 20000, "a@b" + ".c" * 20000, "1 " * 20000]
    for r in pii.personal_data(documents(spark, list(enumerate(texts)))).collect():
        text = texts[r["doc_id"]]
        expected = [(m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m[0], re.sub("[^0-9]", "", m[0]))]
        assert r["base_sha256"] == _digest(expected), text[:80]


def test_patterns_of_seeds_find_unseen_values(spark):
    rows = [(i, f"Write or call. Phone no: +1 (555) 10{i}-4567 today") for i in range(6)]
    rows += [(10, "Write or call. Phone no: 0151-998877 today"), (11, "The ratio: 12345 of all"), (12, "Phone no: none")]
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(documents(spark, rows)).collect()}
    text = dict(rows)[10]
    assert found[10] == f"like_phone:{text.index('0151')}:{text.index(' today')}"
    assert found[11] == found[12] == ""


def test_words_announce_values_without_a_sign(spark):
    forms = {
        "Ask for phone number {}": "phone", "your customer no {}": "phone", "The caller no. {}": "phone", "a hotline nr.{}": "phone",
        "a line id{}": "phone", "there is no fax number {}": "phone", "Contact: desk number {}": "phone", "my client ID {}": "email",
    }
    seeds = {"phone": "+1 (555) 10{}-4567", "email": "a{}@b.de"}
    rows, unseen = [], {}
    for k, (form, kind) in enumerate(forms.items()):
        rows += [(10 * k + i, form.format(seeds[kind].format(i)) + " today") for i in range(5)]
        text = form.format(f"4711-{k}") + " today"
        rows.append((10 * k + 9, text))
        unseen[10 * k + 9] = f"like_{kind}:{text.index('4711')}:{text.index(' today')}"
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(documents(spark, rows)).collect() if r["doc_id"] % 10 == 9}
    assert found == unseen


# --- chats --------------------------------------------------------------------


def test_chat_round_trip(spark):
    texts = [*_fuzz(9, ["</s>", "[INST]", "<|im_end|>\n", "<|im_start|>", "\\", "\\e", "\\l", "<", "\n", "é", "a", "<<SYS>>"], 200, 8), ""]
    rows = [(i // 4, i % 4, ("user", "assistant", None, "to\nol")[i % 4], t) for i, t in enumerate(texts)]
    rows += [(None, None, None, None), (900, 1, "assistant", "b"), (900, 1, "assistant", "b"), (900, None, "user", None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    turns = chat.turns_of_table(table, "conv_id", "turn", fields=("role", "text"))
    formatted = chat.format_chats(turns, "conv_id", "turn")
    back = {r["conv_id"]: r for r in chat.read_back(formatted, "conv_id").collect()}
    grouped = defaultdict(list)
    for conv, turn, role, text in rows:
        grouped[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(back) == set(grouped)
    for conv, said in grouped.items():
        said.sort()
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in said)
        loss = "".join(text for _, _, role, text in said if role == "assistant")
        r = back[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(said), hashlib.sha256(whole.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in formatted.collect():
        assert r["formatted"].count(chat.OPEN) == r["formatted"].count(chat.CLOSE) == len(r["spans"])


def test_layouts_are_told_by_their_fields(spark):
    rows = [
        ('{"prompt":"a","completion":"b"}', "prompt and completion", [("user", "a"), ("assistant", "b")]),
        ('{"output":"x","instruction":"do","input":"in"}', "instruction, input and output", [("user", "do\n\nin"), ("assistant", "x")]),
        ('{"instruction":"do","input":"","output":null}', "instruction, input and output", [("user", "do"), ("assistant", "")]),
        ('{"messages":[{"role":"user","content":"hi"},{"content":"yo","role":"assistant"}]}', "messages", [("user", "hi"), ("assistant", "yo")]),
        ('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"w"}]}', "conversations", [("user", "q"), ("assistant", "w")]),
        ('{"a":{"prompt":1,"completion":2}}', None, None), ('{"prompt":{"completion":1}}', None, None), ("no json", None, None), (None, None, None),
    ]
    frame = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "id long, record string")
    for r in chat.turns_of_json(frame, "id").collect():
        _, layout, turns = rows[r["id"]]
        assert (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) == (layout, turns)
