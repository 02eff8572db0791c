"""Similarity operators against plain versions over all pairs."""

import random
import re
from collections import Counter

import numpy as np
import xxhash

from clearbrook.llm import decontaminate, repeats, simhash
from clearbrook.llm.components import components
from tests.llm.cases import documents

WORDS = [f"w{i}" for i in range(400)]


def _words(pick, n):
    return [pick.choice(WORDS) for _ in range(n)]


def test_fingerprint_by_definition():
    pick = random.Random(1)
    for text in ["", " ", "One", "one TWO", "É x  y\tz", *(" ".join(_words(pick, pick.randint(1, 60))) for _ in range(40))]:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _reachable(prints):
    """Smallest fingerprint reachable from each, over all pairs."""
    prints = sorted(prints)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_links_in_crowded_and_sparse_signatures(spark):
    pick = random.Random(2)
    prints = {0}
    for _ in range(12):
        centre = pick.getrandbits(64)
        prints |= {centre} | {centre ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64)) for _ in range(pick.choice([1, 4, 60]))}
    chain = pick.getrandbits(64)
    for k in range(0, 40, 2):  # far ends are linked only over the others
        chain ^= 3 << k
        prints.add(chain)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r["u"]: r["root"] for r in components(simhash.links(frame)).collect()}
    assert {p: roots.get(p, p) for p in signed} == _reachable(signed)


def test_components_and_what_stays(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = {i: int(r["fingerprint"], 16) for i, r in rows.items()}
    roots = _reachable(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    assert {i: r["component_id"] for i, r in rows.items()} == {i: least[roots[p]] for i, p in prints.items()}
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == sorted(set(least.values()))


def test_one_of_each_group_stays_without_ids(spark):
    rows = [(None, "first text of three words"), (None, "first text of three words"), (None, "another one here"), (4, "another one here"), (5, None), (6, "")]
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in simhash.keep_one(documents(spark, rows)).collect())
    assert kept == [(0, "first text of three words"), (4, "another one here"), (5, "")]


def test_decontamination_against_all_windows(spark):
    def split(text):
        return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").lower()) if w]

    def shingles(text):
        words = split(text)
        return [tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))] if words else []

    pick = random.Random(4)
    items = [(i, " ".join(_words(pick, pick.choice([3, 5, 6, 9, 20, 40, 60])))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "a a a a a a a a a b"), (103, "one two three")]
    docs = []
    for i in range(250):
        words = _words(pick, pick.randint(0, 120))
        if i % 2:
            passage = split(pick.choice(items[:40])[1])
            for _ in range(pick.choice([0, 0, 1, 1, 2])):
                passage[pick.randrange(len(passage))] = pick.choice(WORDS)
            if pick.random() < 0.2:
                del passage[pick.randrange(len(passage))]
            at = pick.randint(0, len(words))
            words[at:at] = passage
        docs.append((i, " ".join(words)))
    docs += [(602, "One, two; THREE"), (603, "x a a a a a a a a a b y"), (604, docs[1][1]), (604, docs[1][1])]
    expected = Counter()
    sets = [(i, shingles(t)) for i, t in items]
    for i, text in docs:
        own, found = shingles(text), []
        for item, wanted in sets:
            for at in range(len(own)) if wanted and set(wanted) & set(own) else ():
                window = Counter(own[at : at + len(wanted)])
                overlap = sum((window & Counter(wanted)).values())
                if overlap >= 0.8 * (sum(window.values()) + len(wanted) - overlap):
                    found.append(item)
                    break
        expected[i, ",".join(map(str, sorted(found)))] += 1
    frame, benchmark = documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    assert Counter((r["doc_id"], r["item_ids"]) for r in decontaminate.decontamination_report(frame, benchmark).collect()) == expected
    clean = sorted(r["doc_id"] for r in decontaminate.drop_contaminated(frame, benchmark).collect())
    assert clean == sorted(i for i, found in expected.elements() if not found)


def test_large_benchmarks_are_searched_in_blocks(spark, monkeypatch):
    passages = [" ".join(_words(random.Random(i), 30)) for i in range(8)]
    benchmark = spark.createDataFrame(list(enumerate(passages)), "item_id long, text string")
    frame = documents(spark, [(i, f"before {p} after") for i, p in enumerate(passages)])
    monkeypatch.setattr(decontaminate, "BROADCAST", 50)
    assert {r["doc_id"]: r["item_ids"] for r in decontaminate.decontamination_report(frame, benchmark).collect()} == {i: str(i) for i in range(8)}


def test_repeated_passages_go_wherever_they_begin(spark):
    pick = random.Random(5)
    passages = [[f"p{k}x{pick.randrange(10**6)}" for _ in range(n)] for k, n in enumerate((50, 51, 60, 75, 120))]
    rows, later = [], {}
    first = {}
    for i in range(120):
        words = [f"d{i}x{pick.randrange(10**6)}" for _ in range(pick.randint(0, 90))]
        if i % 3:
            k = pick.randrange(len(passages))
            at = pick.randint(0, len(words))
            words[at:at] = passages[k]
            if k in first:
                later[i] = (k, at)
            first.setdefault(k, i)
        rows.append((i, "".join(w + pick.choice([" ", "\n", "  ", "\t "]) for w in words)))
    rows += [(900, rows[1][1]), (901, None), (902, "")]
    found = {r["doc_id"]: r for r in repeats.line_dedup(documents(spark, rows)).collect()}
    for i, text in rows[:120]:
        r, words = found[i], text.split()
        if i in later:
            k, at = later[i]
            assert r["text"].split() == words[:at] + words[at + len(passages[k]) :] and r["removed_words"] == len(passages[k])
            start, stop = map(int, r["removed_spans"].split(":"))
            assert text[:start] + text[stop:] == r["text"]
        else:
            assert r["text"] == text and r["removed_words"] == 0
    copied = len(rows[1][1].split())
    assert found[900]["removed_words"] == (copied if copied >= repeats.LEAST else 0)
    left = {r["doc_id"]: r["text"] for r in repeats.drop_repeats(documents(spark, rows)).collect()}
    assert (900 in left) == (copied < repeats.LEAST) and left[901] is None and left[902] == ""


def test_whole_copies_go_though_a_fragment_stands_earlier(spark):
    pick = random.Random(8)
    rows, kept = [], {}
    for k, n in enumerate([50, 51, 60, 74, 90, 130] * 12):
        passage = [f"p{k}x{pick.randrange(10**6)}" for _ in range(n)]
        size = pick.randint(26, 49)
        at = pick.randint(0, n - size)
        for part, whole in enumerate([passage[at : at + size], passage, passage, passage]):
            before, after = ([f"d{k}x{part}x{pick.randrange(10**6)}" for _ in range(pick.randint(0, 60))] for _ in range(2))
            rows.append((4 * k + part, " ".join(before + whole + after)))
            kept[4 * k + part] = before + (whole if part < 2 else []) + after
    found = {r["doc_id"]: r["text"].split() for r in repeats.line_dedup(documents(spark, rows)).collect()}
    assert found == kept


def test_windows_repeated_earlier_are_found_against_all(spark):
    pick = random.Random(9)
    passages = [[f"p{k}x{i}" for i in range(160)] for k in range(4)]
    rows = []
    for i in range(150):
        words = [f"d{i}x"]
        for _ in range(pick.randint(0, 3)):
            size, passage = pick.randint(20, 110), pick.choice(passages)
            at = pick.randint(0, 160 - size)
            words += [*passage[at : at + size], f"d{i}x{len(words)}"]
        rows.append((i, " ".join(words)))
    seen, must = set(), {}
    for i, text in rows:
        words = text.split()
        windows = [tuple(words[k : k + repeats.LEAST]) for k in range(len(words) - repeats.LEAST + 1)]
        must[i] = {w for k, window in enumerate(windows) if window in seen for w in range(k, k + repeats.LEAST)}
        seen |= set(windows)
    text = dict(rows)
    for r in repeats.line_dedup(documents(spark, rows)).collect():
        spans = [tuple(map(int, s.split(":"))) for s in r["removed_spans"].split(",") if s]
        places = [m.start() for m in re.finditer(r"\S+", text[r["doc_id"]])]
        gone = {w for w, at in enumerate(places) if any(a <= at < b for a, b in spans)}
        assert must[r["doc_id"]] <= gone


def test_repetition_within_a_text_keeps_the_first(spark):
    block = " ".join(f"b{i}" for i in range(60))
    found = repeats.line_dedup(documents(spark, [(1, f"{block} middle {block} end"), (2, "a " * 300)])).collect()
    texts = {r["doc_id"]: r["text"] for r in found}
    assert texts[1].split() == f"{block} middle end".split()
    assert texts[2].split() == ["a"] * repeats.GRAM


def test_a_phrase_at_many_places_of_a_text_is_few_rows(spark, monkeypatch):
    pick = random.Random(10)
    phrases = [[f"p{k}x{i}" for i in range(n)] for k, n in enumerate((1, 3, 7, 12, 31))]
    rows = []
    for i in range(40):
        phrase, times = pick.choice(phrases), pick.randint(3, 60)
        words = [*_words(pick, pick.randint(0, 40)), *phrase * times, *_words(pick, pick.randint(0, 40)), *phrase * (times // 2)]
        rows.append((i if i % 10 else None, " ".join(words[pick.randint(0, 5) :])))
    kept, keep = {}, repeats.keep

    def counted(frame, label):
        made = keep(frame, label)
        kept[label] = made.count()
        return made

    monkeypatch.setattr(repeats, "keep", counted)
    found = {(r["doc_id"], r["n_words"], r["removed_words"]): r["removed_spans"] for r in repeats.line_dedup(documents(spark, rows)).collect()}
    words = sum(len(text.split()) for _, text in rows)
    assert kept["occurrences"] < words / 3 and kept["covered"] < words / 3 and kept["windows"] < words / 3
    # By id, rows without one last; those by the order that the result itself has: the text's hash.
    digest = {r[0]: r[1] for r in spark.createDataFrame([(t,) for _, t in rows], "t string").selectExpr("t", "xxhash64(t)").collect()}
    seen, seen_lines, checked = set(), set(), 0
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, digest[r[1]])):
        words = text.split()
        [spans] = [s for (j, n, _), s in found.items() if (j, n) == (i, len(words)) and all(int(x) <= len(text) for part in s.split(",") if s for x in part.split(":"))]
        places = [m.start() for m in re.finditer(r"\S+", text)]
        gone = {w for w, at in enumerate(places) for a, b in (map(int, s.split(":")) for s in spans.split(",") if s) if a <= at < b}
        must, may = set(), set()
        for size, known, into in ((repeats.LEAST, seen, must), (repeats.GRAM, seen_lines, may)):
            runs = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]
            for k, run in enumerate(runs):
                if run in known:
                    into |= set(range(k, k + size))
            first = {}
            for k, run in enumerate(runs):
                if run not in known and first.setdefault(run, k) < k:  # later in the text: what lies behind the first
                    into |= set(range(max(k, first[run] + size), k + size))
            known |= set(runs)
        pieces = "".join("x" if w in must else " " for w in range(len(words)))  # shorter ones stay
        must = {w for piece in re.finditer("x" * repeats.LEAST + "+", pieces) for w in range(*piece.span())}
        assert must <= gone <= may
        checked += len(must)
    assert checked > 1000


def test_filters_grow_with_the_lines_and_decide_nothing(spark, monkeypatch):
    monkeypatch.setattr(repeats, "FILTER_BITS", (10, 24))
    values = spark.range(120_000).selectExpr("xxhash64(id) line")
    others = np.array([r[0] for r in spark.range(200_000, 220_000).selectExpr("xxhash64(id)").collect()]).view(np.uint64)
    for n, most in ((100, 0.1), (40_000, 0.1)):
        twice = spark.range(n).selectExpr("xxhash64(id) line")
        marks = repeats._filter(values.union(twice))
        assert repeats._marked(marks, np.array([r[0] for r in twice.collect()]).view(np.uint64)).all()
        assert repeats._marked(marks, others).mean() < most and 8 * len(marks) <= 2 * repeats.SPARE * max(n, 64)
    pick = random.Random(11)
    passages = [[f"p{k}x{i}" for i in range(90)] for k in range(5)]
    rows = [(i, " ".join([*_words(pick, pick.randint(0, 60)), *pick.choice(passages)[pick.randint(0, 30) :], *["a b"] * pick.randint(0, 70)])) for i in range(60)]
    found = []
    for bits in ((26, 29), (3, 3)):  # all are marked
        monkeypatch.setattr(repeats, "FILTER_BITS", bits)
        found.append(sorted(map(tuple, repeats.line_dedup(documents(spark, rows)).collect())))
    assert found[0] == found[1] and sum(r[3] for r in found[0]) > 1000


def test_winnowing_guarantee():
    pick = random.Random(6)
    for _ in range(200):
        shared = [f"s{pick.randrange(10**6)}".encode() for _ in range(repeats.LEAST)]
        sides = [[f"{k}{pick.randrange(10**6)}".encode() for _ in range(pick.randint(0, 80))] for k in "abcd"]
        texts = [b" ".join(a + shared + b).decode() for a, b in (sides[:2], sides[2:])]
        one, two = (np.concatenate([part[4] for part in repeats.fingerprints([t])]) for t in texts)
        both = list(repeats.fingerprints(["few words", texts[0], "", texts[1]]))  # texts taken together are as if alone
        assert sorted(np.concatenate([p[4] for p in both]).tolist()) == sorted([*one.tolist(), *two.tolist()])
        assert np.intersect1d(one, two).size


def test_words_and_their_hashes(monkeypatch):
    pick = random.Random(7)
    monkeypatch.setattr(repeats, "_BLOCK", 64)
    texts = ["", " ", "a", " a", "a ", "x" * 200 + " y " + "x" * 200, "é 漢字\x1c\x85 z", *("".join(pick.choice("ab \n\t\x0b") for _ in range(400)) for _ in range(50))]
    seen = {}
    for text in texts:
        raw = text.encode()
        starts, stops = repeats.word_places(raw)
        words = [raw[a:b] for a, b in zip(starts, stops)]
        assert words == raw.split()
        for word, value in zip(words, repeats.word_hashes(raw, starts, stops).tolist()):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
