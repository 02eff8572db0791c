"""Line dedup by winnowing.

Passages are copied from page to page with any text around them, so they begin and end within the lines of a file.
What is hashed is therefore not the file's lines but the text's words wrapped into lines of a fixed number of words,
one line beginning at every word. In every window of consecutive line hashes the smallest are the fingerprints; a run
of ``GRAM + REACH - 1`` words that two texts share has a whole window in both, and so a fingerprint in common.

Of equal fingerprints the first occurrence, by id, text and place, stays. Every later one is joined with it and
extended word by word on both sides; what the extended matches of a text cover, in one piece of at least
``LEAST`` words, is deleted. A first occurrence in the same text is not touched by its repetition.

The first occurrence of a fingerprint may stand in a fragment, and the first whole copy of the passage elsewhere. So
windows of ``LEAST`` words that an occurrence does not share with the first one get a key, a hash of the whole window,
and of equal keys all but the first are deleted too. A window belongs to the fingerprint that is its smallest line,
which equal windows have in common; where one of them is shared with the fingerprint's first occurrence, all are. So
every window that stands earlier in the corpus is found, by one of the two ways. Equal windows have at least ``HALF``
words in common before the line, or as many after it; only those whose half stands more than once get a key.

Texts that repeat a few words very often have the same line, and the same window, at thousands of places. Places of a
text whose words are the same as far as a window reaches are one row, and so is what equal windows of a text cover.

The texts are read four times and shuffled once. Between the readings only filters of a fixed size go through the
driver, in which all repeated fingerprints or halves, and some others, are marked; they save work and decide nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbrook.llm.common import ID, TEXT, discard, keep, texts

#: Words of a line, and lines of a window: any run of 50 words shares a fingerprint.
GRAM, REACH = 26, 25
#: Words from which a repeated run is deleted.
LEAST = GRAM + REACH - 1
#: Words beside a line that equal windows around it share on one side at least: a window has REACH - 1 on both together.
HALF = (REACH - 1) // 2
#: Bits of a filter, as powers of two: 8 MB at least, 64 MB for a corpus of any size.
FILTER_BITS = (26, 29)
#: Bits of a filter for each line that is marked; one in as many of the others is marked too.
SPARE = 16
#: Bytes whose words are hashed at a time.
_BLOCK = 1 << 20
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_FACTOR = 0x9E3779B97F4A7C15
_BACK = pow(_FACTOR, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the factor and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_FACTOR, _BACK)):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """The extreme of every ``size`` neighbours, by doubling."""
    have, best = 1, values
    while 2 * have <= size:
        best, have = pick(best[:-have], best[have:]), 2 * have
    return best if have == size else pick(best[: len(best) - (size - have)], best[size - have :])


def word_places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after its last."""
    if not raw:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    space = _SPACE[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    edges = np.concatenate([[0] * (not space[0]), edges, [len(raw)] * (not space[-1])]).astype(np.int64)
    return edges[::2], edges[1::2]


def word_hashes(raw: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A polynomial hash of each word, from running sums over the bytes; long texts are taken in blocks."""
    hashes = np.empty(len(starts), np.uint64)
    data, at = np.frombuffer(raw, np.uint8), 0
    while at < len(starts):
        until = max(at + 1, int(np.searchsorted(stops, starts[at] + _BLOCK, side="right")))
        low, high = int(starts[at]), int(stops[until - 1])
        if high - low > _BLOCK:  # one word longer than a block
            hashes[at] = xxhash.xxh64_intdigest(raw[low:high])
        else:
            up, down = _powers(high - low)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
            first, last = starts[at:until] - low, stops[at:until] - low
            part = (sums[last] - sums[first]) * down[first]
            part = (part ^ (part >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            hashes[at:until] = part ^ (part >> np.uint64(29))
        at = until
    return hashes


def winnow(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and values of the fingerprints in word hashes, and the smallest line of each window (0 over two texts).

    ``text`` numbers the text that each word belongs to.
    """
    if len(hashes) < LEAST:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    up, down = _powers(len(hashes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
    lines = (sums[GRAM:] - sums[:-GRAM]) * down[: len(hashes) - GRAM + 1]
    lines = (lines ^ (lines >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    lines ^= lines >> np.uint64(29)
    lines |= np.uint64(1)  # zero is none
    least = _sliding(lines, REACH, np.minimum)
    least[text[: len(least)] != text[LEAST - 1 :]] = 0  # a window over two texts
    edge = np.zeros(REACH - 1, np.uint64)
    # A line is the smallest of some window exactly if it equals the largest of the minima of its windows.
    places = np.flatnonzero(lines == _sliding(np.concatenate([edge, least, edge]), REACH, np.maximum))
    return places, lines[places], least


def fingerprints(texts_: list[str]):
    """Of each group of texts: the fingerprints' texts, the words' texts in the group and each text's first word, the
    fingerprints' places and values, the word hashes, and the smallest line of each window.

    Short texts are taken together, so that each step works on long arrays.
    """
    group: list[bytes] = []
    numbers: list[int] = []
    for number, text in enumerate(texts_):
        group.append(text.encode("utf-8", "surrogatepass"))
        numbers.append(number)
        if number + 1 < len(texts_) and sum(map(len, group)) < _BLOCK and len(group) < 256:
            continue
        raw = b"\n".join(group)
        starts, stops = word_places(raw)
        begins = np.concatenate([[0], np.cumsum([len(g) + 1 for g in group])[:-1]])
        firsts = np.searchsorted(starts, begins)
        owner = np.repeat(np.arange(len(group)), np.diff(np.append(firsts, len(starts))))
        hashes = word_hashes(raw, starts, stops)
        at, lines, least = winnow(hashes, owner)
        yield np.array(numbers)[owner[at]], owner, firsts, at, lines, hashes, least
        group, numbers = [], []


def _lines(docs: DataFrame) -> DataFrame:
    """The fingerprints of all texts, one row for each place."""

    def run(batches):
        for batch in batches:
            found = [part[4] for part in fingerprints(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64))], names=["line"])

    return texts(docs).select(TEXT).mapInArrow(run, "line bigint")


def _filter(values: DataFrame) -> np.ndarray:
    """Marks of the lines that come more than once, as bytes of eight bits each; their number follows that of the lines."""
    repeated = keep(values.groupBy("line").agg(F.count("*").alias("n")).where("n > 1").select("line"), "repeated")
    least, most = FILTER_BITS
    size = 1 << min(max((SPARE * repeated.count() - 1).bit_length(), least), most)
    place = F.col("line").bitwiseAND(F.lit(size - 1)) + 1
    parts = repeated.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    marks = np.zeros(max(size >> 3, 1 << 12), np.uint8)
    for part, bits in parts.toLocalIterator():
        at = (part - 1) * len(bits)
        marks[at : at + len(bits)] = np.frombuffer(bits, np.uint8)
    discard(repeated)
    return marks[: size >> 3]


def _marked(marks: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = (values & np.uint64(8 * len(marks) - 1)).astype(np.int64)
    return (marks[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _around(hashes: np.ndarray, text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Per place the short hashes of the words before the line, nearest first, then of those after it; 0 is no word."""
    reach = REACH - 1
    short = (hashes & np.uint64(0xFFFF)).astype(np.uint16)
    short[short == 0] = 1
    shifted = np.arange(len(hashes)) + reach * (text + 1)  # room for as many words between texts
    padded = np.zeros(len(hashes) + reach * (int(text[-1]) + 2), np.uint16)
    padded[shifted] = short
    at, step = shifted[places][:, None], np.arange(reach)[None, :]
    return np.concatenate([padded[at - 1 - step], padded[at + GRAM + step]], axis=1)


def _owned(least: np.ndarray, places: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Per place which windows have the line there as their smallest; column k: the one with k words before the line."""
    padded = np.concatenate([np.zeros(REACH - 1, np.uint64), least, np.zeros(REACH - 1, np.uint64)])
    return padded[places[:, None] + (REACH - 1 - np.arange(REACH))] == lines[:, None]


def _windows(hashes: np.ndarray) -> np.ndarray:
    """The hashes of all windows, of the words' whole hashes: the many copies of a passage have many words at its edge."""
    up, down = _powers(len(hashes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
    keys = (sums[LEAST:] - sums[:-LEAST]) * down[: len(hashes) - LEAST + 1]
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return keys ^ (keys >> np.uint64(29))


def _binary(matrix: np.ndarray) -> pa.Array:
    """One binary value per row."""
    width = matrix.shape[1] * matrix.itemsize
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(matrix))])


def _halves(lines: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Per line two hashes: of it with the ``HALF`` words before it, and of it with those after it."""
    made = np.empty((len(lines), 2), np.uint64)
    for side, seed in enumerate((0xA0761D6478BD642F, 0xE7037ED1A0B428DB)):
        value = lines ^ np.uint64(seed)
        for part in np.ascontiguousarray(around[:, side * (REACH - 1) :][:, :HALF]).view(np.uint64).T:
            value = (value ^ part) * np.uint64(0xD6E8FEB86659FD93)
            value ^= value >> np.uint64(32)
        made[:, side] = value
    return made


def _alike(text: np.ndarray, lines: np.ndarray, around: np.ndarray, owned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the same text, line, surroundings and windows taken together.

    The first place of each group, all places by group, and where each group's begin, with the number of all as the last.
    """
    value = lines ^ (text.astype(np.uint64) << np.uint64(32)) ^ owned.astype(np.uint64)
    for part in np.ascontiguousarray(around).view(np.uint64).T:
        value = (value ^ part) * np.uint64(0xD6E8FEB86659FD93)
        value ^= value >> np.uint64(32)
    _, first, group, sizes = np.unique(value, return_index=True, return_inverse=True, return_counts=True)
    by_first = np.argsort(first)
    rank = np.empty_like(by_first)
    rank[by_first] = np.arange(len(first))
    return first[by_first], np.argsort(rank[group], kind="stable"), np.concatenate([[0], np.cumsum(sizes[by_first])])


def _occurrences(docs: DataFrame, marks: np.ndarray) -> DataFrame:
    """The marked fingerprints with their text, surroundings, and all places in the text that have the same ones."""
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    source = texts(docs).select(ID, TEXT, F.xxhash64(TEXT).alias("digest"))
    schema = T.StructType([
        T.StructField("line", T.LongType()), source.schema[ID], source.schema["digest"], T.StructField("places", T.ArrayType(T.IntegerType())),
        T.StructField("around", T.BinaryType()), T.StructField("owned", T.IntegerType()),
    ])

    def run(batches):
        known = shared.value
        for batch in batches:
            rows, lines, places, around = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty((0, 2 * REACH - 2), np.uint16)]
            owned, sizes = [np.empty(0, np.int64)], [np.zeros(1, np.int64)]
            for row, owner, firsts, at, values, hashes, least in fingerprints(batch.column(1).to_pylist()):
                marked = _marked(known, values)
                at, values, row = at[marked], values[marked], row[marked]
                if len(at):
                    beside, own = _around(hashes, owner, at), (_owned(least, at, values) << np.arange(REACH)).sum(axis=1)
                    first, order, begins = _alike(row, values, beside, own)
                    rows.append(row[first])
                    lines.append(values[first])
                    places.append((at - firsts[owner[at]])[order])
                    sizes.append(np.diff(begins))
                    around.append(beside[first])
                    owned.append(own[first])
            taken = pa.array(np.concatenate(rows))
            until = pa.array(np.cumsum(np.concatenate(sizes)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(lines).view(np.int64)), batch.column(0).take(taken), batch.column(2).take(taken),
                    pa.ListArray.from_arrays(until, pa.array(np.concatenate(places).astype(np.int32))),
                    _binary(np.concatenate(around)), pa.array(np.concatenate(owned).astype(np.int32)),
                ],
                names=schema.names,
            )

    return source.mapInArrow(run, schema)


def _merged(start: np.ndarray, stop: np.ndarray, *group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first and the last of the stretches that touch, in stretches of a group in order and of one length."""
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > stop[:-1]
    for part in group:
        new[1:] |= part[1:] != part[:-1]
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(start))[: len(first)] - 1


def _covered(matched: DataFrame) -> DataFrame:
    """What matches cover when they are extended, as one number: the first word, and the one after the last.

    Rows without a text are halves: those of windows that a match does not cover.
    """

    def run(batches):
        for batch in batches:
            first, same = batch.column("first").to_numpy(zero_copy_only=False).astype(np.int64), batch.column("same").to_numpy(zero_copy_only=False).astype(bool)
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(len(first), -1) for c in ("around", "first_around"))
            equal = (a == b) & (a != 0)
            left, right = (np.logical_and.accumulate(part, axis=1).sum(axis=1) for part in (equal[:, : REACH - 1], equal[:, REACH - 1 :]))
            lists = batch.column("places")
            place, row = lists.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(first)), lists.value_lengths().to_numpy())
            later = ~(same[row] & (place == first[row]))
            place, row = place[later], row[later]
            start, stop = place - left[row], place + GRAM + right[row]
            begin, end = _merged(start, stop, row)
            start, stop, of = start[begin], stop[end], row[begin]
            start = np.where(same[of], np.maximum(start, first[of] + GRAM), start)
            some = start < stop
            start, stop, of = start[some], stop[some], of[some]
            before = np.arange(REACH)
            owned = batch.column("owned").to_numpy(zero_copy_only=False)[:, None] >> before & 1 == 1
            # A line that stands twice only has no third place where the same window could stand.
            thrice = batch.column("thrice").to_numpy(zero_copy_only=False).astype(bool)
            uncovered = owned & ((before > left[:, None]) | (REACH - 1 - before > right[:, None])) & thrice[:, None]
            sides = np.stack([uncovered[:, HALF:].any(axis=1), uncovered[:, :HALF].any(axis=1)], axis=1)
            sides = sides * np.minimum(np.bincount(row, minlength=len(first)), 2)[:, None]  # twice is repeated
            halves = np.repeat(_halves(batch.column("line").to_numpy(zero_copy_only=False).view(np.uint64), a).ravel(), sides.ravel()).view(np.int64)
            none = pa.nulls(len(halves), pa.int64())
            taken = pa.chunked_array([pa.array(of), none]).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(ID).take(taken), batch.column("digest").take(taken),
                    pa.chunked_array([pa.array((start << 32) | stop), none]).combine_chunks(),
                    pa.chunked_array([pa.nulls(len(of), pa.int64()), pa.array(halves)]).combine_chunks(),
                ],
                names=[ID, "digest", "cut", "half"],
            )

    schema = T.StructType([matched.schema[ID], matched.schema["digest"], T.StructField("cut", T.LongType()), T.StructField("half", T.LongType())])
    return matched.mapInArrow(run, schema)


def _keyed(docs: DataFrame, marks: np.ndarray, halves: np.ndarray) -> DataFrame:
    """The windows around marked fingerprints with a marked half: their hash, text, and the words that they cover."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(marks), context.broadcast(halves)
    source = texts(docs).select(ID, TEXT, F.xxhash64(TEXT).alias("digest"))
    schema = T.StructType([source.schema[ID], source.schema["digest"], T.StructField("cut", T.LongType()), T.StructField("key", T.LongType())])

    def run(batches):
        known, repeated = (s.value for s in shared)
        for batch in batches:
            rows, cuts, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            number = 0
            for _, owner, firsts, at, values, hashes, least in fingerprints(batch.column(1).to_pylist()):
                marked = _marked(known, values)
                at, values = at[marked], values[marked]
                if len(at):
                    before, after = _marked(repeated, _halves(values, _around(hashes, owner, at))).T
                    one, k = np.nonzero(_owned(least, at, values) & np.where(np.arange(REACH) >= HALF, before[:, None], after[:, None]))
                    begins = np.zeros(len(least), bool)
                    begins[at[one] - k] = True
                    begin = np.flatnonzero(begins)
                    key, text = _windows(hashes)[begin], owner[begin]
                    order = np.lexsort((key, text))
                    key, text, begin = key[order], text[order], begin[order] - firsts[text[order]]
                    first, last = _merged(begin, begin + LEAST, text, key)
                    rows.append(number + text[first])
                    cuts.append((begin[first] << 32) | (begin[last] + LEAST))
                    keys.append(key[first])
                number += len(firsts)
            taken = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(2).take(taken), pa.array(np.concatenate(cuts)), pa.array(np.concatenate(keys).view(np.int64))],
                names=schema.names,
            )

    return source.mapInArrow(run, schema)


def _same(first: str):
    """Whether a row is of the text that its first occurrence is in."""
    return F.col(ID).eqNullSafe(F.col(f"{first}.{ID}")) & (F.col("digest") == F.col(f"{first}.digest"))


def repeated_words(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, cuts): for each text that repeats an earlier one the words that its matches cover."""
    marks = _filter(_lines(docs))
    found = keep(_occurrences(docs, marks), "occurrences")
    order = [F.col(ID).isNull().alias("unnamed"), ID, "digest"]
    # Written, so that the join shuffles both sides for itself and can split a line that very many places share.
    least = F.min(F.struct(*order, F.col("places")[0].alias("place"), "around")).alias("first")
    number = F.sum(F.size("places")).alias("n")
    firsts = keep(found.groupBy("line").agg(least, number).where("n > 1").select("line", "first", (F.col("n") > 2).alias("thrice")), "firsts")
    alone = _same("first") & (F.col("places")[0] == F.col("first.place")) & (F.size("places") == 1)
    matched = found.join(firsts, "line").where(~alone).select(
        "line", ID, "digest", "places", "around", "owned", F.col("first.place").alias("first"), F.col("first.around").alias("first_around"), _same("first").alias("same"), "thrice"
    )
    covered = keep(_covered(matched), "covered")
    discard(found)
    discard(firsts)
    windows = keep(_keyed(docs, marks, _filter(covered.where("half is not null").select(F.col("half").alias("line")))), "windows")
    start, stop = F.shiftright("cut", 32), F.col("cut").bitwiseAND(F.lit(0xFFFFFFFF))
    least = F.min(F.struct(*order, start.alias("start"))).alias("first")
    words = F.sum(stop - start).alias("words")
    heads = keep(windows.groupBy("key").agg(least, words).where(F.col("words") > LEAST).select("key", "first"), "heads")
    after = F.greatest(start, F.when(_same("first"), F.col("first.start") + LEAST))
    later = windows.join(heads, "key").select(ID, "digest", after.alias("start"), stop.alias("stop")).where("start < stop")
    stretches = covered.where("half is null").select(ID, "digest", "cut").union(
        later.select(ID, "digest", F.shiftleft("start", 32).bitwiseOR(F.col("stop")))
    )
    cuts = keep(stretches.groupBy(ID, "digest").agg(F.collect_set("cut").alias("cuts")), "cuts")
    discard(covered)
    discard(windows)
    discard(heads)
    return cuts


def cut(text: str, cuts: list[int]) -> tuple[str, int, int, list[tuple[int, int]]]:
    """The text without its repeated runs, the words it had, those deleted, and the deleted spans in code points."""
    raw = text.encode("utf-8", "surrogatepass")
    words = word_places(raw)[0].tolist()
    ends = [*words[1:], len(raw)]
    runs: list[list[int]] = []
    for start, stop in sorted((c >> 32, c & 0xFFFFFFFF) for c in cuts):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([start, stop])
    left, removed, spans, at, point = [], 0, [], 0, 0
    for start, stop in runs:
        stop = min(stop, len(words))
        if stop - start < LEAST:
            continue
        first, last = words[start], ends[stop - 1]
        before = raw[at:first].decode("utf-8", "surrogatepass")
        gone = raw[first:last].decode("utf-8", "surrogatepass")
        left.append(before)
        spans.append((point + len(before), point + len(before) + len(gone)))
        removed, at, point = removed + stop - start, last, spans[-1][1]
    left.append(raw[at:].decode("utf-8", "surrogatepass"))
    return "".join(left), len(words), removed, spans


def _cut_rows(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with what is to be cut from each text."""
    cuts = repeated_words(docs).withColumnsRenamed({ID: "__id", "digest": "__digest", "cuts": "__cuts"})
    digest = F.xxhash64(F.coalesce(docs[TEXT], F.lit("")))
    return docs.join(cuts, docs[ID].eqNullSafe(cuts["__id"]) & (digest == cuts["__digest"]), "left").drop("__id", "__digest")


def line_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: the text that is left, words, deleted words, and deleted spans (start:end, comma-joined).

    Null texts count as empty. Texts of fewer than ``LEAST`` words stay as they are. Rows that are equal in id and text
    are one document, so both stay; rows of one id with different texts come in the order of the text's hash, rows
    without an id after all others. Other columns are not read.
    """
    rows = _cut_rows(texts(docs))
    schema = T.StructType([
        rows.schema[ID], T.StructField(TEXT, T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("removed_words", T.LongType()), T.StructField("removed_spans", T.StringType()),
    ])

    def run(batches):
        for batch in batches:
            made = [cut(t, c) if c else (t, len(word_places(t.encode("utf-8", "surrogatepass"))[0]), 0, []) for t, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64()),
                    pa.array([m[2] for m in made], pa.int64()), pa.array([",".join(f"{a}:{b}" for a, b in m[3]) for m in made], pa.string()),
                ],
                names=schema.names,
            )

    return rows.select(ID, TEXT, "__cuts").mapInArrow(run, schema)


def drop_repeats(docs: DataFrame, chars: str = "n_chars") -> DataFrame:
    """The documents with all their columns and without repeated runs; those of which no word is left go.

    A column of text lengths, where there is one, follows the new text. Documents without words before stay.
    """
    rows, names = _cut_rows(docs), docs.columns
    text, counted = names.index(TEXT), names.index(chars) if chars in names else None

    def run(batches):
        for batch in batches:
            made = [(cut(t, c)[0] if c else t, bool(c)) for t, c in zip(batch.column(text).to_pylist(), batch.column(len(names)).to_pylist())]
            columns = [batch.column(k) for k in range(len(names))]
            columns[text] = pa.array([m[0] for m in made], pa.string())
            if counted is not None:
                old = columns[counted].to_pylist()
                columns[counted] = pa.array([len(m[0]) if m[1] else n for m, n in zip(made, old)], columns[counted].type)
            stay = pa.array([not m[1] or bool(m[0].encode("utf-8", "surrogatepass").split()) for m in made], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(stay)

    return rows.select(*names, "__cuts").mapInArrow(run, docs.schema)
