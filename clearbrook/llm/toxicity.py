"""Toxicity by averaged subword embeddings.

A word is the bag of its character n-grams and itself, hashed into a table of embeddings; a window of consecutive words
is the average of their subwords' embeddings, and a linear softmax over two classes reads it. Embeddings and softmax
are trained together, so that a spelling never seen shares the vectors of the n-grams that it has in common with seen
ones. A text is as toxic as its most toxic window: in training, too, only the window that scores highest is a text's
example, since a few insults in a long text are what its label is about.

The model is fitted on a bounded sample of the labelled texts. All texts are scored, whole. As average and softmax are
linear, a word's part of its window's score is one number, which a worker remembers.
"""

from __future__ import annotations

import re
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbrook.llm.common import ID, TEXT, texts

#: Labelled texts that the model is fitted on at most, and windows of each of them at most (spread over the text).
SAMPLE, SAMPLE_WINDOWS = 6000, 48
#: Words of a window, and words between the beginnings of two.
WINDOW, STEP = 10, 5
#: Lengths of the character n-grams; rows and columns of the embedding table.
GRAMS, ROWS, WIDTH = (3, 4, 5), 1 << 17, 8
#: Turns over the sample; those of the first kind take a text's every window as its example.
WARM, TURNS, BATCH_TEXTS, RATE = 1, 14, 64, 2.0
#: Share of a word's subwords that a step of the training looks at.
KEPT = 0.4
#: Every so many texts are held out of training, by the checksum of their id.
FOLDS = 5
#: Words remembered by a worker; beyond that it forgets them all and begins anew.
REMEMBERED = 300_000
#: Texts scored together, whose new words are looked up at once.
TOGETHER = 64

_WORD = re.compile(r"\w+|[^\w\s]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def subwords(word: str) -> list[int]:
    """Rows of the table for the n-grams of a word with its ends marked, and for the whole of it."""
    marked = f"<{word}>"
    grams = {marked[k : k + n] for n in GRAMS for k in range(len(marked) - n + 1)} | {marked}
    return sorted(zlib.crc32(g.encode("utf-8", "surrogatepass")) % ROWS for g in grams)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def bag_sums(words: list[str], parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the sum of ``parts`` over its :func:`subwords`, and their number; words of ASCII all at once."""
    totals, counts = np.zeros(len(words)), np.zeros(len(words))
    plain = np.array([word.isascii() for word in words], bool)
    for at in np.flatnonzero(~plain):
        rows = subwords(words[at])
        totals[at], counts[at] = parts[rows].sum(dtype=np.float64), len(rows)
    places = np.flatnonzero(plain)
    if not len(places):
        return totals, counts
    marked = [f"<{words[at]}>".encode() for at in places]
    sizes = np.array([len(m) for m in marked])
    raw = np.frombuffer(b"".join(marked) + bytes(max(GRAMS)), np.uint8)
    total = int(sizes.sum())
    owner = np.repeat(np.arange(len(marked)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(total)  # bytes to the end of the word
    state, key = np.full(total, 0xFFFFFFFF, np.uint32), np.zeros(total, np.int64)
    owners, rows, keys = [], [], []
    for n in range(1, max(GRAMS) + 1):
        byte = raw[n - 1 : n - 1 + total]
        state = _CRC[(state ^ byte) & 255] ^ (state >> 8)
        key = key | byte.astype(np.int64) << 8 * (n - 1)
        if n in GRAMS:
            inside = np.flatnonzero(left >= n)
            owners.append(owner[inside])
            rows.append((~state[inside]) % ROWS)
            keys.append(key[inside] | n << 40)
    longer = np.flatnonzero(sizes > max(GRAMS))  # others are one of their own n-grams
    owners.append(longer)
    rows.append(np.array([zlib.crc32(marked[at]) % ROWS for at in longer], np.uint32))
    keys.append(np.full(len(longer), -1, np.int64))
    owners, rows, keys = np.concatenate(owners), np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((keys, owners))
    owners, rows, keys = owners[order], rows[order], keys[order]
    first = np.concatenate([[True], (owners[1:] != owners[:-1]) | (keys[1:] != keys[:-1])])
    owners, rows = owners[first], rows[first]
    totals[places] = np.bincount(owners, parts[rows].astype(np.float64), len(marked))
    counts[places] = np.bincount(owners, minlength=len(marked))
    return totals, counts


def window_starts(words: int) -> np.ndarray:
    """First words of the windows; the last one ends with the text."""
    starts = np.arange(0, max(1, words - WINDOW + STEP), STEP)
    return np.minimum(starts, max(0, words - WINDOW))


class Model:
    """Embeddings and the difference of the two classes' softmax weights, with the prior where there is no word."""

    def __init__(self, prior: float, table: np.ndarray | None = None, weights: np.ndarray | None = None, offset: float = 0.0) -> None:
        self.prior, self.offset = prior, offset
        #: What each subword adds to a window's score, before the average.
        self.parts = None if table is None else (table @ weights).astype(np.float32)
        #: Places of the words seen in the arrays of their sums and of their subwords' numbers.
        self.known: dict[str, int] = {}
        self.totals = self.counts = np.empty(0)

    def __getstate__(self):
        return {**self.__dict__, "known": {}, "totals": np.empty(0), "counts": np.empty(0)}

    def _learn(self, batch: list[list[str]]) -> None:
        """Sums of all words of the texts; what was known before goes when it becomes too much."""
        new = [w for w in dict.fromkeys(chain.from_iterable(batch)) if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(dict.fromkeys(chain.from_iterable(batch)))
        at = len(self.known)
        if at + len(new) > len(self.totals):
            size = max(REMEMBERED, len(new))
            self.totals, self.counts = (np.concatenate([a[:at], np.empty(size - at)]) for a in (self.totals, self.counts))
        self.totals[at : at + len(new)], self.counts[at : at + len(new)] = bag_sums(new, self.parts)
        self.known.update(zip(new, range(at, at + len(new))))

    def _highest(self, words: list[str]) -> float:
        if not words:
            return self.prior
        places = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        sums, counts = (np.concatenate([[0.0], np.cumsum(a[places])]) for a in (self.totals, self.counts))
        starts = window_starts(len(words))
        ends = np.minimum(starts + WINDOW, len(words))
        highest = float(((sums[ends] - sums[starts]) / (counts[ends] - counts[starts])).max()) + self.offset
        return float(1 / (1 + np.exp(-np.clip(highest, -500, 500))))

    def scores(self, texts: list[str | None]) -> list[float]:
        """From 0 to 1 each; the prior for a text without words."""
        if self.parts is None:
            return [self.prior] * len(texts)
        batch = [words_of(text) for text in texts]
        self._learn(batch)
        return [self._highest(words) for words in batch]

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]


def fit(samples: list[tuple[list[str], int]], seed: int = 7) -> Model:
    """Train on texts given as their windows (words with spaces between), each with its label (0 or 1)."""
    samples = [(w, y) for w, y in samples if w]
    labels = np.array([y for _, y in samples], np.float32)
    prior = float(labels.mean()) if len(labels) else 0.0
    if not 0 < prior < 1:
        return Model(prior)
    vocabulary: dict[str, int] = {}
    numbers, lengths, flat_rows, bag_lengths = array("i"), array("i"), array("i"), array("i")
    for windows, _ in samples:
        for window in windows:
            words = window.split(" ")
            numbers.extend([vocabulary.setdefault(w, len(vocabulary)) for w in words])
            lengths.append(len(words))
    for word in vocabulary:
        rows = subwords(word)
        flat_rows.extend(rows)
        bag_lengths.append(len(rows))
    tokens, flat, bag_sizes = (np.frombuffer(a, np.int32) for a in (numbers, flat_rows, bag_lengths))
    bag_ends = np.cumsum(bag_sizes, dtype=np.int64)
    owner = np.repeat(np.arange(len(samples)), [len(windows) for windows, _ in samples])
    ends = np.cumsum(np.frombuffer(lengths, np.int32), dtype=np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    weight = np.where(labels == 1, 0.5 / prior, 0.5 / (1 - prior)) ** 0.5

    chance = np.random.default_rng(seed)
    table = chance.uniform(-1 / WIDTH, 1 / WIDTH, (ROWS, WIDTH)).astype(np.float32)
    weights, offset = np.zeros(WIDTH, np.float32), np.float32(0)
    seen_table, seen_weights, seen_offset = np.full(ROWS, 1e-4, np.float32), np.float32(1e-4), np.float32(1e-4)
    weights += chance.normal(0, 0.1, WIDTH).astype(np.float32)

    def window_scores() -> np.ndarray:
        parts = table @ weights
        per_word = np.add.reduceat(parts[flat], bag_ends - bag_sizes)
        sums = np.concatenate([np.zeros((1, 2)), np.cumsum(np.stack([per_word[tokens], bag_sizes[tokens]], axis=1), axis=0)])
        within = sums[ends] - sums[begins]
        return within[:, 0] / within[:, 1] + offset

    for turn in range(TURNS):
        scores = window_scores()
        if turn < WARM:
            chosen = np.arange(len(owner))
        else:  # the highest window of each text
            order = np.lexsort((-scores, owner))
            chosen = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]
        chosen = chance.permutation(chosen)
        rate = RATE * (1 - turn / TURNS)
        for at in range(0, len(chosen), BATCH_TEXTS):
            part = chosen[at : at + BATCH_TEXTS]
            words = np.concatenate([tokens[begins[w] : ends[w]] for w in part])
            row_counts = bag_sizes[words]
            rows = flat[np.repeat(bag_ends[words] - bag_sizes[words], row_counts) + np.arange(row_counts.sum()) - np.repeat(np.cumsum(row_counts) - row_counts, row_counts)]
            per_window = np.add.reduceat(row_counts, np.concatenate([[0], np.cumsum(ends[part] - begins[part])[:-1]]))
            # A word is learned from some of its subwords at a time, as those are what a new spelling has in common with it.
            left = chance.random(len(rows), np.float32) < KEPT
            left[np.concatenate([[0], np.cumsum(per_window)[:-1]])] = True
            window = np.repeat(np.arange(len(part)), per_window)[left]
            rows, per_window = rows[left], np.bincount(window, minlength=len(part))
            firsts = np.concatenate([[0], np.cumsum(per_window)[:-1]])
            mean = np.add.reduceat(table[rows], firsts, axis=0) / per_window[:, None]
            logit = mean @ weights + offset
            error = ((1 / (1 + np.exp(-logit)) - labels[owner[part]]) * weight[owner[part]]).astype(np.float32)
            grad_weights, grad_offset = (error[:, None] * mean).mean(axis=0), error.mean()
            touched, place = np.unique(rows, return_inverse=True)
            amount = np.bincount(place, np.repeat(error / per_window, per_window), len(touched)).astype(np.float32)
            gradient = amount[:, None] * weights
            seen_table[touched] += (gradient**2).mean(axis=1)
            table[touched] -= rate * 0.2 * gradient / np.sqrt(seen_table[touched])[:, None]
            seen_weights += (grad_weights**2).mean()
            seen_offset += grad_offset**2
            weights -= rate * 0.2 * grad_weights / np.sqrt(seen_weights)
            offset -= rate * 0.2 * grad_offset / np.sqrt(seen_offset)
    return Model(prior, table, weights, float(offset))


def held_out(ids) -> F.Column:
    """Whether a row is held out of training; a null id counts as an empty text."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def sampled_labels(docs: DataFrame, labels: DataFrame, label: str = "toxic", size: int = SAMPLE) -> DataFrame:
    """At most ``size`` ids to learn from, with their label: those with the smallest hashes of their ids.

    One label for each id, the more frequent one (1 when both are). Ids alone are read and shuffled, no texts.
    """
    known = labels.where(labels[label].isNotNull() & labels[ID].isNotNull()).groupBy(labels[ID].alias("id")).agg(
        (F.avg(labels[label].cast("double")) >= 0.5).cast("int").alias("label")
    )
    present = known.join(docs.select(docs[ID].alias("id")), "id", "left_semi").where(~held_out(F.col("id")))
    return present.select(F.xxhash64("id").alias("at"), "id", "label").orderBy("at", "id").limit(size)


def sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", size: int = SAMPLE, windows: int = SAMPLE_WINDOWS) -> list[tuple[list[str], int]]:
    """At most ``size`` labelled texts, as at most ``windows`` windows of each.

    That is what goes to the driver: its bound is the product of the two parameters and a window's words. The ids, which
    have the first bound alone, are sent to the texts, so texts are not shuffled.
    """
    source, chosen = texts(docs), sampled_labels(docs, labels, label, size)
    rows = source.join(F.broadcast(chosen), source[ID] == chosen["id"]).select("at", ID, "label", TEXT)
    schema = T.StructType([*[rows.schema[c] for c in ("at", ID, "label")], T.StructField("windows", T.ArrayType(T.StringType()))])

    def run(batches):
        for batch in batches:
            made = []
            for text in batch.column(3):
                words = words_of(text.as_py())
                starts = window_starts(len(words)) if words else np.empty(0, np.int64)
                if len(starts) > windows:
                    starts = starts[np.linspace(0, len(starts) - 1, windows).astype(int)]
                made.append([" ".join(words[s : s + WINDOW]) for s in starts])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(made, pa.list_(pa.string()))], names=schema.names)

    # An id may stand in more than one row; the rows are bounded once more.
    found = rows.mapInArrow(run, schema).orderBy("at", ID, "windows").limit(size).collect()
    return [(r["windows"], r["label"]) for r in found]


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", size: int = SAMPLE) -> DataFrame:
    """One row per document: whether it is held out, its score from 0 to 1, and 1 where that is at least one half.

    Nothing but the text goes into a score. Null and empty texts, and those of white space only, get the share of toxic
    texts in the sample; so does every text where the sample has texts of one kind only, and 0 where it is empty. Rows
    that are equal are scored alike; null ids stay, are held out, and have no labels. Other columns are not read.
    """
    model = fit(sample(docs, labels, label, size))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = texts(docs).select(ID, held_out(docs[ID]).alias("held_out"), TEXT)
    schema = T.StructType([source.schema[ID], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        scorer = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                scores = pa.array(scorer.scores(part.column(2).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), scores], names=schema.names)

    return source.mapInArrow(run, schema).select(ID, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
