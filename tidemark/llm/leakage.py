"""Evaluation texts leaking into training text.

Items and documents that share a run of ``min_words`` consecutive words share
one of the item's pieces: the item cut at every ``piece``-th word into pieces of
``piece = (min_words + 1) // 2`` words, one of which lies whole inside any such
run. One Aho-Corasick automaton over the pieces of all items, with words as its
letters, scans every normalised document once; each hit is then extended word
by word on both sides, which decides exactly.

The automaton is as large as the items, not their runs: flat arrays of about 28
bytes a word. It is built by levels in numpy from the items' words, which Spark
normalises, written once to the shared folder, shipped as a file and mapped, so
the workers of a machine share one copy and there is one scan whatever the
number of items. Documents are never shuffled or collected. Matches name their
place in the original text.

A worker steps the automaton over many stretches of its batch at once, each
starting ``piece - 1`` words early, so long texts cost what short ones do.

Defined cases: null or empty texts and items of fewer words match nothing;
repeated items match each on its own; words are maximal runs of Unicode
letters and digits in lower case, with U+00AD and U+200B removed first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import share_file

MIN_WORDS = 13
IGNORED = "\u00ad\u200b"
#: Words of a stretch, and of what a worker handles at once unless one text is longer.
STRETCH = 512
PORTION = 1 << 20
#: Hits verified at once.
HITS = 1 << 20
_IGNORED = str.maketrans("", "", IGNORED)
_RUN = re.compile(r"[^\W_]+")
_WORD = re.compile(rf"[^\W_](?:[{IGNORED}]*[^\W_])*")


def words(text: str) -> list[str]:
    """Words in lower case."""
    if IGNORED[0] in text or IGNORED[1] in text:
        text = text.translate(_IGNORED)
    # lower() follows the split: some lower-case forms hold a separating mark
    return " ".join(_RUN.findall(text)).lower().split()


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([words(t.as_py()) for t in batch.column(1)], pa.list_(pa.string()))], ["item_id", "words"])


class Automaton:
    """Aho-Corasick automaton over pieces of equal length, as flat arrays.

    Node 0 is the root; node n > 0 is reached by ``keys[n - 1]``, parent << 32 |
    word. Nodes are numbered by level, so ``keys`` is sorted and the last
    level's nodes, from ``leaf`` on, are the pieces.
    """

    def __init__(self, parts: list[np.ndarray]) -> None:
        head, self.keys, self.fail, self.first, self.place, self.cut, self.flat, self.starts, self.ids, vocabulary = parts
        self.piece, self.leaf, size = int(head[0]), int(head[1]), int(head[2])
        names = vocabulary.view(np.uint8)[:size].tobytes().decode("utf-8", "surrogatepass").split(" ")
        self.number = {w: i for i, w in enumerate(names)}

    @staticmethod
    def build(ids: np.ndarray, lengths: np.ndarray, numbers: np.ndarray, vocabulary: list[str], min_words: int) -> list[np.ndarray]:
        """``numbers`` holds the word numbers of all items one after another."""
        piece = (min_words + 1) // 2
        ends = np.cumsum(lengths)
        # items lie in ``flat`` with a separator around each
        starts = ends - lengths + np.arange(len(lengths)) + 1
        flat = np.full(int(lengths.sum()) + len(lengths) + 1, -2, np.int64)
        flat[np.arange(len(numbers)) + np.repeat(np.arange(len(lengths)), lengths) + 1] = numbers
        each = np.where(lengths >= min_words, lengths // piece, 0)
        number = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
        place = np.repeat(starts, each) + piece * number
        node, keys, fail, size, leaf = np.zeros(len(place), np.int64), np.empty(0, np.int64), np.zeros(1, np.int64), 1, 1
        first = np.zeros(len(vocabulary) + 1, np.int64)  # the last entry is that of unknown words
        for depth in range(piece):
            level, back = np.unique(node << 32 | flat[place + depth], return_inverse=True)
            keys = np.concatenate([keys, level])
            if depth:
                to = step(keys, fail, first, fail[level >> 32], level & 0xFFFFFFFF)
            else:
                first[level], to = np.arange(len(level)) + 1, np.zeros(len(level), np.int64)
            fail, leaf, node = np.concatenate([fail, to]), size, back + size
            size += len(level)
        order = np.argsort(node, kind="stable")
        cut = np.searchsorted(node[order], np.arange(leaf, size + 1))
        text = " ".join(vocabulary).encode("utf-8", "surrogatepass")
        head = np.array([piece, leaf, len(text)], np.int64)
        return [head, keys, fail, first, place[order], cut, flat, starts, ids.astype(np.int64), np.frombuffer(text + b" " * (-len(text) % 8), np.int64)]

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the last word, node) of every piece in a sequence of word numbers; -1 is an unknown word."""
        early, n = self.piece - 1, len(numbers)
        lanes = -(-n // STRETCH)
        padded = np.full(early + lanes * STRETCH, -1, np.int64)
        padded[early : early + n] = numbers
        state, at, found = np.zeros(lanes, np.int64), np.arange(lanes) * STRETCH, []
        for i in range(STRETCH + early):
            w = padded[at + i]
            new = self.first[w]
            deep = np.flatnonzero((state > 0) & (w >= 0))
            if len(deep):
                new[deep] = step(self.keys, self.fail, self.first, state[deep], w[deep])
            state = new
            if i >= early and len(hit := np.flatnonzero(state >= self.leaf)):
                found.append((at[hit] + (i - early), state[hit]))
        if not found:
            return at[:0], at[:0]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def step(keys: np.ndarray, fail: np.ndarray, first: np.ndarray, state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Next node of each state on its word, along the failure links."""
    out = first[word]
    todo = np.flatnonzero(state > 0)
    s = state[todo]
    while len(todo):
        key = s << 32 | word[todo]
        at = np.searchsorted(keys, key)
        hit = keys[np.minimum(at, len(keys) - 1)] == key
        out[todo[hit]] = at[hit] + 1
        s = fail[s[~hit]]
        todo = todo[~hit][s > 0]
        s = s[s > 0]
    return out


def pack(parts: list[np.ndarray]) -> bytes:
    return np.concatenate([np.array([len(parts), *map(len, parts)], np.int64), *parts]).tobytes()


def unpack(path: str) -> list[np.ndarray]:
    whole = np.memmap(path, np.int64, "r")
    n = int(whole[0])
    ends = n + 1 + np.cumsum(whole[1 : n + 1])
    return [whole[e - k : e] for e, k in zip(ends, whole[1 : n + 1])]


_LOADED: dict[str, Automaton] = {}


def _automaton(name: str) -> Automaton:
    """Mapped once for each worker."""
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = Automaton(unpack(SparkFiles.get(name)))
    return _LOADED[name]


def _extended(a: Automaton, numbers: np.ndarray, at: np.ndarray, place: np.ndarray, way: int, most: int) -> np.ndarray:
    """How many further words agree before (way -1) or after (way 1) each pair of places."""
    out, live, i = np.zeros(len(at), np.int64), np.arange(len(at)), 1
    while len(live) and i <= most:
        live = live[numbers[at[live] + way * i] == a.flat[place[live] + way * i]]
        out[live] = i
        i += 1
    return out


def _runs(a: Automaton, numbers: np.ndarray, min_words: int, whole: bool) -> np.ndarray:
    """Rows (item number, first word's place, words) of every run; ``numbers`` ends in -1. Short of ``whole`` runs are cut."""
    end, node = a.hits(numbers)
    n = a.cut[node - a.leaf + 1] - a.cut[node - a.leaf]
    out, most = [np.empty((3, 0), np.int64)], 1 << 62 if whole else min_words - a.piece
    for lo in range(0, int(n.sum()), HITS):
        number = np.arange(lo, min(lo + HITS, int(n.sum())))
        own = np.searchsorted(np.cumsum(n), number, side="right")
        place = a.place[a.cut[node[own] - a.leaf] + number - (np.cumsum(n) - n)[own]]
        last = end[own]
        left = _extended(a, numbers, last - a.piece + 1, place, -1, most)
        right = _extended(a, numbers, last, place + a.piece - 1, 1, most)
        long_ = left + right + a.piece >= min_words
        item = np.searchsorted(a.starts, place[long_], side="right") - 1
        out.append(np.unique(np.stack([item, (last - a.piece + 1 - left)[long_], (left + right + a.piece)[long_], (last - place)[long_]]), axis=1)[:3])
    return np.concatenate(out, axis=1)


def _portions(rows: list[list[int]]) -> Iterator[tuple[int, int]]:
    lo, used = 0, 0
    for i, r in enumerate(rows):
        if used and used + len(r) > PORTION:
            yield lo, i
            lo, used = i, 0
        used += len(r) + 1
    if rows:
        yield lo, len(rows)


def _scan(name: str, min_words: int, spans: bool):
    names = ["item_id", "doc_id", "start", "end", "n_words"][: 5 if spans else 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _automaton(name)
        get = a.number.get
        for batch in batches:
            docs, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            numbered = [[get(w, -1) for w in words(t)] for t in texts]
            for lo, hi in _portions(numbered):
                begin = np.cumsum([1, *[len(r) + 1 for r in numbered[lo:hi]]])
                flat = np.full(int(begin[-1]), -1, np.int64)
                for at, r in zip(begin, numbered[lo:hi]):
                    flat[at : at + len(r)] = r
                item, first, n = _runs(a, flat, min_words, spans)
                own = np.searchsorted(begin, first, side="right") - 1
                if not spans:
                    pairs = np.unique(np.stack([a.ids[item], docs[lo + own]]), axis=1) if len(item) else np.empty((2, 0), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in pairs], names)
                    continue
                rows, at, seen = [], [], -1
                for i, d, f, k in sorted({(int(i), int(o), int(f - begin[o]), int(k)) for i, o, f, k in zip(item, own, first, n)}, key=lambda x: x[1]):
                    if d != seen:
                        at, seen = [m.span() for m in _WORD.finditer(texts[lo + d])], d
                    rows.append((int(a.ids[i]), int(docs[lo + d]), at[f][0], at[f + k - 1][1], k))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)], names)

    return run


def leaked_items(items: DataFrame, documents: DataFrame, *, min_words: int = MIN_WORDS, spans: bool = False) -> DataFrame:
    """(item_id, doc_id) of every document that holds a run of an item.

    With ``spans`` one row per maximal run and its place in the item, with its
    place [start, end) in code points of the original text and its number of
    words; runs of one item at the same place of a document are one row.
    """
    spark = documents.sparkSession
    schema = "item_id long, doc_id long" + (", start long, end long, n_words long" if spans else "")
    texts = documents.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    asked = items.select(F.col("item_id").cast("long"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    got = asked.mapInArrow(_item_words, "item_id long, words array<string>").toArrow().combine_chunks()
    lists = got.column("words").combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.string()))
    coded = lists.flatten().dictionary_encode()
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.empty(0, np.int64)
    if not (lengths >= min_words).any():
        return spark.createDataFrame([], schema)
    parts = Automaton.build(got.column("item_id").to_numpy(), lengths.astype(np.int64), coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist(), min_words)
    return texts.mapInArrow(_scan(share_file(spark, "automaton", pack(parts)), min_words, spans), schema)
