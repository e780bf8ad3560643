"""Benchmark decontamination: passages query a BM25 inverted index of test items by block-max WAND.

Each passage (a window of words, half overlapping, twice the longest item) is
a query.  An item's BM25 score is taken as a share of the item's score for its
own text, so one threshold serves items of any length; every item above it is
retrieved.  Posting lists are cut into blocks of neighbouring items, the same
for all terms; a block whose terms' maxima cannot add up to the threshold is
passed over, in the others WAND moves the lists from pivot to pivot.  A
retrieved item counts if the passage also holds 0.8 or more of the five-word
shingles of its question (all but its last sentence) and of its answer (its
last sentence; an item of one sentence is both).  A part of fewer than five
words is a run of its own length; where the item has another part, the answer
must then begin within five words after words of the question.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

K1, B = 1.2, 0.75
#: Share of an item's own score from which it is retrieved; shingle share from which it counts.
THRESHOLD, OVERLAP, SHINGLE = 0.6, 0.8, 5
#: Items of a block at least, and blocks at most; items of an index sent to the tasks (more items are more indexes,
#: asked in turn).
BLOCK_ITEMS, BLOCKS, INDEX_ITEMS = 8, 256, 20_000

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_END = 1 << 60


def words(text: bytes) -> list[bytes]:
    """ASCII letters folded to lower case, ASCII punctuation read as space."""
    return text.translate(_FOLD).split()


def runs(ws: list[bytes], n: int) -> list[tuple]:
    """All runs of n words, by place."""
    return list(zip(*(ws[k:] for k in range(n))))


def shingles(ws: list[bytes]) -> frozenset:
    """Runs of up to five words: parts of items may be shorter than five."""
    return frozenset(r for n in range(1, SHINGLE + 1) for r in runs(ws, n))


def part(ws: list[bytes]) -> frozenset:
    """The shingles of an item's part: five words each, or the whole part if it has fewer."""
    return frozenset(runs(ws, min(SHINGLE, len(ws)))) if ws else frozenset()


def adjoin(ws: list[bytes], question: frozenset, answer: frozenset) -> bool:
    """Whether a shingle of the answer begins within ``SHINGLE`` words after one of the question."""
    n, m = (len(next(iter(x))) for x in (question, answer))
    ends = [k + n for k, r in enumerate(runs(ws, n)) if r in question]
    starts = [k for k, r in enumerate(runs(ws, m)) if r in answer]
    return any((k := bisect.bisect_left(starts, e)) < len(starts) and starts[k] <= e + SHINGLE for e in ends)


class Index:
    """Inverted index of up to ``INDEX_ITEMS`` items with block maxima."""

    def __init__(self, texts: list[bytes]):
        docs = [words(t) for t in texts]
        self.size = max([len(d) for d in docs], default=0) or 1
        self.name = hash(tuple(texts))
        self.parts, self.short = [], []
        for t, d in zip(texts, docs):
            sentences = [s for s in map(words, re.split(rb"(?<=[.!?])\s+", t)) if s]
            question = [w for s in sentences[:-1] for w in s]
            self.parts.append((part(question or d), part(sentences[-1] if question else d)))
            self.short.append(bool(question) and min(len(question), len(sentences[-1])) < SHINGLE)
        df = Counter(w for d in docs for w in set(d))
        mean = sum(map(len, docs)) / max(1, len(docs)) or 1
        found: dict[bytes, list] = {}
        for i, d in enumerate(docs):
            weight = {w: math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * tf * (K1 + 1)
                      / (tf + K1 * (1 - B + B * len(d) / mean)) for w, tf in Counter(d).items()}
            own = sum(weight.values())
            for w, x in weight.items():
                found.setdefault(w, []).append((i, x / own))
        self.term = {w: k for k, w in enumerate(found)}
        self.block_items = max(BLOCK_ITEMS, -(-len(docs) // BLOCKS))
        self.blocks = -(-len(docs) // self.block_items)
        #: Per term and block with postings of it: the block, the largest weight, and the postings (item, weight).
        self.start, self.block, self.most, self.postings = [0], [], [], []
        for p in found.values():
            cut: dict[int, list] = {}
            for i, x in p:
                cut.setdefault(i // self.block_items, []).append((i, x))
            for k, own in cut.items():
                self.block.append(k), self.most.append(max(x for _, x in own)), self.postings.append(own)
            self.start.append(len(self.block))
        self.start, self.block = np.array(self.start, np.int64), np.array(self.block, np.int64)
        self.most = np.array(self.most, np.float64)
        #: Per term: its postings and their largest weight by block.
        self.lists = [{int(self.block[k]): (self.postings[k], float(self.most[k])) for k in range(a, b)}
                      for a, b in zip(self.start[:-1].tolist(), self.start[1:].tolist())]

    def retrieve(self, terms: list[int], block: int, threshold: float) -> dict[int, float]:
        """All items of a block whose score for the distinct ``terms`` reaches ``threshold``: WAND with the block's maxima."""
        held, found = [x for t in terms if (x := self.lists[t].get(block))], {}
        if sum(most for _, most in held) < threshold:
            return found
        lists, bound = [p for p, _ in held], [most for _, most in held]
        at, now = [0] * len(lists), [p[0][0] for p in lists]
        order = list(range(len(lists)))

        def advance(k: int, item: int) -> None:
            at[k] = bisect.bisect_left(lists[k], (item,), at[k])
            now[k] = lists[k][at[k]][0] if at[k] < len(lists[k]) else _END

        while True:
            order.sort(key=now.__getitem__)
            total, pivot = 0.0, -1
            for p, k in enumerate(order):
                if now[k] == _END:
                    break
                total += bound[k]
                if total >= threshold:
                    pivot = p
                    break
            if pivot < 0:
                return found
            item = now[order[pivot]]
            while pivot + 1 < len(order) and now[order[pivot + 1]] == item:
                pivot += 1
            if now[order[0]] == item:
                score = sum(lists[k][at[k]][1] for k in order[:pivot + 1])
                if score >= threshold:
                    found[item] = score
                item += 1
            for k in order[:pivot + 1]:
                advance(k, item)

    def bounds(self, cells: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """Upper bounds (cells x blocks): the terms' block maxima summed over each cell's distinct terms."""
        width = self.start[terms + 1] - self.start[terms]
        first = np.cumsum(width) - width
        at = np.arange(int(width.sum())) + np.repeat(self.start[terms] - first, width)
        keys = np.repeat(cells * self.blocks, width) + self.block[at]
        return np.bincount(keys, self.most[at], n * self.blocks).reshape(n, self.blocks)

    def matches(self, texts: list[bytes], threshold: float, overlap: float) -> list[tuple]:
        """(row, item, score, question share, answer share), the best passage for each row and item."""
        if not self.term:
            return []
        term, size, found = self.term, self.size, {}
        rows = [words(t) for t in texts]
        counts = np.array([-(-len(ws) // size) for ws in rows], np.int64)  # cells of a row; a passage is two of them
        first = np.concatenate([[0], np.cumsum(counts)])
        ids = np.array([term.get(w, -1) for ws in rows for w in ws], np.int64)
        lengths = np.array([len(ws) for ws in rows], np.int64)
        place = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        cell = np.repeat(first[:-1], lengths) + place // size
        known = ids >= 0
        held = np.unique(cell[known] * len(term) + ids[known])
        cell, ids, n = held // len(term), held % len(term), int(first[-1])
        most = self.bounds(cell, ids, n)
        last = np.zeros(n, bool)
        last[first[1:][counts > 0] - 1] = True
        follows = np.flatnonzero(~last)
        both = most.copy()
        both[follows] += most[follows + 1]  # a term in both cells counts twice: still a bound
        starts = np.searchsorted(cell, np.arange(n + 2))
        for c in np.flatnonzero((both >= threshold).any(1)).tolist():
            terms = np.unique(ids[starts[c]:starts[c + 1 if last[c] else c + 2]]).tolist()
            got = {}
            for block in np.flatnonzero(both[c] >= threshold).tolist():
                got |= self.retrieve(terms, block, threshold)
            if got:
                row = int(np.searchsorted(first, c, "right")) - 1
                at = (c - int(first[row])) * size
                passage = rows[row][at:at + 2 * size]
                grams = shingles(passage)
                for item, score in got.items():
                    q, a = (len(x & grams) / len(x) for x in self.parts[item])
                    if q >= overlap and a >= overlap and (not self.short[item] or adjoin(passage, *self.parts[item])):
                        found[row, item] = max(found.get((row, item), (0.0,)), (score, q, a))
        return [(*k, *v) for k, v in sorted(found.items())]


def _indexes(items: DataFrame, id_col: str, text_col: str):
    """(ids, broadcast index) of each part of the test items, one after another."""
    src = items.select(tx.col(id_col).alias("item_id"), F.coalesce(tx.col(text_col), F.lit("")).alias("text"))
    parts = max(1, -(-src.count() // INDEX_ITEMS))
    for p in range(parts):
        rows = src.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p).orderBy("item_id", "text").collect()
        rows = [r for r in rows if words(r.text.encode())]
        index = items.sparkSession.sparkContext.broadcast(Index([r.text.encode() for r in rows]))
        yield [r.item_id for r in rows], index


def contamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
                  id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of every document and item found in it.

    Null or empty texts and items match nothing; repeated documents and items
    match each on its own; null ids are kept as they are.  No shuffle: each
    whole text is read once for each ``INDEX_ITEMS`` items.  Other columns are
    ignored; empty tables give an empty result.
    """
    src = tx.id_text(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    id_type = items.select(tx.col(item_id_col)).schema[0].dataType.simpleString()
    out = None
    for ids, index in _indexes(items, item_id_col, item_text_col):
        def run(batches, ids=ids, index=index):
            held = tx.per_worker(("items", index.value.name), lambda: index.value)
            for b in tx.slices(batches, 1):
                got = held.matches(b.column(1).cast(pa.binary()).to_pylist(), threshold, overlap)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([g[0] for g in got], pa.int64())), pa.array([g[1] for g in got], pa.int64()),
                     *(pa.array([g[k] for g in got], pa.float64()) for k in (2, 3, 4))],
                    ["doc_id", "at", "score", "question_overlap", "answer_overlap"])

        found = src.mapInArrow(run, f"doc_id {kind}, at bigint, score double, question_overlap double, answer_overlap double")
        names = items.sparkSession.createDataFrame(list(enumerate(ids)), f"at bigint, item_id {id_type}")
        part = found.join(F.broadcast(names), "at").select("doc_id", "item_id", "score", "question_overlap", "answer_overlap")
        out = part if out is None else out.unionByName(part)
    return out


def decontaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
                   text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which no test item is found.

    Rows with a null or empty text stay, as does every row when there are no
    items; repeated rows go or stay alike.  Texts of any length are searched
    whole.  An empty table gives an empty result.
    """
    at = docs.columns.index(text_col)
    for _, index in _indexes(items, item_id_col, item_text_col):
        def run(batches, index=index):
            held = tx.per_worker(("items", index.value.name), lambda: index.value)
            for b in tx.slices(batches, at):
                texts = [t or b"" for t in b.column(at).cast(pa.binary()).to_pylist()]
                hit = {g[0] for g in held.matches(texts, threshold, overlap)}
                yield b.filter(pa.array([k not in hit for k in range(b.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
