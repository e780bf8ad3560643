"""Token counts: byte-pair merging with a heap over a linked list of symbols.

A text is cut at its added special tokens (each counts one), each rest into
the pre-tokens of a byte-level tokenizer; a pre-token starts as one symbol per
byte and the lowest-ranked adjacent pair (leftmost among equals) merges until
none is left.  The count is the initial symbols less the merges; no ids are
made.  Counts of pre-tokens are remembered per worker.
"""

from __future__ import annotations

import heapq
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import text as tx

#: Fixed values of byte-level BPE files: its white space and its pre-token pattern.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+"
           rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in out:
            out[b], spare = chr(spare), spare + 1
    return [out[b] for b in range(256)]


class BpeCounter:
    """Token counts of a byte-level BPE file (its JSON text)."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        vocab = spec["model"]["vocab"]
        self.first = [vocab[c] for c in _byte_chars()]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a] << 32 | vocab[b]] = (rank, vocab[a + b])
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pieces = regex.compile(PATTERN)
        self.counts = tx.Cached(self.count_piece)

    def count_piece(self, piece: str) -> int:
        sym = [self.first[b] for b in piece.encode()]
        n = count = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges, heap = self.merges, []

        def offer(i: int, j: int) -> None:
            found = merges.get(sym[i] << 32 | sym[j])
            if found:
                heapq.heappush(heap, (found[0], i, sym[i], sym[j], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if sym[i] != left or j >= n or sym[j] != right:
                continue  # one of the two has merged with another neighbour since
            sym[i], sym[j], after[i] = merged, -1, after[j]
            count -= 1
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return count

    def count(self, text: str) -> int:
        parts, n = [text], 0
        if self.special:
            parts = self.special.split(text)
            n = len(parts) - 1
        counts = self.counts
        return n + sum(sum([counts[p] for p in self.pieces.findall(part)]) for part in parts)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text.

    One row per input row, no shuffle.  Null or empty text: 0 bytes, 0 tokens.
    Repeated rows and null ids give a row each; other columns are ignored.
    """
    file = docs.sparkSession.sparkContext.broadcast(tx.read_file(tokenizer_path))

    def count(batches):
        counter = tx.per_worker(("bpe", hash(file.value)), lambda: BpeCounter(file.value))
        for b in batches:
            texts = b.column(1).to_pylist()
            n = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    src = tx.id_text(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
