"""Language-model scores: the marginal likelihood of a text over all segmentations into subword pieces.

The pieces are an existing vocabulary's; each has one unigram probability,
learned from the training documents (counts of the vocabulary's own
segmentation of their words, then rounds of expectation-maximisation over the
lattice).  A word's probability sums over every way to cut it into pieces, by
a forward recursion in log space; a character that is no piece is spelled by
its byte pieces, so every word has one.  A text's probability is its words' and one
end's.  Base scores come from add-one word counts.

Words as frequent as ``HOT`` of all tokens, at most 1 / HOT of them, are sent
to the tasks; the others meet their counts and scores in a join by word.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .storage import staged

#: Share of all training tokens from which a word is sent to every task.
HOT = 4e-6
#: Rounds of re-estimation over the lattice.
ROUNDS = 2
#: Fixed value: what stands for the space before a word in the vocabulary.
SPACE = "▁"
END = "</s>"
#: Characters of a block of words that a lattice is laid out for at once.
BLOCK = 200_000

_PRIME, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _is_byte(piece: str) -> bool:
    return len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">")


class Lattice:
    """Piece probabilities of a vocabulary and sums over words' segmentations, for many words of a length at a time."""

    def __init__(self, log_probs: dict[str, float]):
        """``log_probs``: natural logarithms, for the pieces, byte pieces as ``<0x..>`` and the end."""
        self.byte = {int(p[3:5], 16): x for p, x in log_probs.items() if _is_byte(p)}
        self.pieces = [p for p in log_probs if not _is_byte(p) and p != END]
        self.longest = max(map(len, self.pieces), default=1)
        hashes, sizes = np.zeros(len(self.pieces), np.uint64), np.array([len(p) for p in self.pieces])
        for n in range(1, self.longest + 1):
            own = np.flatnonzero(sizes == n)
            if len(own):
                codes = np.frombuffer("".join(self.pieces[k] for k in own).encode("utf-32-le"), "<u4")
                hashes[own] = self._substrings(codes.reshape(len(own), n).astype(np.uint64), n)[-1][:, 0]
        self.order = np.argsort(hashes)
        self.hashes, self.log = hashes[self.order], np.array([log_probs[p] for p in self.pieces])[self.order]

    @staticmethod
    def _substrings(codes: np.ndarray, longest: int) -> list[np.ndarray]:
        """Hashes of all substrings of 1, 2, ... ``longest`` characters, by where they begin (words x places)."""
        out, h = [], np.zeros(codes.shape, np.uint64)
        for size in range(1, min(longest, codes.shape[1]) + 1):
            n = codes.shape[1] - size + 1
            h = (h[:, :n] * _PRIME) ^ (codes[:, size - 1:] + np.uint64(1)) * _ODD
            h = h ^ (h >> np.uint64(29))
            out.append(h)
        return out

    def _edges(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """By length: log probability and sorted place of the piece that begins at each place, or -inf and -1.

        A character that is no piece is spelled by its byte pieces.
        """
        out = []
        for h in self._substrings(codes, self.longest):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[at] == h
            logs = np.where(hit, self.log[at], -np.inf)
            if not out and not hit.all():
                for c in np.unique(codes[~hit]).tolist():
                    logs[codes == c] = sum(self.byte[b] for b in chr(c).encode())
            out.append((logs, np.where(hit, at, -1)))
        return out

    @staticmethod
    def _forward(edges: list, shape: tuple) -> np.ndarray:
        """Log probability of reaching each place."""
        alpha = np.full((shape[0], shape[1] + 1), -np.inf)
        alpha[:, 0] = 0.0
        for j in range(1, shape[1] + 1):
            alpha[:, j] = np.logaddexp.reduce(
                [alpha[:, j - k] + edges[k - 1][0][:, j - k] for k in range(1, min(j, len(edges)) + 1)])
        return alpha

    @staticmethod
    def _by_length(words: list[bytes]):
        """(positions, character codes) of words of one length, in blocks of bounded size."""
        texts = [SPACE + w.decode() for w in words]
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(sizes, kind="stable")
        for n in np.unique(sizes).tolist():
            own = order[np.searchsorted(sizes[order], n):np.searchsorted(sizes[order], n, "right")]
            step = max(1, BLOCK // n)
            for at in range(0, len(own), step):
                some = own[at:at + step]
                codes = np.frombuffer("".join(texts[i] for i in some).encode("utf-32-le"), "<u4")
                yield some, codes.reshape(len(some), n).astype(np.uint64)

    def words(self, words: list[bytes]) -> np.ndarray:
        """Log10 marginal probability of each word."""
        out = np.zeros(len(words))
        for some, codes in self._by_length(words):
            out[some] = self._forward(self._edges(codes), codes.shape)[:, -1]
        return out / math.log(10)

    def expect(self, words: list[bytes], times: list[int], counts: Counter) -> None:
        """Add the expected use of each piece over all words, each counted ``times``."""
        used, times = np.zeros(len(self.pieces)), np.array(times, np.float64)
        for some, codes in self._by_length(words):
            edges, n = self._edges(codes), codes.shape[1]
            alpha = self._forward(edges, codes.shape)
            beta = np.full(alpha.shape, -np.inf)
            beta[:, n] = 0.0
            for i in range(n - 1, -1, -1):
                beta[:, i] = np.logaddexp.reduce(
                    [edges[k - 1][0][:, i] + beta[:, i + k] for k in range(1, min(n - i, len(edges)) + 1)])
            for k, (logs, piece) in enumerate(edges, 1):
                share = np.exp(alpha[:, :n - k + 1] + logs + beta[:, k:] - alpha[:, -1:]) * times[some, None]
                known = piece >= 0
                used += np.bincount(piece[known], share[known], len(used))
                if k == 1 and not known.all():
                    for c in np.unique(codes[~known]).tolist():
                        x = float(share[codes == c].sum())
                        for b in chr(c).encode():
                            counts[f"<0x{b:02X}>"] += x
        for k in np.flatnonzero(used).tolist():
            counts[self.pieces[self.order[k]]] += float(used[k])


def _vocabulary(model: bytes) -> list[str]:
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not sp.is_control(i) and not sp.is_unknown(i)]


def _log_probs(vocabulary: list[str], counts: dict, ends: int) -> dict[str, float]:
    """Add-one probabilities of the pieces and the end."""
    n = {p: counts.get(p, 0.0) + 1 for p in vocabulary} | {END: ends + 1}
    total = math.log(math.fsum(n.values()))
    return {p: math.log(x) - total for p, x in n.items()}


def _piece_counts(words: DataFrame, count_batch) -> dict[str, float]:
    """Counts by piece over all distinct words: at most one row per piece leaves a task or reaches the driver."""
    def run(batches):
        counts = Counter()
        for b in batches:
            count_batch(counts, b.column("word").to_pylist(), b.column("c").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.float64())],
                                         ["piece", "n"])

    rows = words.where("c > 0").select("word", "c").mapInArrow(run, "piece string, n double")
    return {r.piece: r.n for r in rows.groupBy("piece").agg(F.sum("n").alias("n")).collect()}


def train(words: DataFrame, ends: int, model: bytes, rounds: int = ROUNDS) -> dict[str, float]:
    """Log probabilities of the vocabulary's pieces from the training words' counts (word, c)."""
    sc = words.sparkSession.sparkContext
    file, vocabulary = sc.broadcast(model), _vocabulary(model)

    def segment(counts, batch, n):
        sp = tx.per_worker(("pieces", hash(file.value)),
                           lambda: sentencepiece.SentencePieceProcessor(model_proto=file.value))
        for pieces, c in zip(sp.encode([w.decode() for w in batch], out_type=str, num_threads=1), n):
            for p in pieces:
                counts[p] += c

    probs = _log_probs(vocabulary, _piece_counts(words, segment), ends)
    for _ in range(rounds):
        sent = sc.broadcast(probs)

        def expect(counts, batch, n, sent=sent):
            Lattice(sent.value).expect(batch, n, counts)

        probs = _log_probs(vocabulary, _piece_counts(words, expect), ends)
    return probs


def _word_counts(src: DataFrame) -> DataFrame:
    """(word, c): occurrences in training documents of every word of any document."""
    def run(batches):
        for b in batches:
            own, held = Counter(), Counter()
            for t, out in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("held_out").to_pylist()):
                (held if out else own).update(t.lower().split())
            words = list(own.keys() | held.keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([own[w] for w in words], pa.int64())],
                                             ["word", "n"])

    return src.select("text", "held_out").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("c"))


def scores(docs: DataFrame, model_path: str, rounds: int = ROUNDS, hot: float = HOT,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every whole text.

    Documents whose crc32(doc_id as text) mod 7 is 2 are held out, the others
    train the counts and the pieces.  Logarithms to base 10.  Null or empty
    text: the end alone.  A null doc_id counts as the empty id text; repeated
    rows count and get a row each; other columns are ignored; an empty table
    gives an empty result.
    """
    sc = docs.sparkSession.sparkContext
    with open(model_path, "rb") as f:
        model = f.read()
    src = tx.id_text(docs, id_col, text_col).withColumn(
        "held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2)
    counted = staged(_word_counts(src), "words")
    ends = src.where(~F.col("held_out")).count()
    n_words, n_distinct = counted.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    n_all, v_all = (n_words or 0) + ends, n_distinct + (ends > 0)
    probs = sc.broadcast(train(counted, ends, model, rounds))

    def mark(batches):
        lattice = Lattice(probs.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lattice.words(b.column("word").to_pylist()))],
                ["word", "c", "log_p"])

    words = staged(counted.mapInArrow(mark, "word binary, c bigint, log_p double"), "scored-words")
    frequent = words.where(F.col("c") > hot * n_all).collect()  # fewer than 1 / hot
    often = sc.broadcast({bytes(r.word): (math.log10(r.c + 1), r.log_p) for r in frequent})
    kind, end_c, end_p = src.schema["doc_id"].dataType.simpleString(), math.log10(ends + 1), probs.value[END] / math.log(10)

    def sum_up(batches):
        for b in batches:
            out = []
            for t in b.column("text").cast(pa.binary()).to_pylist():
                counts, known, base, log_p, rare = Counter(t.lower().split()), int(ends > 0), end_c, end_p, []
                for w, n in counts.items():
                    seen = often.value.get(w)
                    if seen:
                        known, base, log_p = known + n, base + n * seen[0], log_p + n * seen[1]
                    else:
                        rare.append({"word": w, "n": n})
                out.append((1 + sum(counts.values()), known, base, log_p, rare))
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                     pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("key", "doc_id", "held_out")),
                 *(pa.array([o[k] for o in out], types[k]) for k in range(5))],
                ["key", "doc_id", "held_out", "n_tokens", "known", "base", "log_p", "rare"])

    sums = staged(src.withColumn("key", F.monotonically_increasing_id()).mapInArrow(
        sum_up, f"key bigint, doc_id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, log_p double, "
                "rare array<struct<word: binary, n: bigint>>"), "sums")
    rest = sums.select("key", F.explode("rare").alias("w")).select("key", "w.word", "w.n").join(words, "word").groupBy(
        "key").agg(F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("r_known"),
                   F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("r_base"), F.sum(F.col("n") * F.col("log_p")).alias("r_p"))
    zero, n = F.lit(0.0), math.log10(n_all + v_all + 1)
    return sums.drop("rare").join(rest, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("r_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("r_base", zero) - F.col("n_tokens") * F.lit(n)).alias("base_score"),
        (F.col("log_p") + F.coalesce("r_p", zero)).alias("score"))
