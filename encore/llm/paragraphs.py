"""Substring de-duplication: repeated paragraphs by MinHash banding with exact verification.

A sentence or line of ``MIN_WORDS`` words or more ends a paragraph.  Among
shorter ones, and inside a long one ``INSIDE`` words or more from its ends, a
paragraph ends where the hash of the two neighbouring words is the least within
``MIN_WORDS`` - 1 words.
The cuts depend on the words around them only, so a passage that repeats inside
other text, wherever it begins and ends, yields the same paragraphs there but
at its ends.  A paragraph has ``MIN_WORDS`` words or more; only a text's last
may have fewer, and is then compared together with the words before it.
Paragraphs get min-hashes of their five-word shingles, in
bands tuned for high recall (4 bands of 2: 98 % at similarity 0.8, and every
exact copy); paragraphs that share a band are compared by the exact Jaccard
similarity of their shingle sets.  Linked paragraphs form components, of which
the first occurrence stays.  Repeated paragraphs count where they make a run of
``MIN_RUN`` words or more: most shorter ones are sentences that texts share by chance.

The texts are cut in one pass; what it finds is written, and words are read
again only for paragraphs that share a band with another.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as tx
from .components import components
from .storage import drop, numbered, stage_path, staged

SHINGLE, SIMILARITY = 5, 0.8
#: Words of a paragraph at least; words between the ends of a sentence and a cut inside it.
MIN_WORDS, INSIDE = 8, 12
BANDS, ROWS = 4, 2
#: Distinct paragraphs of a band's list that one task compares with as many others.
BLOCK = 1_000
#: Keys and min-hashes a key by which longer lists are dealt anew: 99.8 % and 98.8 % at similarity 0.8.
FINER = ((12, 4), (24, 8))
#: Words of a run of repeated neighbouring paragraphs at least.
MIN_RUN = 16
_BAND_COLS = [f"band{k}" for k in range(BANDS)]
_ROW = "__encore_row"

_MOST = np.uint64(2**64 - 1)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _least(v: np.ndarray) -> np.ndarray:
    """Whether each value is the least, the first of equals, of those up to ``MIN_WORDS`` - 1 places off."""
    n, k = len(v), MIN_WORDS - 1
    wide = np.concatenate([np.full(k, _MOST), v, np.full(k, _MOST)])
    least = v < _MOST
    for d in range(k):
        least &= (v < wide[d:d + n]) & (v <= wide[d + k + 1:d + k + 1 + n])
    return least


def paragraphs(text: bytes) -> list[tuple[int, list[bytes]]]:
    """(end, words) of each paragraph; the ends cover the whole text."""
    words, n = text.split(), len(text)
    if len(words) <= MIN_WORDS:
        return [(n, words)] if n else []
    chars = np.frombuffer(text, np.uint8)
    black = np.concatenate([[False], (chars != 32) & ((chars < 9) | (chars > 13)), [False]])
    starts, ends = np.flatnonzero(black[1:-1] & ~black[:-2]), np.flatnonzero(black[1:-1] & ~black[2:])
    # Places before each word but the first: a stop there, and whether its sentence is long enough.
    stop = np.isin(chars[ends], np.frombuffer(b".!?", np.uint8))
    lines = np.searchsorted(starts, np.flatnonzero(chars == 10))
    stop[lines[lines > 0] - 1] = True
    at = np.flatnonzero(stop[:-1]) + 1
    hashed = _word_hashes()
    word = np.array([hashed[w] for w in text.lower().split()], np.uint64)
    pair = _mix(word[:-1] * _PRIME + word[1:]) >> np.uint64(2)
    value = pair | np.uint64(1 << 63)
    bounds, place = np.array([0, *at, len(words)]), np.arange(1, len(words))
    value[np.minimum(place - np.repeat(bounds[:-1], np.diff(bounds))[1:],
                     np.repeat(bounds[1:], np.diff(bounds))[1:] - place) < INSIDE] = _MOST
    value[at - 1] = pair[at - 1]
    value[:MIN_WORDS - 1] = value[len(words) - MIN_WORDS:] = _MOST  # too near the ends of the text
    value[at[np.diff(at, prepend=0) >= MIN_WORDS] - 1] = 0
    cuts = (np.flatnonzero(_least(value)) + 1).tolist()
    return [(end, words[a:b]) for a, b, end in zip(
        [0, *cuts], [*cuts, len(words)], [*starts[cuts].tolist(), n])]


def _long_paragraphs(texts: list[bytes]):
    """(row, index, words) of the paragraphs; a short last one goes with as many words before it as it lacks."""
    for row, t in enumerate(texts):
        last = []
        for k, (_, words) in enumerate(paragraphs(t.lower())):
            if len(words) < MIN_WORDS:
                words = last[len(words) - MIN_WORDS:] + words
            if len(words) >= MIN_WORDS:
                yield row, k, words
            last = words


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes():
    return tx.per_worker("paragraph words", lambda: tx.Cached(lambda w: xxhash.xxh64_intdigest(w, 7), 300_000))


def _min_hashes(gram: np.ndarray, first: np.ndarray, bands: int, rows: int, seed: int) -> np.ndarray:
    """Band keys (paragraphs x ``bands``) of ``rows`` min-hashes each, of the shingles that begin at ``first``."""
    keys, seeds = [], np.arange(seed + 1, seed + bands * rows + 1, dtype=np.uint64) * _PRIME
    for b in range(bands):
        key = np.full(len(first), np.uint64(seed + b + 1))
        for r in range(rows):
            low = np.minimum.reduceat(_mix(gram ^ seeds[b * rows + r]), first)
            key = _mix(key * _PRIME + low)
        keys.append(key)
    return np.stack(keys, 1)


def _shingle_hashes(word: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of consecutive paragraphs of ``size`` words each, and where each one's begin."""
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.arange(len(word)) - np.repeat(start, size)
    gram = np.zeros(len(word), np.uint64)
    for k in range(SHINGLE):
        gram[:len(word) - k] = gram[:len(word) - k] * _PRIME + word[k:]
    inside = place + SHINGLE <= np.repeat(size, size)
    return _mix(gram[inside]), np.concatenate([[0], np.cumsum(size - SHINGLE + 1)[:-1]])


def _hashes(found: list):
    """Content hash of each paragraph and its band keys (paragraphs x BANDS)."""
    hashed = _word_hashes()
    size = np.array([len(w) for _, _, w in found], np.int64)
    word = np.array([hashed[w] for _, _, ws in found for w in ws], np.uint64)
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.arange(len(word)) - np.repeat(start, size)
    content = _mix(np.add.reduceat(_mix(word + _PRIME * place.astype(np.uint64)), start) + size.astype(np.uint64))
    return content, _min_hashes(*_shingle_hashes(word, size), BANDS, ROWS, 0)


def _cut(docs: DataFrame) -> DataFrame:
    """(row, doc_id, paragraph, n_words, content, band0 ..., words) of all paragraphs: the one pass over the texts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "paragraph", "n_words", "content", *_BAND_COLS, "words"]

    def run(batches):
        for b in tx.slices(batches, 2):
            found = list(_long_paragraphs(b.column(2).cast(pa.binary()).to_pylist()))
            if found:
                content, keys = _hashes(found)
                at = pa.array([f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array([f[1] for f in found], pa.int32()),
                     pa.array([len(f[2]) for f in found], pa.int32()), pa.array(content.view(np.int64)),
                     *(pa.array(keys[:, k].copy().view(np.int64)) for k in range(BANDS)),
                     pa.array([b" ".join(f[2]) for f in found], pa.binary())], names)

    bands = ", ".join(f"{c} bigint" for c in _BAND_COLS)
    return docs.select("row", "doc_id", "text").mapInArrow(
        run, f"row string, doc_id {kind}, paragraph int, n_words int, content bigint, {bands}, words binary")


def shingles(words: bytes) -> frozenset:
    ws = words.split(b" ")
    return frozenset(zip(*(ws[k:] for k in range(SHINGLE)))) if len(ws) >= SHINGLE else frozenset([tuple(ws)])


def forest(members: list[tuple[int, frozenset]], similarity: float) -> list[tuple[int, int]]:
    """Links of a spanning forest of the members whose exact Jaccard similarity reaches ``similarity``."""
    links, todo = [], members
    while len(todo) > 1:
        stack, todo = [todo[0]], todo[1:]
        while stack and todo:
            key, own = stack.pop()
            far, n = [], len(own)
            for member in todo:
                other = member[1]
                if min(n, len(other)) >= similarity * max(n, len(other)):
                    shared = len(own & other)
                    if shared >= similarity * (n + len(other) - shared):
                        links.append((key, member[0]))
                        stack.append(member)
                        continue
                far.append(member)
            todo = far
    return links


def _lists(rows: DataFrame) -> DataFrame:
    """(band, content, members) of the bands of ``rows`` (band, content; each pair once) that hold several contents.

    Members are counted before the rows are joined to their number, so a hot band's rows never meet in one task.
    """
    sizes = staged(rows.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "band-sizes")
    return staged(rows.join(sizes, "band"), "bands")


def _finer(lists: DataFrame, texts: DataFrame, bands: int, rows: int, seed: int) -> DataFrame:
    """The members of long lists in lists of ``bands`` further keys of ``rows`` min-hashes each: (band, content)."""
    def run(batches):
        hashed = _word_hashes()
        for b in tx.slices(batches, 2):
            words = [w.split(b" ") for w in b.column(2).to_pylist()]
            size = np.array([len(w) for w in words], np.int64)
            word = np.array([hashed[w] for ws in words for w in ws], np.uint64)
            keys = _min_hashes(*_shingle_hashes(word, size), bands, rows, seed)
            keys = _mix(keys * _PRIME + b.column(0).to_numpy().view(np.uint64)[:, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(b.column(1).to_numpy(), bands))], ["band", "content"])

    return lists.select("band", "content").join(texts, "content").select("band", "content", "words").mapInArrow(
        run, "band bigint, content bigint")


def _links(lists: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b): verified links between the contents of each band's list (band, content, members).

    Lists longer than ``BLOCK``, of many unlike paragraphs or many like ones,
    are dealt anew by more min-hashes (``FINER``), which unlike members rarely
    share.  What is still longer is cut into blocks, and every pair of blocks
    is a list of its own: a bounded size for each task's list.
    """
    done, seed = [], BANDS * ROWS
    for bands, rows in FINER:
        done.append(lists.where(F.col("members") <= BLOCK))
        long = lists.where(F.col("members") > BLOCK)
        if long.isEmpty():
            return _compared(done, texts, similarity)
        lists = _lists(_finer(long, texts, bands, rows, seed))
        seed += bands * rows
    return _compared([*done, lists], texts, similarity)


def _compared(parts: list[DataFrame], texts: DataFrame, similarity: float) -> DataFrame:
    lists = functools.reduce(DataFrame.unionByName, parts)
    sized = lists.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int")
    blocks = sized.select("band", "content", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    blocks = blocks.select("band", "content", F.least("own", "o").alias("lo"), F.greatest("own", "o").alias("hi"))
    keys = ["band", "lo", "hi"]

    def run(batches):
        last, members = None, []
        for b in itertools.chain(batches, [None]):
            links = []
            rows = zip(*(b.column(c).to_pylist() for c in range(5))) if b is not None else [(None,) * 5]
            for band, lo, hi, content, words in rows:
                if (band, lo, hi) != last:
                    links += forest(members, similarity)
                    last, members = (band, lo, hi), []
                if words is not None:
                    members.append((content, shingles(words)))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    members = blocks.join(texts, "content").select(*keys, "content", "words")
    return members.repartition(*keys).sortWithinPartitions(*keys, "content").mapInArrow(run, "a bigint, b bigint")


def _repeated(src: DataFrame, similarity: float, min_run: int) -> DataFrame:
    """(row, doc_id, paragraph, n_words, kept_doc_id, kept_paragraph, removed) for the rows (row, doc_id, text)."""
    spark = src.sparkSession
    paths = {name: stage_path(spark, name) for name in ("paragraphs", "wanted", "words", "roots", "again")}
    cut = staged(_cut(src), "paragraphs", paths["paragraphs"], "zstd")
    # Distinct contents and their bands are summed up twice rather than written: most share no band.
    posted = cut.groupBy("content").agg(*[F.first(c).alias(c) for c in _BAND_COLS]).select(
        F.explode(F.array(*_BAND_COLS)).alias("band"), "content")
    lists = _lists(posted)
    # Words are fetched for the contents of a list only, one holder each.
    wanted = staged(lists.select("content").distinct(), "wanted", paths["wanted"])
    texts = staged(cut.select("content", "words").join(wanted, "content", "left_semi").dropDuplicates(["content"]), "words", paths["words"])
    roots = staged(components(_links(lists, texts, similarity)), "roots", paths["roots"])
    # Aggregates are written before they are joined: a join of two plain shuffles can split a hot content or component.
    copied = cut.groupBy("content").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("content")
    again = staged(copied.join(roots, F.col("content") == F.col("node"), "full").select(
        F.coalesce("content", "node").alias("of"), F.coalesce("root", "content").alias("component")), "again", paths["again"])
    placed = staged(cut.select("row", "doc_id", "paragraph", "n_words", "content").join(
        again, F.col("content") == F.col("of")).select("row", "doc_id", "paragraph", "n_words", "component"), "placed")
    for path in paths.values():  # nothing below reads them
        drop(spark, path)
    first = staged(placed.groupBy("component").agg(
        F.min(F.struct("doc_id", "row", "paragraph")).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1"), "first")
    found = placed.join(first, "component")
    # Runs of neighbouring repeated paragraphs in a text; a text's are as many as it has paragraphs.
    island = Window.partitionBy("row").orderBy("paragraph")
    run = Window.partitionBy("row", "run")
    runs = found.withColumn("run", F.col("paragraph") - F.row_number().over(island)).withColumn(
        "run_words", F.sum("n_words").over(run))
    same = (F.col("row") == F.col("kept.row")) & (F.col("paragraph") == F.col("kept.paragraph"))
    return runs.where(F.col("run_words") >= min_run).select(
        "row", "doc_id", "paragraph", "n_words", F.col("kept.doc_id").alias("kept_doc_id"),
        F.col("kept.paragraph").alias("kept_paragraph"), (~same).alias("removed"))


def repeated_paragraphs(docs: DataFrame, similarity: float = SIMILARITY, min_run: int = MIN_RUN,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph, n_words, kept_doc_id, kept_paragraph, removed) of every paragraph that occurs again.

    Only runs of neighbouring repeated paragraphs of ``min_run`` words or more
    count: a sentence that two texts share by chance stays in both.  paragraph
    counts from 0 within a document's text; kept_* name the first occurrence,
    by (doc_id, row, paragraph), of the component, the only one not removed.
    Null and empty texts have no paragraph.  Rows are told apart by their
    place, so rows that share a doc_id or have none (null sorts first) are
    documents of their own, and of repeated rows the first keeps its
    paragraphs.  Very long texts are worked on one at a time.  Other columns
    are ignored; an empty table gives an empty result.
    """
    src = tx.id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id().cast("string"))  # read once: numbered once
    return _repeated(src, similarity, min_run).drop("row")


def without_paragraphs(text: bytes, gone: set[int]) -> bytes:
    """The text less the paragraphs of the given numbers, line breaks and spaces after them included."""
    kept, at = [], 0
    for k, (end, _) in enumerate(paragraphs(text)):
        if k not in gone:
            kept.append(text[at:end])
        at = end
    return b"".join(kept)


def drop_repeated(docs: DataFrame, similarity: float = SIMILARITY, min_run: int = MIN_RUN,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every repeated paragraph but the first cut from its text, by the rule of :func:`repeated_paragraphs`.

    All columns stay as they are but the text, which a pandas function
    rewrites.  A text left without any word loses its row; texts that had none
    before keep theirs.  Rows count by their place: without an id, or with one
    that others have, they lose what an earlier row has all the same.
    """
    rows = numbered(docs, _ROW)
    src = rows.select(F.col(_ROW).alias("row"), tx.col(id_col).alias("doc_id"), F.coalesce(tx.col(text_col), F.lit("")).alias("text"))
    gone = "__encore_gone"
    cut = _repeated(src, similarity, min_run).where("removed").groupBy(F.col("row").alias("__encore_cut")).agg(
        F.collect_set("paragraph").alias(gone))

    @F.pandas_udf("string")
    def rewrite(texts: pd.Series, numbers: pd.Series) -> pd.Series:
        return pd.Series([t if n is None or t is None else without_paragraphs(t.encode(), set(n)).decode()
                          for t, n in zip(texts, numbers)], dtype=object)

    text = tx.col(text_col)
    joined = rows.join(cut, F.col(_ROW) == F.col("__encore_cut"), "left")
    left = joined.withColumn(text_col, rewrite(text, F.col(gone)))
    return left.where(F.col(gone).isNull() | text.rlike(r"[^\x20\x09-\x0D]")).select(*[tx.col(c) for c in docs.columns])
