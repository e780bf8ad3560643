"""Spelling variants: words one edit apart by dense prefix-suffix tiling, grouped under their most frequent form.

A single edit leaves the first or the last half of a word untouched, so words
meet in lists by length and half.  A list is compared in tiles of at most
``CELLS`` cells: padded matrices of code points, aligned at the left for common
prefixes and at the right for common suffixes, give both lengths for all pairs
of a tile at once; a pair is one edit apart exactly where prefix plus suffix
reach the longer length minus one.  A pair that meets in both lists counts in
that of the prefix.  Tiles hand on one row a word (its near words' number and
the most frequent one), never their pairs.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .storage import drop, stage_path, staged

#: Fixed values of the contract.
RUN, MIN_LENGTH, MIN_COUNT, DROP = r"[a-zÀ-ÿ]", 5, 3, 97
#: Words and code points of one side of a tile.
ROWS, CELLS = 1024, 1 << 20
#: Lists of up to so many words share a tile.
SMALL = 32


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, one in 97 (by the crc32 of id and run) less one code point."""
    runs = tx.id_text(docs, id_col, text_col).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(tx.ascii_lower(F.col("text")), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))).alias("run"))
    cut = F.concat(F.expr("substring(run, 1, CAST(h % char_length(run) AS INT))"),
                   F.expr("substring(run, CAST(h % char_length(run) AS INT) + 2)"))
    words = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run"))).select(F.when(F.col("h") % DROP == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= min_length).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _halves(words: DataFrame, min_length: int) -> DataFrame:
    """(half, length, word, n): each word under its halves, as the shorter and as the longer word of a pair.

    ``length`` is the shorter word's.  A pair of an edit in or after the
    shorter's second half shares the first, any other pair the second half.
    """
    def of(shorter: str) -> list[str]:
        return [f"named_struct('half', concat('<', CAST({shorter} AS STRING), ':', left(word, {shorter} DIV 2)), "
                f"'length', {shorter})",
                f"named_struct('half', concat('>', CAST({shorter} AS STRING), ':', right(word, {shorter} - {shorter} DIV 2)), "
                f"'length', {shorter})"]

    n = "char_length(word)"
    return words.select(F.inline(F.expr(f"array({', '.join(of(n) + of(f'({n} - 1)'))})")), "word", "n").where(
        F.col("length") >= min_length)


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words, padded after and before them, and their lengths."""
    left = np.array(words).view(np.uint32).reshape(len(words), -1)
    size = np.array([len(w) for w in words])
    at = np.arange(left.shape[1]) - (left.shape[1] - size)[:, None]
    right = np.where(at >= 0, np.take_along_axis(left, np.maximum(at, 0), 1), 0)
    if left.max(initial=0) < 256:
        left, right = left.astype(np.uint8), right.astype(np.uint8)
    return left, right, size


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of each row of ``a`` with each row of ``b``."""
    going = np.ones((len(a), len(b)), bool)
    length = np.zeros((len(a), len(b)), np.uint8 if a.shape[1] < 256 else np.int32)
    for k in range(min(a.shape[1], b.shape[1])):
        going &= a[:, k, None] == b[None, :, k]
        if not going.any():
            break
        length += going
    return length


def near(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each word of ``a`` is one edit from each of ``b`` (words differ), and the common prefixes' lengths."""
    left_a, right_a, size_a = _matrix(a)
    left_b, right_b, size_b = _matrix(b)
    prefix = _common(left_a, left_b)
    suffix = _common(right_a[:, ::-1], right_b[:, ::-1])
    longer = np.maximum(size_a[:, None], size_b[None, :])
    apart = np.abs(size_a[:, None] - size_b[None, :])
    # A padding zero never equals a code point, so a common start ends with the shorter word; equal words reach beyond.
    both = prefix.astype(np.int32) + np.minimum(suffix, longer)
    return (apart <= 1) & (both >= longer - 1) & (prefix < longer), prefix


def _summary(word, n, i, j) -> pa.RecordBatch:
    """A row a word: number of its pairs (i, j) and the best (most frequent, then smallest) other word."""
    i, j = np.concatenate([i, j]), np.concatenate([j, i])
    place = np.unique(word, return_inverse=True)[1]  # code-point order
    order = np.lexsort((place[j], -n[j], i))
    i, j = i[order], j[order]
    own, first, count = np.unique(i, return_index=True, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(word[own], pa.string()), pa.array(count.astype(np.int64)), pa.array(n[j[first]]),
         pa.array(word[j[first]], pa.string())], ["word", "n_near", "best_n", "best"])


def _pairs(which: np.ndarray, first: np.ndarray, length: np.ndarray, side: np.ndarray, word: np.ndarray, split: bool):
    """(i, j) of the near pairs of a tile: within a list ``which``, across the two sides of a ``split`` one.

    A list takes the pairs whose shorter word has its length, one by the last
    half (not ``first``) those whose first halves differ.
    """
    size = np.array([len(w) for w in word])
    short = size == length
    if split:
        todo = [(short & (side == 0), side == 1, False), (~short & (side == 0), short & (side == 1), False)]
    else:
        todo = [(short, short, True), (short, ~short, False)]
    out = []
    for mine, others, same in todo:
        a, b = np.flatnonzero(mine), np.flatnonzero(others)
        if len(a) and len(b):
            hit, prefix = near(word[a].tolist(), word[b].tolist())
            hit &= (which[a][:, None] == which[b]) & (first[a][:, None] | (prefix < (length[a] // 2)[:, None]))
            x, y = np.nonzero(np.triu(hit, 1) if same else hit)
            out.append((a[x], b[y]))
    return [np.concatenate(x) for x in zip(*out)] if out else (np.empty(0, int), np.empty(0, int))


def neighbours(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n_near, best_n, best) of every word that is one edit from another.

    Lists of more than a tile are cut into blocks by the words' hash, and every
    pair of blocks is a tile of its own: exact, at a bounded size for each task.
    """
    halves = staged(_halves(words, min_length), "spelling-halves")
    per_tile = F.greatest(F.lit(1), F.least(F.lit(ROWS), F.floor(F.lit(CELLS) / (F.col("length") + 1)))).cast("int")
    lists = staged(halves.groupBy("half", "length").agg(
        F.count(F.lit(1)).alias("members"), F.max(F.char_length("word") == F.col("length")).alias("short")).where(
        "members > 1 AND short").select(
        "half", "members", F.ceil(F.col("members") / per_tile).cast("int").alias("blocks")), "spelling-lists")
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    rows = halves.join(lists, "half").select(
        "half", "length", "word", "n", own.alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    rows = rows.select("half", F.least("own", "o").alias("lo"), F.greatest("own", "o").alias("hi"), "length",
                       (F.col("own") > F.col("o")).cast("int").alias("side"), "word", "n")
    keys = ["half", "lo", "hi"]

    def tile(parts, split=False):
        length, side, word, n = (np.concatenate([p[k] for p in parts]) for k in range(3, 7))
        which = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        i, j = _pairs(which, np.array([p[0][0][0] == "<" for p in parts])[which], length, side, word, split)
        if len(i):
            yield _summary(word, n, i, j)

    def run(batches):
        held, size, width = [], 0, 0  # whole lists that share a tile
        rest = None                   # rows of the list that the last batch ended in
        for b in itertools.chain(batches, [None]):
            if b is not None:
                cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
                rest = cols if rest is None else [np.concatenate(x) for x in zip(rest, cols)]
            if rest is None or not len(rest[0]):
                continue
            h, lo, hi = rest[:3]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]))
            ends = [*new[1:].tolist(), *([len(h)] if b is None else [])]
            for s, e in zip(new.tolist(), ends):
                part = [x[s:e] for x in rest]
                if e - s > SMALL or lo[s] != hi[s]:
                    yield from tile([part], lo[s] != hi[s])
                    continue
                wide = max(width, int(part[3][0]) + 1)
                if held and (size + e - s > 2 * SMALL or (size + e - s) * wide > CELLS):
                    yield from tile(held)
                    held, size, wide = [], 0, int(part[3][0]) + 1
                held.append(part)
                size, width = size + e - s, wide
            rest = [x[ends[-1]:] for x in rest] if ends else rest
        if held:
            yield from tile(held)

    found = rows.repartition(*keys).sortWithinPartitions(*keys, "word").mapInArrow(
        run, "word string, n_near bigint, best_n bigint, best string")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: ``forms`` (word, form) followed to the end by doubling.

    A form is at least twice as frequent as its word, so chains have no loops and
    at most as many steps as the largest count has bits; each round halves them.
    """
    spark = forms.sparkSession
    path = stage_path(spark, "spelling-roots")
    now = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots", path)
    while True:
        onward = now.select(F.col("word").alias("via"), F.col("root").alias("further"))
        step = now.join(onward, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        next_path = stage_path(spark, "spelling-roots")
        step = staged(step, "spelling-roots", next_path)
        drop(spark, path)
        now, path = step.drop("moved"), next_path
        if step.where("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that occurs ``min_count`` times.

    ``n_near`` words are one edit away; the form is the most frequent of them
    (ties: the smallest) if it occurs twice as often, the root the end of the
    chain of forms.  Null and empty texts have no words; a null id counts as
    an empty one; repeated rows count again; a run's length is not bounded.
    Other columns are ignored; an empty table gives an empty result.
    """
    words = staged(word_counts(docs, min_length, min_count, id_col, text_col), "spelling-words")
    found = staged(neighbours(words, min_length), "spelling-near")
    better = F.col("best_n") >= 2 * F.col("n")
    formed = staged(words.join(found, "word", "left").select(
        "word", F.when(better, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(better, F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = roots(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Unsigned crc32 of (id, run) as SQL; letters up to U+00FF have one or two bytes.
_BYTES = ("flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] "
          "ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END))")
_CRC = (f"xor(list_reduce(list_concat([4294967295], {_BYTES}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")
_CRC_TABLE = ("list_transform(range(256), lambda x: list_reduce([x, 0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: "
              "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")

#: DuckDB's edit distance counts bytes: letters from U+00C0 become one-byte marks first.
_MARKS = "".join(map(chr, range(33, 97))).replace("'", "''")
_CODE = f"translate(word, '{''.join(map(chr, range(192, 256)))}', '{_MARKS}')"

#: The same rows by edit distances of words of like length.
SQL = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]{{5,}}')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT run, n, {_CRC} AS h FROM counted, crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word,
         sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
coded AS (SELECT word, n, {_CODE} AS code FROM words),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM coded a JOIN coded b
  ON length(b.word) IN (length(a.word) - 1, length(a.word), length(a.word) + 1) AND a.word <> b.word
  AND (left(a.word, 2) = left(b.word, 2) OR right(a.word, 2) = right(b.word, 2)) AND levenshtein(a.code, b.code) = 1),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, (-other_n, other)) AS best FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, CASE WHEN best_n >= 2 * n THEN best END AS form, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS here, 0 AS steps FROM forms
  UNION ALL
  SELECT walk.word, form, steps + 1 FROM walk JOIN forms ON forms.word = walk.here WHERE form IS NOT NULL)
SELECT word, form, (SELECT arg_max(here, steps) FROM walk WHERE walk.word = forms.word) AS root, n, n_near, form_n FROM forms
"""
