"""Quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

Trusted documents fall into two halves by the hash of their id.  Every text of
one trains the model: Spark counts the trigrams and from them the continuation
counts, discounts and interpolation weights.  Each n-gram has one value, what
it adds to a text's log probability over its lower order, so that a text's
score is the plain sum of the values of its n-grams that the model holds.
N-grams meet the model in several passes, each with those around some of the
words, and only sums of documents are kept between passes: the disk holds one
pass at a time.  A filter of bounded size rules out most n-grams that the pass's
part of the model does not hold; it never rules out one that it holds.  In a pass, n-grams are cut by key into buckets of bounded
size, and no task holds more than a bucket of the model.  The other half's
perplexities, all of them, give each language its quantile; documents above
their language's go.

:func:`train` and :func:`perplexities` are the same model in one broadcast, for
a caller who bounds the words it learns from.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as tx
from .storage import drop, placed, stage_path, staged

#: Entries of a shard; share of a language's trusted documents kept; trusted documents a language needs for its own.
SHARD, QUANTILE, OWN = 500_000, 0.995, 30
#: Entries of a bucket of a pass; passes at most, and those that count words.
BUCKET, PASSES, COUNTING = 100_000, 12, 2
#: Bits of a pass's filter for each entry of a bucket, and in all: with more entries it spares fewer requests, the results are the same.
FILTER_BITS, FILTER_MOST = 8, 1 << 29
#: Bytes of text hashed at once, or one longer text.
AT_ONCE = 1 << 17
#: Keys of one row of a request; rows that one such row may cover; rows of requests answered at once.
ASKED, COVERED, ANSWERED = 512, 1 << 16, 400
#: Steps of log-perplexity that quantiles are read to.
STEP = 0.001

_PRIME = np.uint64(0x9E3779B97F4A7C15)
START, STOP, CONTEXT = 1, 2, 3


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key(*words: np.ndarray) -> np.ndarray:
    """64-bit key of each n-gram of word hashes."""
    out = np.zeros(len(words[0]), np.uint64)
    for w in words:
        out = _mix(out * _PRIME + w)
    return out


def _byte_values() -> np.ndarray:
    """A value for each byte, the same for A-Z and a-z, and zero for what ``bytes.split()`` splits at."""
    values = _mix(np.arange(1, 257, dtype=np.uint64) * _PRIME)
    values[ord("A"):ord("Z") + 1] = values[ord("a"):ord("z") + 1]
    values[list(b" \t\n\r\x0b\x0c")] = 0
    return values


_BYTE = _byte_values()
_INSIDE, _POWER = _BYTE != 0, np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(int(_POWER), -1, 1 << 64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the polynomial's base and of its inverse, modulo 2^64; the worker remembers as many as most calls need."""
    def made(size):
        return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, x)])) for x in (_POWER, _BACK))

    return made(n) if n > 2 * AT_ONCE else tx.per_worker("n-gram powers", lambda: made(2 * AT_ONCE))


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the texts that begin and end at ``at`` in ``data``, and how many words each has."""
    inside = np.zeros(len(data) + 1, bool)
    np.take(_INSIDE, data, out=inside[1:], mode="clip")
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge[:-1]))
    up, back = _powers(len(data))
    values = np.take(_BYTE, data, mode="clip")
    values *= up[:len(data)]
    sums = np.cumsum(values)
    at_starts = sums[starts] - values[starts]
    ends = np.append(at_starts[1:], sums[-1:])[:len(starts)]  # what separates words adds nothing
    return _mix((ends - at_starts) * back[starts]), np.diff(np.searchsorted(starts, at))


def _hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, lower-cased (A-Z), and how many words each text has.

    A word's hash is a polynomial of its bytes' values, as the difference of two running sums over bytes.
    """
    texts = texts.cast(pa.large_binary())
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data, got, i = np.frombuffer(texts.buffers()[2], np.uint8), [], 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + AT_ONCE, "right")) - 1)
        got.append(_words(data[at[i]:at[j]], at[i:j + 1] - at[i]))
        i = j
    return np.concatenate([w for w, _ in got]), np.concatenate([n for _, n in got])


def _grams(texts: pa.Array):
    """Hashes of each token and the two before it, over all texts, and how many tokens each text has (its end counts)."""
    words, sizes = _hashes(texts)
    flat = np.full(len(words) + 3 * len(sizes), START, np.uint64)
    ends = np.cumsum(sizes + 3)
    flat[ends - 1] = STOP
    flat[np.arange(len(words)) + 3 * np.repeat(np.arange(len(sizes)), sizes) + 2] = words
    sizes = sizes + 1
    at = np.arange(int(sizes.sum())) + 2 * np.repeat(np.arange(1, len(sizes) + 1), sizes)
    return flat[at - 2], flat[at - 1], flat[at], sizes


def _trigrams(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in tx.slices(batches, 0):
            a, v, w, _ = _grams(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, v, w)], ["a", "b", "c"])

    return docs.select("text").mapInArrow(run, "a bigint, b bigint, c bigint")


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, from the counts of counts."""
    n = {r.k: r.m for r in counts.where("n <= 4").groupBy(F.col("n").alias("k")).agg(F.count(F.lit(1)).alias("m")).collect()}
    return _estimated([n.get(k, 0) for k in (1, 2, 3, 4)])


def _estimated(of: list[int]) -> list[float]:
    """Discounts from how many n-grams occur 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = of
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]


def _discounted(counts: DataFrame, context: list[str], d: list[float]) -> DataFrame:
    """``counts`` with the discounted share of its context, and the context's weight of the lower order."""
    cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
    of = Window.partitionBy(*context)
    return counts.withColumn("total", F.sum("n").over(of)).withColumn(
        "weight", F.sum(cut).over(of) / F.col("total")).withColumn("share", (F.col("n") - cut) / F.col("total"))


def _tables(rows: DataFrame, words: list[str], context: list[str]):
    """The shares by n-gram and the weights by context, as key and value arrays bounded by the training words."""
    got = rows.select(*words, F.col("share").cast("float"), F.col("weight").cast("float")).toArrow()
    held = {c: got[c].to_numpy() for c in got.column_names}
    keys = key(*(held[w].view(np.uint64) for w in words))
    contexts, first = np.unique(key(*(held[w].view(np.uint64) for w in context)), return_index=True) if context else (
        keys[:1], np.arange(min(1, len(keys))))
    return (keys, held["share"]), (contexts, held["weight"][first])


def shards(keys: np.ndarray, values: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The table cut by key into shards of about ``size`` entries, each sorted."""
    n = max(1, -(-len(keys) // size))
    out = []
    for s in range(n):
        own = np.flatnonzero(keys % np.uint64(n) == s)
        own = own[np.argsort(keys[own])]
        out.append((keys[own], values[own]))
    return out


def joined(keys: np.ndarray, table: list, missing: float) -> np.ndarray:
    """The value of each key, shard after shard."""
    out, home = np.full(len(keys), missing), keys % np.uint64(len(table))
    for s, (held, values) in enumerate(table):
        if len(held):
            mine = np.flatnonzero(home == s)
            at = np.minimum(np.searchsorted(held, keys[mine]), len(held) - 1)
            hit = held[at] == keys[mine]
            out[mine[hit]] = values[at[hit]]
    return out


def train(docs: DataFrame, shard: int = SHARD) -> dict:
    """The model's tables from the training documents' texts (column text)."""
    tri = staged(_trigrams(docs).groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n")), "trigrams")
    bi = staged(tri.groupBy("b", "c").agg(F.count(F.lit(1)).alias("n")), "bigrams")
    uni = bi.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    tri_share, tri_weight = _tables(_discounted(tri, ["a", "b"], _discounts(tri)), ["a", "b", "c"], ["a", "b"])
    bi_share, bi_weight = _tables(_discounted(bi, ["b"], _discounts(bi)), ["b", "c"], ["b"])
    (keys, share), (_, weight) = _tables(_discounted(uni, [F.lit(0)], _discounts(uni)), ["c"], [])
    unknown = float(weight[0]) / (len(keys) + 1) if len(keys) else 1.0
    parts = {"tri": tri_share, "tri_weight": tri_weight, "bi": bi_share, "bi_weight": bi_weight,
             "uni": (keys, share + np.float32(unknown))}
    return {name: shards(*t, shard) for name, t in parts.items()} | {"unknown": unknown}


def log_probs(model: dict, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(natural log probability, tokens) of each text."""
    a, b, c, sizes = _grams(pa.array(texts, pa.binary()))
    p = joined(key(c), model["uni"], model["unknown"])
    p = joined(key(b, c), model["bi"], 0.0) + joined(key(b), model["bi_weight"], 1.0) * p
    p = joined(key(a, b, c), model["tri"], 0.0) + joined(key(a, b), model["tri_weight"], 1.0) * p
    ends = np.cumsum(sizes)
    return np.add.reduceat(np.log(p), ends - sizes) if len(sizes) else np.zeros(0), sizes


def _half(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(2))


def training_texts(src: DataFrame, trusted: DataFrame, max_docs: int | None = None, max_words: int | None = None) -> DataFrame:
    """Whole texts of all trusted documents of the first half.

    With a bound, by id hash while they are at most ``max_docs`` documents and
    their words add up to at most ``max_words``; an id whose texts alone would
    pass that is left out.
    """
    ids = trusted.where(F.col("doc_id").isNotNull() & (_half(F.col("doc_id")) == 0)).select("doc_id").distinct()
    if max_docs is not None:
        ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    if max_words is not None:
        sizes = src.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(
            F.sum(F.size(F.split("text", tx.SPACE))).alias("n")).where(F.col("n") <= max_words)
        running = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
        ids = sizes.withColumn("upto", running).where(F.col("upto") <= max_words).select("doc_id")
    return src.join(ids, "doc_id", "left_semi").select("text")


def perplexities(src: DataFrame, model: dict) -> DataFrame:
    """(doc_id, lang, n_tokens, perplexity) of every row of (doc_id, text, lang)."""
    sent = src.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in tx.slices(batches, 1):
            logs, n = log_probs(sent.value, b.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("lang"), pa.array(n), pa.array(np.exp(-logs / n))],
                ["doc_id", "lang", "n_tokens", "perplexity"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, lang string, n_tokens bigint, perplexity double")


_ENTRY = "bucket int, asked int, file bigint, base bigint, of binary, keys binary, found binary"


def _entry(bucket, asked, file, base, of, keys, found) -> pa.RecordBatch:
    n = len(bucket)
    return pa.RecordBatch.from_arrays([
        pa.array(bucket, pa.int32()), pa.array([asked] * n, pa.int32()), pa.array([file] * n, pa.int64()),
        pa.array([base] * n, pa.int64()), pa.array(of, pa.binary()), pa.array(keys, pa.binary()),
        pa.array(found, pa.binary())], ["bucket", "asked", "file", "base", "of", "keys", "found"])


def _dealt(keys: np.ndarray, buckets: int, size: int):
    """(bucket, places in ``keys``) of each run of at most ``size`` keys of a bucket."""
    of = (keys % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(of, kind="stable")
    ends = np.cumsum(np.bincount(of, minlength=buckets))
    for b in np.flatnonzero(np.diff(ends, prepend=0)):
        for at in range(int(ends[b - 1]) if b else 0, int(ends[b]), size):
            yield int(b), order[at:min(at + size, int(ends[b]))]


def _pass_of(b: np.ndarray, passes: int) -> np.ndarray:
    """The pass of the n-grams around a word: trigrams and contexts that it is in the middle or at the end of, bigrams it begins."""
    return (b >> np.uint64(32)) % np.uint64(passes)


def _of_pass(word: str, k: int, passes: int) -> Column:
    return F.shiftrightunsigned(word, 32) % passes == k


def _counted(texts: DataFrame, k: int = 0, passes: int = 1) -> DataFrame:
    """(a, b, c, n): the trigrams of a pass and how often they occur; those of a bigram's words b, c are in one place."""
    def run(batches):
        for s in tx.slices(batches, 0):
            a, b, c, _ = _grams(s.column(0))
            mine = np.flatnonzero(_pass_of(b, passes) == k)
            a, b, c = a[mine], b[mine], c[mine]
            _, first, n = np.unique(key(a, b, c), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[first].view(np.int64)) for x in (a, b, c)), pa.array(n)],
                                             ["a", "b", "c", "n"])

    return texts.select("text").mapInArrow(run, "a bigint, b bigint, c bigint, n bigint").repartition(
        "b", "c").groupBy("a", "b", "c").agg(F.sum("n").alias("n"))


def _word_counts(texts: DataFrame, part: int = 0, parts: int = 1) -> DataFrame:
    """What the model needs of each word, and counts of counts to add up over words, of one of so many parts of the n-grams.

    n: words before it; total, k: sum and number of its bigrams' counts as
    their first word, k1 to k4 those of 1 to 4; t, t1 to t4: the same of the
    counts of trigrams that it ends.
    """
    def ones(of):
        return [F.count_if(F.col(of) == i).alias(f"t{i}") for i in range(1, 5)]

    bi = _counted(texts, part, parts).groupBy("b", "c").agg(F.count(F.lit(1)).alias("m"), *ones("n"))
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    names = ["n", "total", "k", *[f"k{i}" for i in range(1, 5)], "t", *[f"t{i}" for i in range(1, 5)]]
    as_end = {"n": one, "t": F.col("m")} | {f"t{i}": F.col(f"t{i}") for i in range(1, 5)}
    as_start = {"total": F.col("m"), "k": one} | {f"k{i}": (F.col("m") == i).cast("bigint") for i in range(1, 5)}
    roles = [F.struct(F.col(w).alias("w"), *[given.get(c, zero).alias(c) for c in names])
             for w, given in (("c", as_end), ("b", as_start))]
    return bi.select(F.explode(F.array(*roles)).alias("r")).select("r.*").groupBy("w").agg(*[F.sum(c).alias(c) for c in names])


def _cut(n: str, d: list[float]) -> Column:
    return F.when(F.col(n) == 1, d[0]).when(F.col(n) == 2, d[1]).otherwise(d[2])


def _single(c: Column) -> Column:
    """To single precision, in which discounted counts and weights are held."""
    return c.cast("float").cast("double")


def model_entries(docs: DataFrame, size: int = BUCKET):
    """(``entries``, the model's numbers): ``entries(k)`` gives the n-grams of pass ``k`` as rows of buckets of about ``size`` entries.

    A value is the logarithm of an n-gram's probability over its lower order's,
    of its weight as a context, or both; what was learned from are all texts of
    ``docs`` (column text).
    """
    texts = staged(docs, "training")
    paths = [stage_path(docs.sparkSession, "counted") for _ in range(COUNTING)]
    counted = [staged(_word_counts(texts, i, COUNTING), "counted", path) for i, path in enumerate(paths)]
    every = reduce(DataFrame.unionByName, counted)
    words = staged(every.groupBy("w").agg(*[F.sum(c).alias(c) for c in every.columns if c != "w"]), "words")
    for path in paths:
        drop(docs.sparkSession, path)
    sums = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in words.columns if c != "w"],
                     F.count_if(F.col("n") > 0).alias("u"), F.count(F.lit(1)).alias("rows"),
                     *[F.count_if(F.col("n") == i).alias(f"u{i}") for i in range(1, 5)]).first()
    d3, d2, d1 = (_estimated([sums[f"{x}{i}"] for i in range(1, 5)]) for x in "tku")
    cut = sum(d1[min(i, 3) - 1] * sums[f"u{i}"] for i in (1, 2)) + d1[2] * (sums.u - sums.u1 - sums.u2)
    n = float(sums.n or 1)
    unknown = cut / n / (sums.u + 1) if sums.u else 1.0
    count = sums.t + 2 * sums.k + sums.rows
    passes = min(PASSES, max(1, -(-count // (4 * size))))
    low = {"buckets": max(1, -(-count // (size * passes))), "passes": passes, "unknown": unknown}
    p = F.when(F.col("n") > 0, _single(F.col("n") - _cut("n", d1)) / n + unknown)
    weight = d2[0] * F.col("k1") + d2[1] * F.col("k2") + d2[2] * (F.col("k") - F.col("k1") - F.col("k2"))
    held = words.select("w", p.alias("p"), _single(F.col("total")).alias("total"), _single(weight).alias("weight"))
    stop = held.where(F.col("w") == STOP).first()
    low["stop"] = float(np.log(stop.p)) if stop else float(np.log(unknown))

    def entries(k: int) -> DataFrame:
        firsts = held.where(_of_pass("w", k, passes))
        pair, context = Window.partitionBy("b", "c"), Window.partitionBy("a", "b")
        tri = _counted(texts, k, passes).withColumns({
            "m": F.count(F.lit(1)).over(pair), "pair": F.min("a").over(pair) == F.col("a")})
        tri = tri.join(held.select(F.col("w").alias("c"), "p"), "c").join(
            firsts.select(F.col("w").alias("b"), "total", "weight"), "b")
        lower = F.col("weight") / F.col("total") * F.col("p")
        tri = tri.withColumn("low", _single(F.col("m") - _cut("m", d2)) / F.col("total") + lower).select(
            "a", "b", "c", "n", "low", F.when(F.col("pair"), F.log(F.col("low") / lower)).alias("bi"))
        tri = tri.withColumns({"all": _single(F.sum("n").over(context)), "left": _single(F.sum(_cut("n", d3)).over(context)),
                               "first": F.min("c").over(context) == F.col("c")})
        tri = tri.select("a", "b", "c", F.log1p(_single(F.col("n") - _cut("n", d3)) / (F.col("left") * F.col("low"))).alias("tri"), "bi",
                         F.when(F.col("first"), F.log(F.col("left") / F.col("all"))).alias("context"))
        value = F.coalesce(F.log(F.col("p") / unknown), F.lit(0.0)) + F.when(
            F.col("total") > 0, F.log(F.col("weight") / F.col("total"))).otherwise(0.0)
        return _packed(tri, low["buckets"], lambda a, b, c: {
            "tri": key(a, b, c), "bi": key(b, c), "context": _context(a, b)}).unionByName(
            _packed(firsts.select("w", value.alias("word")), low["buckets"], lambda w: {"word": key(w)}))

    return entries, low


def _context(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return key(np.full(len(a), CONTEXT, np.uint64), a, b)


def _packed(rows: DataFrame, buckets: int, keys_of) -> DataFrame:
    """The values of the rows' n-grams as rows of their buckets; ``keys_of`` gives the keys by column of values, a null is no entry."""
    def run(batches):
        for s in batches:
            words = [s.column(c).to_numpy().view(np.uint64) for c in s.schema.names if c in ("a", "b", "c", "w")]
            keys, values = [], []
            for name, of in keys_of(*words).items():
                value = s.column(name).to_numpy(zero_copy_only=False).astype("<f8")
                there = np.flatnonzero(~np.isnan(value))
                keys.append(of[there])
                values.append(value[there])
            keys, values = np.concatenate(keys), np.concatenate(values)
            runs = list(_dealt(keys, buckets, ASKED))
            yield _entry([r[0] for r in runs], 0, 0, 0, [None] * len(runs), [keys[at].tobytes() for _, at in runs],
                         [values[at].tobytes() for _, at in runs])

    return rows.mapInArrow(run, _ENTRY)


def _bit(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(32)) % np.uint64(bits)


def _filter(held: DataFrame, buckets: int, size: int) -> np.ndarray:
    """For each bucket the bits that its entries' keys set: an n-gram whose bit is not set has no entry and need not be asked for."""
    bits = 8 * max(1, min(FILTER_BITS * size, FILTER_MOST // buckets) // 8)

    def of_bucket(bucket: tuple, rows: pa.Table) -> pa.Table:
        got = np.zeros(bits, bool)
        got[_bit(np.frombuffer(b"".join(rows.column("keys").to_pylist()), np.uint64), bits)] = True
        return pa.table([pa.array([bucket[0].as_py()], pa.int32()), pa.array([np.packbits(got).tobytes()], pa.binary())], ["bucket", "bits"])

    out = np.zeros((buckets, bits // 8), np.uint8)
    for r in held.select("bucket", "keys").groupBy("bucket").applyInArrow(of_bucket, "bucket int, bits binary").toLocalIterator():
        out[r.bucket] = np.frombuffer(r.bits, np.uint8)
    return out


def _maybe(keys: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Places of the keys that the filter does not rule out."""
    bit = _bit(keys, 8 * held.shape[1])
    at = keys % np.uint64(len(held)) * np.uint64(held.shape[1]) + (bit >> np.uint64(3))
    return np.flatnonzero(held.ravel()[at] << (bit & np.uint64(7)).astype(np.uint8) & 128)


def _asked(src: DataFrame, held: np.ndarray, k: int, passes: int) -> DataFrame:
    """The n-grams of a pass, of every row of (file, at, text), as requests to their buckets; ``of`` says by steps whose they are."""
    buckets, sent = len(held), src.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        for s in tx.slices(batches, 2):
            file, place = s.column("file").to_numpy(), s.column("at").to_numpy()
            a, b, c, sizes = _grams(s.column("text"))
            mine = np.flatnonzero(_pass_of(b, passes) == k)
            row, a, b, c = np.repeat(np.arange(len(sizes)), sizes)[mine], a[mine], b[mine], c[mine]
            keys = np.stack([key(b), _context(a, b), key(b, c), key(a, b, c)], axis=1).ravel()
            some = _maybe(keys, sent.value)
            keys, row = keys[some], row[some // 4]
            cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(place) != 1)) + 1
            cuts = sorted({0, len(file), *cuts.tolist(), *range(0, len(file), COVERED)})
            for i, j in zip(cuts, cuts[1:]):
                lo, hi = np.searchsorted(row, [i, j])
                some, whose = keys[lo:hi], (row[lo:hi] - i).astype("<u2")
                runs = list(_dealt(some, buckets, ASKED))
                for n in range(0, len(runs), 2000):
                    part = runs[n:n + 2000]
                    yield _entry([r[0] for r in part], 1, int(file[i]), int(place[i]),
                                 [np.diff(whose[at], prepend=whose.dtype.type(0)).tobytes() for _, at in part],
                                 [some[at].tobytes() for _, at in part], [None] * len(part))

    return src.select("file", "at", "text").mapInArrow(run, _ENTRY)


def _table(keys: bytes, values: bytes):
    """The keys in order and a last one beyond, their values, where those of each run of leading bits begin, and the shift to these bits."""
    keys, values = np.frombuffer(keys, np.uint64), np.frombuffer(values, "<f8")
    order = np.argsort(keys)
    bits = len(keys).bit_length() + 1
    starts = np.searchsorted(keys[order], np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    return np.append(keys[order], ~np.uint64(0)), np.append(values[order], 0.0), starts, np.uint64(64 - bits)


def _found(table, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the keys the table has, and their values."""
    held, values, starts, shift = table
    at = starts[wanted >> shift]
    behind = np.flatnonzero(held[at] < wanted)
    while len(behind):
        at[behind] += 1
        behind = behind[held[at[behind]] < wanted[behind]]
    hit = np.flatnonzero((held[at] == wanted) & (at < len(held) - 1))
    return hit, values[at[hit]]


def _sums(batches):
    """What the n-grams found add to each row; a bucket's entries come before the requests to it."""
    bucket, rows, table = None, [], None
    for batch in batches:
        ids, asked = batch.column("bucket").to_numpy(), batch.column("asked").to_numpy()
        cuts = np.union1d(np.flatnonzero((np.diff(ids) != 0) | (np.diff(asked) != 0)) + 1, np.arange(ANSWERED, len(ids), ANSWERED))
        for part in np.split(np.arange(len(ids)), cuts):
            if not len(part):
                continue
            if ids[part[0]] != bucket:
                bucket, rows, table = ids[part[0]], [], None
            b = batch.slice(int(part[0]), len(part))
            keys = b.column("keys").to_pylist()
            if not asked[part[0]]:
                rows += zip(keys, b.column("found").to_pylist())
                continue
            if table is None:
                table, rows = _table(b"".join(k for k, _ in rows), b"".join(v for _, v in rows)), []
            hit, logs = _found(table, np.frombuffer(b"".join(keys), np.uint64))
            if not len(hit):
                continue
            sizes = np.array([len(x) // 8 for x in keys])
            of = np.cumsum(np.frombuffer(b"".join(b.column("of").to_pylist()), "<u2").astype(np.int64))
            before = np.concatenate([[0], of])[np.cumsum(sizes) - sizes]
            line = np.repeat(np.arange(len(sizes)), sizes)[hit]
            of = of[hit] - before[line]
            new = np.flatnonzero(np.diff(line * COVERED + of, prepend=-1))
            of, logs = of[new].astype("<u2"), np.add.reduceat(logs, new)
            lines, first = np.unique(line[new], return_index=True)
            ends = [*first[1:].tolist(), len(new)]
            yield pa.RecordBatch.from_arrays([
                pa.array(b.column("file").to_numpy()[lines]), pa.array(b.column("base").to_numpy()[lines]),
                pa.array([of[i:j].tobytes() for i, j in zip(first.tolist(), ends)], pa.binary()),
                pa.array([logs[i:j].tobytes() for i, j in zip(first.tolist(), ends)], pa.binary())],
                ["file", "base", "of", "logs"])


def _added(key: tuple, sums: pa.Table) -> pa.Table:
    """What was found for a run of rows, added up by row."""
    of = np.frombuffer(b"".join(sums.column("of").to_pylist()), "<u2")
    logs = np.bincount(of, np.frombuffer(b"".join(sums.column("logs").to_pylist()), "<f8"))
    rows = np.unique(of).astype(np.int64)
    return pa.table([pa.array(np.full(len(rows), key[0].as_py())), pa.array(rows + key[1].as_py()), pa.array(logs[rows])],
                    ["file", "at", "log"])


def _lengths(batches):
    for s in tx.slices(batches, 2):
        yield pa.RecordBatch.from_arrays([*(s.column(c) for c in ("file", "at", "doc_id", "lang")),
                                          pa.array(_hashes(s.column("text"))[1] + 1)], ["file", "at", "doc_id", "lang", "n_tokens"])


def perplexities_joined(src: DataFrame, docs: DataFrame, size: int = BUCKET) -> DataFrame:
    """(doc_id, lang, n_tokens, perplexity) of every row of (doc_id, text, lang), the model learned from all of ``docs`` (column text)."""
    entries, low = model_entries(docs, size)
    rows = placed(src.select("doc_id", "lang", "text"))
    found = []
    for k in range(low["passes"]):
        path = stage_path(src.sparkSession, "entries")
        held = staged(entries(k), "entries", path, "none")
        asked = _asked(rows, _filter(held, low["buckets"], size), k, low["passes"])
        found.append(staged(held.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", "asked").mapInArrow(
            _sums, "file bigint, base bigint, of binary, logs binary").groupBy("file", "base").applyInArrow(
            _added, "file bigint, at bigint, log double"), "sums"))
        drop(src.sparkSession, path)
    kind = src.schema["doc_id"].dataType.simpleString()
    every = rows.select("file", "at", "text", "doc_id", "lang").mapInArrow(
        _lengths, f"file bigint, at bigint, doc_id {kind}, lang string, n_tokens bigint")
    none = F.lit(None)
    parts = every.withColumn("log", F.lit(0.0))
    for f in found:
        parts = parts.unionByName(f.withColumns({"doc_id": none.cast(kind), "lang": none.cast("string"), "n_tokens": none.cast("bigint")}))
    logs = F.sum("log") + (F.max("n_tokens") - 1) * float(np.log(low["unknown"])) + low["stop"]
    return parts.groupBy("file", "at").agg(
        F.max("doc_id").alias("doc_id"), F.max("lang").alias("lang"), F.max("n_tokens").alias("n_tokens"),
        F.exp(-logs / F.max("n_tokens")).alias("perplexity")).drop("file", "at")


def quantiles(scored: DataFrame, share: float, own: int) -> DataFrame:
    """(lang, threshold): the least log-perplexity step that ``share`` of a language's rows do not pass.

    Languages with fewer than ``own`` rows take that of all rows (lang '' here).
    Histograms, so exact to a step whatever the partitioning.
    """
    steps = scored.select(F.explode(F.array(F.coalesce("lang", F.lit("?")), F.lit(""))).alias("lang"),
                          F.ceil(F.log("perplexity") / STEP).alias("step")).groupBy("lang", "step").count()
    w = Window.partitionBy("lang").orderBy("step")
    ranked = steps.select("lang", "step", F.sum("count").over(w).alias("upto"),
                          F.sum("count").over(Window.partitionBy("lang")).alias("n"))
    return ranked.where((F.col("upto") >= share * F.col("n")) & ((F.col("n") >= own) | (F.col("lang") == ""))).groupBy(
        "lang").agg(F.exp(F.min("step") * STEP).alias("threshold"))


def quality(docs: DataFrame, trusted: DataFrame, share: float = QUANTILE, max_words: int | None = None,
            max_docs: int | None = None, own: int = OWN, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang, n_tokens, perplexity, threshold, kept) of every row; ``trusted`` lists doc_ids.

    Null or empty text: the end alone is scored.  A null language is one of
    its own.  Repeated rows and null ids get a row each (a null id is never
    trusted); without trusted documents in the second half nothing is
    rejected.  Other columns are ignored; an empty table gives an empty result.
    The model learns from all trusted texts of the first half; a caller who
    sets ``max_words`` gets one of at most so many, in one broadcast.
    """
    src = docs.select(tx.col(id_col).alias("doc_id"), F.coalesce(tx.col(text_col), F.lit("")).alias("text"),
                      tx.col(lang_col).cast("string").alias("lang"))
    texts = training_texts(src, trusted, max_docs, max_words)
    scored = staged(perplexities_joined(src, texts) if max_words is None else perplexities(src, train(texts)), "perplexity")
    second = trusted.where(_half(F.col("doc_id")) == 1).select("doc_id").distinct()
    limits = staged(quantiles(scored.join(second, "doc_id", "left_semi"), share, own), "quantiles")
    overall = [r.threshold for r in limits.where("lang = ''").collect()]
    per_lang = limits.where("lang <> ''").select(F.col("lang").alias("of"), "threshold")
    out = scored.join(per_lang, F.coalesce("lang", F.lit("?")) == F.col("of"), "left").withColumn(
        "threshold", F.coalesce("threshold", F.lit(overall[0] if overall else float("inf"))))
    return out.select("doc_id", "lang", "n_tokens", "perplexity", "threshold",
                      (F.col("perplexity") <= F.col("threshold")).alias("kept"))
