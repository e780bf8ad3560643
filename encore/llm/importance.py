"""Quality rules by importance: hashed n-gram log-likelihood ratio of trusted text against the whole corpus.

Unigrams and bigrams of a text's word and punctuation tokens are hashed to a
fixed number of buckets.  Two add-one multinomials over the buckets, one of
the trusted documents and one of all documents, give each bucket a log ratio;
a document's score is the mean ratio of its n-grams and a fixed threshold
decides.  A few counted rules come first.  DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx

#: Buckets of the hashed n-grams: the size of all that is counted or sent out.
BUCKETS = 10_000
#: Mean log ratio below which a document goes.
THRESHOLD = -0.05
#: Fixed values of the contract: counted symbols, window length.
SYMBOLS, WINDOW = "#*$%&|<>", 8

_TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), 0)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, tx.SPACE), "")


def ngram_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all unigrams, then of all bigrams (the last token pairs with the end)."""
    hashes = F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), lambda t: F.xxhash64(t))
    return _let(hashes, lambda h: F.concat(
        F.transform(h, lambda x: F.pmod(x, F.lit(buckets))),
        F.transform(h, lambda x, i: F.pmod(F.xxhash64(x, F.get(h, i + 1)), F.lit(buckets)))))


def repeated_words(ws: Column, window: int = WINDOW) -> Column:
    """Words covered by the windows that occur twice or more, in sort time of the text's length."""
    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = _let(placed, lambda p: F.filter(p, lambda x, i: (
            F.coalesce(F.get(p, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False)))))
        at = F.sort_array(F.transform(repeated, lambda x: x["i"]))
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")),
                           lambda s, i: F.struct((s["n"] + F.least(F.lit(window), i - s["last"])).alias("n"),
                                                 i.alias("last")),
                           lambda s: s["n"])

    starts = F.when(F.size(ws) >= window, F.sequence(F.lit(0), F.size(ws) - window)).otherwise(
        F.array().cast("array<int>"))
    hashes = _let(F.transform(ws, lambda w: F.xxhash64(w)), lambda h: F.transform(
        starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])))
    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def base_rules(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed to (doc_id, text)."""
    text, blank = F.col("text"), " \t\n\x0b\x0c\r"
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, blank, "")) > 0)
    return docs.withColumn("ws", words(text)).select(
        "doc_id", "text",
        F.size("ws").cast("bigint").alias("n_words"),
        F.length(F.translate(text, blank, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("ws")).cast("bigint").alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """Each bucket's log ratio; all documents count for the raw side, ``trusted`` (doc_id) for the target side.

    The counts come from one pass that sends at most ``buckets`` rows per
    task.  Both sides grow with the corpus, so the plan is a sort-merge join at
    every size: each text moves once, on any number of documents.
    """
    ids = trusted.where(F.col("doc_id").isNotNull()).select("doc_id").distinct().withColumn(
        "target", F.lit(1)).hint("merge")
    counts = (docs.join(ids, "doc_id", "left")
              .select(F.explode(ngram_buckets(F.col("text"), buckets)).alias("bucket"), "target")
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("target").alias("target")).collect())
    raw, target = [1] * buckets, [1] * buckets
    for r in counts:
        raw[r.bucket], target[r.bucket] = r.raw + 1, r.target + 1
    n_raw, n_target = sum(raw), sum(target)
    return [round(math.log(t / n_target) - math.log(r / n_raw), 12) for t, r in zip(target, raw)]


def score(text: Column, ratios: list[float]) -> Column:
    """Mean log ratio of a text's n-grams, 0 for a text without any."""
    table = F.split(F.lit(" ".join(map(repr, ratios))), " ").cast("array<double>")  # folded to one constant
    return _let(ngram_buckets(text, len(ratios)), lambda g: F.when(F.size(g) == 0, F.lit(0.0)).otherwise(
        F.aggregate(g, F.lit(0.0), lambda s, b: s + F.get(table, b.cast("int"))) / F.size(g)))


def quality(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counted rules, llr and kept of every document; ``trusted`` lists trusted documents by doc_id.

    Null or empty text: no words, so base_failed and not kept.  Repeated rows
    and null ids get a row each (a null id is never trusted).  No trusted
    document leaves every ratio near the raw corpus' own, with the same rule.
    Other columns are ignored; an empty table gives an empty result.
    """
    src = tx.id_text(docs, id_col, text_col)
    ratios = log_ratios(src, trusted, buckets)
    scored = base_rules(src).withColumn("llr", score(F.col("text"), ratios)).drop("text")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def kept_documents(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`quality` keeps; for the decision no text is joined.

    Null and empty texts have under twenty words and go; repeated rows go or
    stay alike, with or without an id; texts of any length are judged whole.
    An empty table gives an empty result.
    """
    ratios = log_ratios(tx.id_text(docs, id_col, text_col), trusted, buckets)
    text = F.coalesce(tx.col(text_col), F.lit(""))
    fair = _let(words(text), lambda ws: (F.size(ws) >= 20) & (100 * repeated_words(ws) <= 30 * F.size(ws)))
    return docs.where(fair & (score(text, ratios) >= threshold))
