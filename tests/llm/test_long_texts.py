"""One very long text among short ones, for the operators whose own tests have none."""

import math

from pyspark.sql import functions as F

from encore.llm import bm25, chat, importance, kneser_ney

WORDS = [f"w{k}" for k in range(200_000)]
LONG = " ".join(WORDS) + "\n" + " ".join(WORDS[:80])


def test_quality_counts_a_long_text_whole(spark):
    df = spark.createDataFrame([(1, LONG), (2, "short text")], "doc_id bigint, text string")
    r = importance.quality(df, df.where("doc_id = 1").select("doc_id")).where("doc_id = 1").first()
    assert (r.n_words, r.n_repeat_words, r.n_dup_lines, r.base_failed) == (200_080, 160, 0, False)
    assert importance.kept_documents(df, df.select("doc_id")).select("doc_id").collect()[0][0] == 1


def test_an_item_at_the_end_of_a_long_text(spark):
    item = "which river runs past the old mill near the bridge at night. the green river does so every single day."
    df = spark.createDataFrame([(1, LONG + " " + item), (2, LONG), (3, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    assert [r.doc_id for r in bm25.contamination(df, items).collect()] == [1]
    assert sorted(r.doc_id for r in bm25.decontaminated(df, items).collect()) == [2, 3]
    assert bm25.decontaminated(df, items.limit(0)).count() == 3 and bm25.decontaminated(df.limit(0), items).count() == 0


def test_a_long_turn(spark):
    rows = [(1, 0, "user", LONG), (2, 0, "user", LONG), (2, 1, "bot", "x")]
    (r,) = chat.maximal_conversations(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")).collect()
    assert r.conv_id == 2 and r.n_turns == 2 and len(r.text) == len(LONG) + len("<|user|>\n\n<|bot|>\nx\n")


def test_perplexity_of_a_long_text(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a b c d e f g").alias("text"), F.lit("en").alias("lang"))
    df = docs.unionAll(spark.createDataFrame([(99, LONG, "en")], docs.schema))
    r = kneser_ney.quality(df, docs.select("doc_id")).where("doc_id = 99").first()
    assert r.n_tokens >= 200_080 and math.isfinite(r.perplexity)
