"""Thresholds of all held-out documents; line filters with room for the batches to come."""

from pyspark.sql import functions as F

from repolens.llm import langid, lines


def test_thresholds_count_every_held_out_document(spark, monkeypatch):
    ids = [i for i, in spark.range(12_000).filter(langid.held_out(F.col("id"))).collect()]
    rows = [(i, f"a text of some length, {i}", "x") for i in ids] + [(i, "odd one", "x") for i in ids[:40]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    least = "a text of some length, " + str(ids[-1])
    score = F.when(F.col("text") == least, 0.1).when(F.col("text") == "odd one", 0.05).otherwise(0.9)
    monkeypatch.setattr(langid, "predict", lambda df, model, text="text": df.withColumn("lang_pred", F.lit("x")).withColumn("score", score))
    got = langid.thresholds(docs, langid.train([b"ab", b"cd"], ["x", "y"], steps=1))
    assert got[3] == langid.ASKED * 0.05  # texts of seven bytes and more
    assert got[4] == got[5] == langid.ASKED * 0.1  # longer ones: one of some thousands has the lowest score
    assert langid.thresholds(docs.limit(0), langid.train([b"ab"], ["x"])) == [0.0] * 40


def test_filters_have_room_for_the_batches_to_come(spark, monkeypatch):
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.format_string("line %d of document %d", i, F.col("doc_id"))), "\n")
    docs = spark.range(140).select(F.col("id").alias("doc_id")).withColumn("text", text)
    built, build = [], lines.build_filters
    monkeypatch.setattr(lines, "build_filters", lambda *a: built.append(1) or build(*a))
    assert lines.dedup(docs).filter("n_dropped = 0 and n_lines = 100").count() == 140
    assert len(built) == 1
