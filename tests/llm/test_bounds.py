"""Bounds that hold whatever repeats: the language sample, and blocks of equal documents in the mix."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute as B  # noqa: E402

from tidemark.llm import language, mixing, queries  # noqa: E402

@pytest.mark.parametrize("rows", [2_000, 20_000])
@pytest.mark.parametrize("texts", [1, 400])
def test_language_sample_of_one_id(spark, rows, texts):
    """Many rows of one id, of one text or of several: no more than the documented sample."""
    docs = spark.range(rows).select(F.lit(3).cast("long").alias("doc_id"), F.when(F.col("id") % 2 == 0, "en").otherwise("pt").alias("lang"),
                                    F.concat(F.lit("a text of its own "), (F.col("id") % texts).cast("string")).alias("text"))
    got = language.sample(docs, "doc_id", "text", "lang", lambda k: k.isNotNull()).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in got} == dict.fromkeys(("en", "pt"), min(max(texts // 2, 1), language.TRAIN))


def test_language_sample_is_bounded_in_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGS", 3)
    monkeypatch.setattr(language, "TRAIN", 4)
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.format_string("l%03d", F.floor(F.sqrt("id"))).alias("lang"), F.lit("word").alias("text"))
    got = language.sample(docs, "doc_id", "text", "lang", lambda k: k.isNotNull()).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in got} == {"l027": 4, "l028": 4, "l029": 4}


def test_languages_with_repeated_ids(spark):
    docs = spark.createDataFrame([(i % 5, t, x) for i in range(300) for t, x in
                                  (("das ist ein kurzer satz und nicht mehr", "de"), ("this is a short line and nothing else", "en"))],
                                 "doc_id long, text string, lang string")
    got = language.identify(docs, learn=lambda k: k.isNotNull())
    assert {(r["lang_pred"]) for r in got.collect()} == {"de", "en"} and got.count() == 600


def test_equal_documents_are_told_apart(spark):
    docs = spark.range(5_000).select(F.when(F.col("id") < 4, F.col("id")).alias("doc_id"), F.lit("s").alias("source"), F.lit(9).cast("long").alias("size"),
                                     F.concat(F.lit("f"), F.col("id") % 7).alias("f"))
    got = mixing.numbered(docs, "f")
    assert sorted(r["copy"] for r in got.where("doc_id IS NULL").collect()) == list(range(4996))
    assert [r["copy"] for r in got.where("doc_id IS NOT NULL").collect()] == [0] * 4


def test_mix_of_equal_documents(spark):
    """A source whose rows are all alike is taken to its target, alike on every run."""
    rows = [(None, "a b c", "s")] * 600 + [(i, "a b c d", "t") for i in range(300)] + [(1, "x y", "t")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    want = B.targets({"s": 1800, "t": 1300})
    for s in "st":
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - want[s]) <= 4
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))


@pytest.mark.parametrize("sf, share", [("sf0.001", None), ("sf0.01", 0.005)])
def test_mix_reaches_every_target(spark, sf, share):
    """Per source: off by less than half its median document, for ten documents a source; by 0.5% for a hundred."""
    size, taken = {}, {}
    for r in queries.QUERIES["op1_mixing"](spark, f"/root/testdata/{sf}").collect():
        size.setdefault(r["source"], []).append(r["size"])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in B.targets({s: sum(v) for s, v in size.items()}).items():
        assert abs(taken[s] - t) <= (share * t if share else sorted(size[s])[len(size[s]) // 2] / 2), s
