"""Languages without a model of their own: declared by one or two rows, or beyond the number of models."""

import random

from pyspark.sql import functions as F

from parcelscope.llm import language_id as L


def _words(rng, letters, n=60):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(n))


def test_rare_and_dirty_declarations_are_believed_where_text_says_nothing(spark):
    rng = random.Random(2)
    rows = [(i, _words(rng, "abcdeilmnors"), "en", "s") for i in range(60)] + [(100 + i, _words(rng, "автоншикелр"), "ru", "s") for i in range(60)]
    rows += [(200, _words(rng, "一二三四五六七八"), "zh", "s"), (201, _words(rng, "אבגדהוזחטי"), "he", "s"), (202, None, "he", "s")]
    rows += [(300 + i, _words(rng, "abcdeilmnors"), f"dirty-{i}", "s") for i in range(20)]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, lang string, source string").withColumn("declared", F.lit("x"))
    got = {r.id: r for r in L.identify(L.document_rows(docs)).collect()}
    assert got[200].lang == "zh" and got[201].lang == "he" and got[200].kept and got[201].kept
    assert all(got[i].lang == "en" for i in range(60)) and all(got[100 + i].lang == "ru" for i in range(60))
    assert all(got[300 + i].lang == "en" for i in range(20))
    assert L.keep_identified(docs).count() == len(rows) + 3  # repeated rows each stay


def test_many_declared_values_need_a_bounded_number_of_models(spark, monkeypatch):
    monkeypatch.setattr(L, "MODELS", 5)
    rng = random.Random(3)
    rows = [(i, _words(rng, "abcdeilmnors", 20), "en", "s") for i in range(40)]
    rows += [(1000 + 3 * k + j, _words(rng, chr(0x4E00 + 40 * k) + chr(0x4E01 + 40 * k) + chr(0x4E02 + 40 * k), 20), f"l{k:03}", "s")
             for k in range(60) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    languages, logs = L.train(L.document_rows(docs).withColumn("body", F.col("body").cast("binary")))
    assert len(languages) <= 5 and "en" in languages and len(logs) == len(languages)
    got = {r.id: r for r in L.identify(L.document_rows(docs)).collect()}
    assert all(r.kept for r in got.values())
    assert sum(got[1000 + 3 * k + j].lang == f"l{k:03}" for k in range(60) for j in range(3)) >= 0.9 * 180
