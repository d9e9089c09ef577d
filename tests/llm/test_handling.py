"""Repeated rows, null ids, empty tables and clashing columns, for every operator and the pipeline."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from parcelscope.llm import chat, decontaminate, html_extract, language_id, order_minhash, packing, substring_dedup, url_filter

TEXT = " ".join(f"w{i % 53}" for i in range(400))
ROWS = [(1, TEXT), (1, TEXT), (2, "short text here"), (2, "another text"), (None, TEXT + " end"), (None, "no id at all"), (None, "no id at all"),
        (3, None), (4, ""), (5, "x " * 3000)]
SCHEMA = "doc_id long, text string, key string, word string, piece int, start int, uid long, block int, n int, pos int, codes int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "k", "w", 1, 2, 3, 4, 5, 6, 7) for r in ROWS], SCHEMA)


def test_packing_keeps_every_row(docs):
    got = packing.pack(docs).collect()
    t = Tokenizer.from_file(packing.default_vocabulary())
    want = []
    for i, text in ROWS:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((str(i), len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)) if len(ids) <= packing.CAPACITY else None))
    whole = [(str(r.doc_id), r.length, r.ids_crc32) for r in got if r.doc_id != 5]
    assert sorted(whole, key=str) == sorted([w for w in want if w[0] != "5"], key=str)
    assert sum(r.length for r in got if r.doc_id == 5) == next(w[1] for w in want if w[0] == "5")
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_fingerprints_of_repeated_rows_and_null_ids(docs):
    got = order_minhash.fingerprint_pairs(docs).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(v) == 1 for v in by.values())  # equal texts, equal fingerprints
    assert sorted(r.n_chars for r in got) == sorted(len(t or "") for _, t in ROWS)


def test_decontamination_of_repeated_rows_and_null_ids(spark, docs):
    bench = spark.createDataFrame([(1, " ".join(f"w{i % 53}" for i in range(10, 25)))], "item_id long, text string")
    got = decontaminate.digest(decontaminate.contaminated_words(docs, bench)).collect()
    assert len(got) == len(ROWS)
    assert sorted(str(r.doc_id) for r in got if r.contaminated) == ["1", "1", "None"]
    assert len({(r.n_words, r.n_hit) for r in got if r.doc_id == 1}) == 1
    clean = decontaminate.decontaminate(docs, bench)
    # both rows of id 1 go; those without an id stay, as they cannot be named
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, _ in ROWS if i != 1)


def test_substring_dedup_and_languages_give_every_row(docs):
    assert substring_dedup.remove_repeats(docs).count() == len(ROWS)
    rows = language_id.document_rows(docs.withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string")))
    assert language_id.identify(rows).count() == len(ROWS)


def test_urls_of_repeated_rows_and_null_ids(spark):
    rows = [(1, "http://a.org/x"), (1, "http://a.org/x"), (None, "http://b.com/de/1"), (None, None), (2, "")]
    pages = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, host string, verdict string")
    labels = spark.createDataFrame([(1, 0), (None, 1)], "url_id long, bad int")
    got = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in url_filter.filter_urls(pages, labels).collect())
    assert got == sorted([("1", "a.org", "/x", "org/", "allow")] * 2 + [("None", "b.com", "/de/1", "com/de/", "block"),
                         ("None", "", "", "None", "allow"), ("2", "", "", "None", "allow")])


def test_chat_of_null_ids_and_a_long_conversation(spark):
    rows = [(None, 0, "user", "hi"), (None, 1, "assistant", "<|im_end|> & <|x|>"), (None, 1, "assistant", None)]
    rows += [(7, i, "user" if i % 2 == 0 else "assistant", f"turn {i}\n" * 3) for i in range(400)]
    df = spark.createDataFrame([(*r, "f", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, example int")
    got = {r.conv_id: r for r in chat.read_back(chat.format_examples(df)).collect()}
    for conv in (None, 7):
        turns = sorted([(t, r, x or "") for c, t, r, x in rows if c == conv])
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[conv].n_turns == len(turns) and got[conv].loss_chars == len(loss)
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
    assert chat.read_back(chat.format_examples(df.filter("false"))).count() == 0


def test_html_of_repeated_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>One text here.</p></article>")] * 2 + [(None, None, None)], "page_id long, url string, html string")
    assert sorted(r.text for r in html_extract.extract(pages).collect()) == ["", "One text here.", "One text here."]


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars int"


def _lake(spark, path, rows, extra=()):
    df = spark.createDataFrame(rows, DOCUMENTS)
    for c in extra:
        df = df.withColumn(c, F.lit("mine"))
    df.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return path


def test_pipeline_of_nulls_and_clashing_columns(spark, tmp_path):
    base = " ".join(f"the word number{i} of this text" for i in range(40))
    rows = [(i, f"{base} {i}", "en", "s", 1) for i in range(3)] + [(10 + i, " ".join(f"plain{(i * 31 + k) % 97}" for k in range(60)), "en", "s", 1) for i in range(20)]
    rows += [(50, None, None, None, None), (51, "", "en", "s", 0), (52, "mail me at a.b@c.org or 10.0.0.7 soon " + base[:80], "en", "s", 1),
             (53, "zero one two three four five six seven eight nine ten eleven twelve", "en", "s", 1), (60, rows[5][1], "en", "s", 1), (60, rows[5][1], "en", "s", 1)]
    extra = ("pii", "_t", "key", "root", "gone", "t", "row", "kind", "verdict")
    docs = spark.read.parquet(f"{_lake(spark, str(tmp_path), rows, extra)}/documents.parquet")
    kept, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns, name
        seen[name] = {r.doc_id: r for r in kept.collect()}
    last = seen["pii"]
    assert 53 not in last and sum(i in last for i in (0, 1, 2)) == 1
    assert last[52].text.startswith("mail me at <EMAIL> or <IP> soon") and last[52].n_chars == len(last[52].text)
    assert all(r[c] == "mine" for r in last.values() for c in extra)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(last)
    t = Tokenizer.from_file(packing.default_vocabulary())
    for r in packed:  # what is packed are the redacted texts
        ids = [*t.encode(last[r.doc_id].text or "", add_special_tokens=False).ids, 0]
        assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, _lake(spark, str(tmp_path), [])).count() == 0
