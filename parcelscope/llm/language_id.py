"""Language ID by Bayesian evidence fusion.

Evidence of a text in language l:

* text: likelihood of its byte trigrams (hashed to ``TABLE`` cells), tempered to at most
  ``EFFECTIVE`` trigrams' worth; ``und`` is a model in which every cell is as likely;
* declared: P(declared language | l), how far declarations can be trusted;
* suffix: P(address suffix | l);
* host: P(l | host), smoothed towards its domain, which is smoothed towards the whole input.

The trigram model is trained, for every declared language, on a sample of about ``TRAIN_ROWS`` of the texts
that declare it (all, if there are fewer), however small its share of the rows.  Not modelled are languages whose texts have no
cell in common among ``MIN_TEXTS`` of them, and those beyond the ``MODELS`` most declared values (a model is 256 KB in
every task): a row that declares such a language keeps it where no modelled language is likelier than noise.  The other three come from grouped counts over all rows (of the
most likely language by text alone).  Rows meet the tables in equi-joins on small rows
(no texts), which adaptive execution can split; nothing is broadcast by hand.

``und`` (no known language is more likely than noise, given all evidence) is rejected.  Null
or empty texts have no text evidence and take their language from the rest.  Nulls in the other columns are a
value of their own.  Repeated rows each give a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, n_partitions, slices, tidy, without, written

TABLE = 1 << 16
TRAIN_ROWS = 8000  # texts of each declared language
EFFECTIVE = 60.0
HOST_PRIOR, DOMAIN_PRIOR, EVIDENCE_PRIOR = 10.0, 20.0, 5.0
UND = "und"
UND_PRIOR = 1e-3
MIN_TEXTS = 3
MODELS = 200  # languages that are modelled
SCORED_BYTES = 512 << 10  # text bytes scored at once
HELD = 64  # languages whose sums a training task holds at once

TAGS = re.compile(rb"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)
_FOLD = bytes.maketrans(bytes(range(65, 91)) + bytes(range(48, 58)) + b"\t\n\r\x0b\x0c", bytes(range(97, 123)) + b"0" * 10 + b" " * 5)


def _cells(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigram of every byte position, and where each text begins (three bytes at least)."""
    buf = b"".join(b" " + t.translate(_FOLD) + b"  " for t in texts)
    a = np.frombuffer(buf, np.uint8).astype(np.uint32)
    g = np.zeros(len(a), np.uint32)
    g[:-2] = (a[:-2] * np.uint32(0x9E3779B1) + a[1:-1] * np.uint32(0x85EBCA6B) + a[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(7)
    begins = np.cumsum([0] + [len(t) + 3 for t in texts[:-1]])
    return (g ^ (g >> np.uint32(13))) & np.uint32(TABLE - 1), begins


def _plain(kind: str, body: bytes | None) -> bytes:
    body = body or b""
    return TAGS.sub(b" ", body) if kind == "page" else body


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}  # occurrences, and texts that have the cell

    def held() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                          ["lang", "cells"])

    for b in batches:
        kinds, langs, bodies = (c.to_pylist() for c in b.columns)
        texts = [_plain(k, x) for k, x in zip(kinds, bodies)]
        for l, text in zip(langs, texts):
            if l not in total:
                if len(total) == HELD:
                    yield held()
                    total.clear()
                total[l] = np.zeros((2, TABLE), np.float32)
            seen = np.bincount(_cells([text])[0], minlength=TABLE)
            total[l][0] += seen
            total[l][1] += seen > 0
    if total:
        yield held()


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, cells): occurrences of the cells that enough texts have; what few texts have is theirs, not the language's."""
    total: dict[str, np.ndarray] = {}
    for b in batches:
        for l, c in zip(*[c.to_pylist() for c in b.columns]):
            total[l] = total.get(l, 0) + np.frombuffer(c, np.float32)
    for l, v in total.items():
        count, texts = v.reshape(2, TABLE)
        kept = np.where(texts >= MIN_TEXTS, count, 0).astype(np.float32)
        if kept.any():
            yield pa.RecordBatch.from_arrays([pa.array([l], pa.string()), pa.array([kept.tobytes()], pa.binary())], ["lang", "cells"])


def train(rows: DataFrame, sample_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and log P(cell | language), one row each, from a sample of each language chosen by hash."""
    seen = rows.filter("declared is not null").groupBy("declared").count().filter(F.col("count") >= MIN_TEXTS)
    seen = seen.orderBy(F.desc("count"), "declared").limit(MODELS)
    seen = {r["declared"]: r["count"] for r in seen.collect()}  # MODELS rows at most
    if not seen:
        return [], np.zeros((0, TABLE), np.float32)
    rate = {l: n // sample_rows for l, n in seen.items() if n >= 2 * sample_rows}
    every = F.lit(1)
    if rate:
        every = F.coalesce(F.create_map(*[F.lit(x) for pair in rate.items() for x in pair])[F.col("declared")], every)
    # the id is in the hash: a group of copies is sampled like other rows, not as a whole
    sample = rows.filter(F.col("declared").isin(list(seen))).filter(F.pmod(F.xxhash64("kind", "id", "body"), every) == 0)
    got = (sample.select("kind", "declared", "body").mapInArrow(tidy(_sums), "lang string, cells binary")
           .repartition(min(len(seen), n_partitions(rows.sparkSession)), "lang")
           .mapInArrow(tidy(_added), "lang string, cells binary").collect())  # one vector per language
    table = {r["lang"]: np.frombuffer(r["cells"], np.float32) for r in got}
    languages = sorted(table)
    logs = [np.log((table[l] + 0.05) / (table[l].sum() + 0.05 * TABLE)) for l in languages]
    return languages, np.array(logs, np.float32).reshape(len(languages), TABLE)


def _scored(logs: np.ndarray):
    uniform = np.float64(-np.log(TABLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            keep = [b.column(i) for i in range(b.num_columns - 1)]
            kinds = b.column(0).to_pylist()
            texts = [_plain(k, x) for k, x in zip(kinds, b.column(b.num_columns - 1).to_pylist())]
            scores = []
            for (part,) in chunks(texts, limit=SCORED_BYTES):
                cells, begins = _cells(part)
                n = np.array([len(t) + 1 for t in part], np.float64)
                per = np.stack([np.add.reduceat(row[cells].astype(np.float64), begins) for row in logs] + [n * 0], axis=1)
                per[:, -1] = uniform * (n + 2)
                has = np.array([len(t.strip()) > 0 for t in part])
                per *= (has * np.minimum(1.0, EFFECTIVE / n))[:, None]
                scores += per.tolist()
            yield pa.RecordBatch.from_arrays([*keep, pa.array(scores, pa.list_(pa.float64()))], [*b.schema.names[:-1], "text_ll"])
    return run


def _smoothed(counts: DataFrame, key: str, n: int, parent: Column, strength: float, out: str) -> DataFrame:
    """(key, out): array of (count + strength * parent) / (total + strength)."""
    total = F.aggregate("c", F.lit(0.0), lambda a, x: a + x)
    return counts.withColumn(out, F.zip_with("c", parent, lambda x, p: (x + strength * p) / (total + strength)))


def identify(rows: DataFrame) -> DataFrame:
    """rows (kind, id, body, declared, host, suffix) -> kind, id, lang, probability, kept.

    ``kind`` is ``page`` (body is html) or anything else (body is text).
    """
    rows = rows.select("kind", "id", F.coalesce("declared", F.lit("")).alias("d"), F.coalesce("host", F.lit("")).alias("h"),
                       F.coalesce("suffix", F.lit("")).alias("s"), F.when(F.col("declared") != "", F.col("declared")).alias("declared"),
                       F.col("body").cast("binary").alias("body"))
    languages, logs = train(rows.select("kind", "id", "declared", "body"))
    names = [*languages, UND]
    n = len(names)
    scored = written(rows.select("kind", "id", "d", "h", "s", "body").mapInArrow(
        tidy(_scored(logs)), "kind string, id long, d string, h string, s string, text_ll array<double>"), "lang")
    best = F.array_position("text_ll", F.array_max("text_ll")).cast("int")
    votes = scored.withColumn("best", best)
    one_hot = [F.sum((F.col("best") == i + 1).cast("double")) for i in range(n)]
    domain = F.regexp_extract("h", r"([^.]+\.[^.]+)$|^([^.]*)$", 0)

    def counted(key: Column) -> DataFrame:
        return votes.groupBy(key.alias("k")).agg(F.array(*one_hot).alias("c"))

    every = votes.agg(F.array(*one_hot).alias("c")).first()["c"]  # n numbers
    every = [x or 0.0 for x in every]
    all_rows = sum(every) + n
    glob = F.array(*[F.lit(UND_PRIOR if l == UND else (x + 1) / all_rows) for l, x in zip(names, every)])
    domains = _smoothed(counted(domain), "k", n, glob, DOMAIN_PRIOR, "pd").select(F.col("k").alias("dom"), "pd")
    hosts = votes.groupBy(F.col("h"), domain.alias("dom")).agg(F.array(*one_hot).alias("c")).join(domains, "dom")
    hosts = _smoothed(hosts, "h", n, F.col("pd"), HOST_PRIOR, "ph").select("h", "ph")

    def evidence(key: str, out: str) -> DataFrame:
        """P(value | language): by language, smoothed over the values seen."""
        c = counted(F.col(key))
        values = max(1, c.count())
        return c.select(F.col("k").alias(key), F.zip_with("c", F.array(*[F.lit(float(x)) for x in every]), lambda x, t: (
            x + EVIDENCE_PRIOR / values) / (t + EVIDENCE_PRIOR)).alias(out))

    joined = scored.join(hosts, "h").join(evidence("d", "ed"), "d").join(evidence("s", "es"), "s")
    logp = F.zip_with(F.zip_with("text_ll", "ph", lambda a, b: a + F.log(b)), F.zip_with("ed", "es", lambda a, b: F.log(a) + F.log(b)),
                      lambda a, b: a + b)
    joined = joined.withColumn("lp", logp).withColumn("m", F.array_max("lp"))
    rest = F.aggregate("lp", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("m")))
    lang = F.element_at(F.array(*[F.lit(x) for x in names]), F.array_position("lp", F.col("m")).cast("int"))
    lang = F.when((lang == UND) & (F.col("d") != "") & ~F.col("d").isin(names), F.col("d")).otherwise(lang)  # a language without a model
    return joined.select("kind", "id", lang.alias("lang"), (1 / rest).alias("probability"), (lang != UND).alias("kept"))


def document_rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("id"), F.col("text").alias("body"),
                            F.lower("lang").alias("declared"), F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix"))


def page_rows(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract("url", r"://([^/?#:]*)", 1))
    declared = F.lower(F.regexp_extract("html", r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return pages.select(F.lit("page").alias("kind"), F.col("page_id").cast("long").alias("id"), F.col("html").alias("body"),
                        declared.alias("declared"), host.alias("host"), F.regexp_extract(host, r"([^.]*)$", 1).alias("suffix"))


def keep_identified(documents: DataFrame) -> DataFrame:
    """Documents in a known language; columns kept."""
    gone = identify(document_rows(documents)).filter("not kept and id is not null").select(F.col("id").alias("doc_id")).distinct()
    return without(documents, gone)
