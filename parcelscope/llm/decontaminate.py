"""Benchmark decontamination: prefix-filtered containment join (DataFrame functions only).

Every benchmark item is cut into windows of ``WINDOW`` consecutive words (one
window if it has fewer).  A document contains a window only if it contains all
of its words, so by the prefix principle (overlap needed = length, prefix = 1)
it must contain the window's rarest word.  Words are ordered by their frequency
over the whole corpus; only occurrences of such prefix words are joined.  The
length bound (the document has room for the window around that position) and
the positional bound (the word stands at its own place in the window) leave
candidates, which are verified word for word over the item-sized window.

Nulls and texts without words have no words and no hits.  The benchmark side is
broadcast only after its bytes have been counted (``BROADCAST_BYTES``).  Beyond
that the planner shuffles: word counts are combined before their join, and an
occurrence carries the words that a window around it can reach, never its whole
document.
Repeated document rows each give a row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, without, written

WINDOW = 10
BROADCAST_BYTES = 64 << 20  # upper bound of what the vocabulary or the prefix index holds
# Java: ASCII outside 0-9, a-z, A-Z; one by one, as a class of single characters is looked up in a table, one of ranges tested range by range
SEPARATOR = "[" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"


def _words(text: Column) -> Column:
    """Words as written (capitals kept; lowered one by one where they are used)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR), "")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: window_id, words, items (sorted ids as strings)."""
    b = benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                         _words(F.col("text")).alias("w")).withColumn("w", F.transform("w", lambda w: ascii_lower(w)))
    b = b.filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    b = b.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words"))
    return b.groupBy("words").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def _held_bytes(windows: DataFrame) -> int:
    """Upper bound of the bytes of all window words, texts and item lists, with 40 a word or item for its row."""
    held = F.sum(F.octet_length(F.array_join("words", " ")) + F.octet_length(F.array_join("items", " "))
                 + 40 * (F.size("words") + F.size("items")))
    return windows.agg(held.alias("held")).first()["held"] or 0


def contaminated_words(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, items (array of string), contaminated."""
    rows = documents.select("doc_id", "text")
    windows = written(item_windows(benchmark, window), "windows")
    fits = _held_bytes(windows) <= BROADCAST_BYTES
    small = F.broadcast if fits else (lambda d: d)

    texts = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("rid"), _words(F.col("text")).alias("words"))
    texts = texts.select("doc_id", "rid", "words", F.size("words").alias("n_words"))

    def occurrences(extra: list[str]) -> DataFrame:
        w = texts.select(*extra, F.posexplode("words").alias("pos", "word"))
        return w.withColumn("word", ascii_lower(F.col("word")))

    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    counted = occurrences([]).select("word")
    if fits:
        seen = counted.join(small(vocabulary), "word").groupBy("word").agg(F.count("*").alias("freq"))
    else:
        seen = counted.groupBy("word").agg(F.count("*").alias("freq")).join(vocabulary, "word")
    # the rarest word of each window (ties: the word itself), with its first place in the window
    ranked = (windows.select("words", "items", F.posexplode("words").alias("at", "word"))
              .join(seen, "word"))  # a word that no document has: the window cannot occur
    per = ranked.groupBy("words", "items").agg(
        F.min(F.struct("freq", "word", "at")).alias("m"), F.count("*").alias("found"))
    index = written(per.filter(F.col("found") == F.size("words"))
                    .select(F.col("m.word").alias("word"), F.col("m.at").alias("at"), F.size("words").alias("size"),
                            F.array_join("words", " ").alias("window"), "items"), "prefix")

    # ``here`` is the word's place in ``words``: the whole document, or the reach of a window around it
    around = occurrences(["doc_id", "rid", "words"])
    if fits:
        around = around.withColumn("here", F.col("pos"))
    else:
        around = around.select(
            "doc_id", "rid", "pos", "word", F.least("pos", F.lit(window - 1)).alias("here"),
            F.slice("words", F.greatest(F.col("pos") - (window - 1), F.lit(0)) + 1, 2 * window - 1).alias("words"))
    cand = around.join(small(index), "word")
    begin, start, size = F.col("here") - F.col("at"), F.col("pos") - F.col("at"), F.col("size")
    # positional and length bounds, then the words themselves (no lambda here: the explode and
    # the join stay in one generated loop, and a document's words are copied for matches only)
    there = F.slice("words", F.greatest(begin, F.lit(0)) + 1, size)
    cand = cand.filter((begin >= 0) & (begin + size <= F.size("words"))
                       & (ascii_lower(F.array_join(there, " ")) == F.col("window")))
    found = (cand.select("doc_id", "rid", start.alias("start"), (start + size).alias("stop"), "items")
             .groupBy("doc_id", "rid").agg(
                 F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda acc, s: F.struct((acc.n + F.greatest(F.lit(0), s.stop - F.greatest(s.start, acc.upto))).alias("n"),
                                F.greatest(acc.upto, s.stop).alias("upto")),
        lambda acc: acc.n)
    found = found.select(F.col("doc_id").alias("hit_id"), F.col("rid").alias("hit_rid"), covered.cast("long").alias("n_hit"), "items")
    out = texts.select("doc_id", "rid", F.col("n_words").cast("long").alias("n_words")).join(
        found, F.col("rid").eqNullSafe(F.col("hit_rid")) & F.col("doc_id").eqNullSafe(F.col("hit_id")), "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def digest(result: DataFrame) -> DataFrame:
    return result.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without any benchmark window; all columns kept.

    A document goes if one of the item windows occurs in it; null doc_ids are kept.
    """
    bad = contaminated_words(documents, benchmark, window).filter("contaminated").select("doc_id").distinct()
    return without(documents, bad)
