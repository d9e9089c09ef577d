"""Document fingerprints by order MinHash (DataFrame functions only).

A text's k-mers are runs of ``K`` words (between spaces and line feeds; a shorter text is
one k-mer), numbered by occurrence.  The ``SELECTED`` minimal occurrence-numbered k-mers are dealt
to ``BINS`` bins by hash; the two minimal ones of a bin are put back into text order and
hashed as a tuple: one entry of the signature.  Moving a passage changes the order
inside tuples, so the share of equal entries falls with edit distance and
not only with the overlap of the k-mer sets.

Priority of an occurrence is the hash of (k-mer, occurrence number) as one item, so a repeated
k-mer's occurrences are spread over all priorities and bins.  One sort of packed (hash of the
k-mer | position) integers numbers the occurrences, a second one of (item | position) orders them.

The fingerprint is ``BINS`` groups of four characters (hex; ``....``: an empty bin).
Likeness = equal entries / bins filled in either (1.0 if both have none).  Null
texts are empty.  Any text length works: a string of Spark's has fewer than 2**30 words, the places there are.  Repeated rows and
ids each keep their row; equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 2
BINS = 64
SELECTED = 256
BIN_BITS, HASH_BITS, POS_BITS = 6, 33, 30  # the last two 63 together; the bin is the low bits of the hash
PARTS = 6  # bits: ranges that the rows of one frequent key (or without one) are dealt to
LOW_HASH, LOW_POS = (1 << HASH_BITS) - 1, (1 << POS_BITS) - 1
EMPTY = -1


def _with_codes(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the signature of a non-null text column: an array of BINS ints, EMPTY where a bin is empty."""
    w, k, s = f"_{out}_w", f"_{out}_k", f"_{out}_s"
    df = df.withColumn(w, F.array_remove(F.split(F.replace(F.col(text), F.lit("\n"), F.lit(" ")), " "), ""))
    pos = lambda i: i.cast("long").bitwiseAND(F.lit(LOW_POS))
    pack = lambda x, i: F.shiftleft(x.bitwiseAND(F.lit(LOW_HASH)), POS_BITS).bitwiseOR(pos(i))
    # every k-mer occurrence as (hash | position); equal hashes sort by occurrence
    kmers = F.when(F.size(w) >= K, F.transform(F.slice(w, 1, F.size(w) - (K - 1)),
                                               lambda a, i: pack(F.xxhash64(a, F.get(w, i + 1)), i))
                   ).otherwise(F.transform(w, lambda a, i: pack(F.xxhash64(a), i)))
    df = df.withColumn(k, F.sort_array(kmers))
    kmer = lambda x: F.shiftright(x, POS_BITS)
    again = lambda x, i: (i > 0) & (kmer(x) == kmer(F.get(k, i - 1)))
    goes_on = lambda x, i: F.coalesce(kmer(x) == kmer(F.get(k, i + 1)), F.lit(False))
    # the first occurrence's item is the k-mer's hash; those of the others are hashed from it and their number
    firsts = F.filter(k, lambda x, i: ~again(x, i))
    begins = F.array_compact(F.transform(k, lambda x, i: F.when(goes_on(x, i) & ~again(x, i), i)))
    ends = F.array_compact(F.transform(k, lambda x, i: F.when(again(x, i) & ~goes_on(x, i), i)))
    others = F.flatten(F.zip_with(begins, ends, lambda a, b: F.transform(
        F.slice(k, a + 2, b - a), lambda x, n: pack(F.xxhash64(kmer(x), n + 1), x))))
    items = F.concat(firsts, others)
    least = F.slice(F.sort_array(items), 1, SELECTED)
    # bin | rest of the hash | position, and one sentinel that closes each bin
    to_bin = lambda x: F.shiftleft(F.shiftright(x, POS_BITS).bitwiseAND(F.lit(BINS - 1)), HASH_BITS - BIN_BITS).bitwiseOR(
        F.shiftright(x, POS_BITS + BIN_BITS))
    binned = F.transform(least, lambda x: F.shiftleft(to_bin(x), POS_BITS).bitwiseOR(x.bitwiseAND(F.lit(LOW_POS))))
    shift = HASH_BITS - BIN_BITS + POS_BITS
    sentinel = lambda b: F.shiftleft(b.cast("long"), shift).bitwiseOR(F.lit((1 << shift) - 1))
    closing = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), sentinel)
    df = df.withColumn(s, F.sort_array(F.concat(binned, closing)))
    is_end = lambda x: x.bitwiseAND(F.lit((1 << shift) - 1)) == (1 << shift) - 1
    bin_of = lambda x: F.shiftright(x, shift)
    val = lambda x: F.shiftright(x, POS_BITS)
    at = lambda x: x.bitwiseAND(F.lit(LOW_POS))

    def entry(x: Column, i: Column) -> Column:
        y = F.get(s, i + 1)
        hashed = F.when(is_end(y), F.xxhash64(val(x))).when(
            at(x) < at(y), F.xxhash64(val(x), val(y))).otherwise(F.xxhash64(val(y), val(x)))
        first = (i == 0) | (bin_of(F.get(s, i - 1)) != bin_of(x))
        return F.when(first, F.when(is_end(x), EMPTY).otherwise(hashed.bitwiseAND(F.lit(0xFFFF)).cast("int")))

    return df.withColumn(out, F.array_compact(F.transform(s, entry))).drop(w, k, s)


def fingerprint_text(codes: str) -> Column:
    """The signature as text: four hex digits a bin, ``....`` for an empty one."""
    return F.array_join(F.transform(codes, lambda c: F.when(c == EMPTY, "....").otherwise(F.lower(F.lpad(F.hex(c), 4, "0")))), "")


def likeness(a: str, b: str) -> Column:
    """Share of equal entries among the bins that either signature fills; 1.0 if both are empty."""
    fits = F.zip_with(a, b, lambda x, y: F.when((x == EMPTY) & (y == EMPTY), None).otherwise((x == y).cast("int")))
    acc = F.aggregate(fits, F.struct(F.lit(0).alias("same"), F.lit(0).alias("n")), lambda s, x: F.when(x.isNull(), s).otherwise(
        F.struct((s["same"] + x).alias("same"), (s["n"] + 1).alias("n"))),
        lambda s: F.when(s["n"] == 0, 1.0).otherwise(s["same"] / s["n"]))
    return F.when(F.col(a) == F.col(b), 1.0).otherwise(acc)


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, text, codes (the signature), fingerprint (the same as text)."""
    d = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return _with_codes(d, "text", "codes").withColumn("fingerprint", fingerprint_text("codes"))


def with_next(documents: DataFrame, columns: list[str], key: str = "doc_id") -> DataFrame:
    """Adds ``next_<c>`` of the row with the next smaller key (after the last: of the first).

    Keys are dealt to ranges between quantiles, and a key that several quantiles name, as the rows without a key, to
    ranges of the tie hash; the first row of each range is also
    given to the range before it, so that one shuffle of the rows is enough and no window spans
    the table.  Ties are ordered by the hash of the columns; null keys come last.  The ranges' first rows are a
    broadcast table of one row a range: as many as shuffle partitions, and 2**PARTS for each frequent key, of which there are fewer.
    """
    spark = documents.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    k = F.col(key).cast("double")
    found = documents.select(F.percentile_approx(k, [i / n for i in range(1, n)] or [0.5], 10000).alias("q")).first()["q"] or []
    cuts = sorted(set(found))
    frequent = [c for c in cuts if found.count(c) > 1]
    # ranges count upwards as keys fall, and in a key as its ties fall
    rng = F.when(k.isNull(), len(cuts) + 1).otherwise(F.size(F.filter(
        F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), lambda c: c >= k)))
    by_tie = F.shiftright(F.bitwise_not("_tie"), 64 - PARTS) + (1 << PARTS - 1)
    split = k.isNull() | (k.isin(frequent) if frequent else F.lit(False))
    d = documents.withColumn("_tie", F.xxhash64(columns[0])).withColumn(
        "_r", rng.cast("long") * (2 << PARTS) + F.when(split, by_tie).otherwise(1 << PARTS))
    order = F.struct(F.col(key).isNotNull().alias("some"), F.col(key).alias("key"), F.col("_tie").alias("tie"))
    firsts = d.groupBy("_r").agg(F.max(order).alias("_first"))
    over_all = Window.orderBy("_r")  # one row for each range
    before = F.coalesce(F.lag("_r").over(over_all), F.max("_r").over(over_all.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    d = d.join(F.broadcast(firsts.select("_r", "_first", before.alias("_before"))), "_r")
    is_head = F.col(key).eqNullSafe(F.col("_first.key")) & (F.col("_tie") == F.col("_first.tie"))
    own = F.struct(F.col("_r").alias("r"), F.lit(False).alias("ghost"))
    d = d.withColumn("_to", F.explode(F.when(is_head, F.array(own, F.struct(F.col("_before").alias("r"), F.lit(True).alias("ghost"))))
                                      .otherwise(F.array(own))))
    d = d.select("*", F.col("_to.r").alias("_w"), F.col("_to.ghost").alias("_ghost")).drop("_to", "_r", "_first", "_before")
    w = Window.partitionBy("_w").orderBy("_ghost", F.col(key).desc_nulls_last(), F.col("_tie").desc())
    d = d.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
    return d.filter(~F.col("_ghost")).drop("_w", "_ghost", "_tie")


def fingerprint_pairs(documents: DataFrame) -> DataFrame:
    """Each document against its edited text and against the next document."""
    d = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = with_next(_with_codes(d, "text", "codes"), ["text", "codes"])
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    d = d.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    d = d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "codes", "next_codes", "edited")
    d = _with_codes(d, "edited", "edited_codes")
    return d.select("doc_id", "n_chars", "edited_sha256", fingerprint_text("codes").alias("fingerprint"),
                    fingerprint_text("edited_codes").alias("edited_fingerprint"),
                    likeness("codes", "edited_codes").alias("near_edited"),
                    likeness("codes", "next_codes").alias("near_next"))
