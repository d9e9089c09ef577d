"""Personal data: patterns propose spans, checksums confirm, nearby words adjust the score.

DataFrame functions only.  ``regexp_extract_all`` gives a kind's matches and
``split`` by the same pattern the gaps between them; running sums of both
lengths are the spans (code points, end exclusive).  Running sums and maxima go over blocks of ``BLOCK`` matches, and
texts are cut up by pieces, so the work grows with the length of a text and the number of its matches, not their product.

Kinds and their proposal patterns, in the order used for ties:

* ``email``, ``ip`` (parts at most 255), ``card`` (14 to 19 digits, Luhn),
  ``phone`` (``+``, 10 to 15 digits): the base kinds; a valid match is always a span;
* ``iban`` (mod-97), ``card13`` (13 digits, Luhn), ``ssn``, ``tel`` (ten digits written
  without ``+``), ``secret`` (a key, token or password with its value): added by the method.
  Each has a prior score, raised when a context word of its kind stands within
  ``CONTEXT_CHARS`` before the span; spans scoring ``THRESHOLD`` or more are kept.

Null texts are empty and have no spans.  Groups are written possessively, which
matches the same text and needs neither recursion nor backtracking on long runs.
Repeated rows each give a row.  Extra columns are carried along whatever their names (a column ``pii`` is replaced by
``find_spans`` and kept by ``redact``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 40
BLOCK = 256  # matches, or code points of a text, that one step of a running value covers
THRESHOLD = 0.5

LOCAL = "[A-Za-z0-9._%+-]"
# kind -> (pattern, cheap test that any match implies); fixed values of the base kinds
BASE = {
    "email": (rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
# kind -> (pattern, prior score, context words, context bonus)
ADDED = {
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])", 0.6,
             "iban|account|konto|compte|cuenta|bank", 0.3),
    "card13": (r"(?<![0-9])[0-9]{13}(?![0-9])", 0.3, "card|visa|credit|karte|carte|tarjeta", 0.4),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.5, "ssn|social|security", 0.4),
    "tel": (r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", 0.3,
            "phone|tel|call|mobile|fax|telefon|tél|llam", 0.4),
    "secret": (r"(?i)\b(?:api[_-]?key|secret|token|password|passwd|pwd)\b\s{0,3}[=:]\s{0,3}[\"']?[^\s\"']{8,}", 0.7,
               "key|auth|login|secret", 0.2),
}
ORDER = [*BASE, *ADDED]
SPAN = "struct<start:int,end:int,rank:int,kind:string,score:double>"


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn test of a string of digits."""
    value = lambda ch, i: (F.when(i % 2 == 0, ch)  # noqa: E731 - from the right, every second one doubled
                           .when(ch * 2 > 9, ch * 2 - 9).otherwise(ch * 2))
    cs = F.transform(F.split(F.reverse(number), ""), lambda ch, i: value(ch.cast("int"), i))
    return F.aggregate(F.filter(cs, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """ISO 7064 mod 97-10 of an IBAN: country and check digits moved behind, letters as 10..35."""
    s = F.regexp_replace(iban, " ", "")
    s = F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4))
    step = lambda a, ch: F.when(ch == "", a).when(
        ch.rlike("[0-9]"), (a * 10 + ch.cast("int")) % 97).otherwise((a * 100 + F.ascii(ch) - 55) % 97)
    return F.aggregate(F.split(s, ""), F.lit(0), step) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3)
                        & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(digits(m)).between(14, 19) & luhn(digits(m))
    if kind == "phone":
        return F.length(digits(m)).between(10, 15)
    if kind == "card13":
        return luhn(m)
    if kind == "iban":
        return mod97(m)
    return F.lit(True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body (or a lambda in it) names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(xs: Column) -> Column:
    """Numbers of the blocks of a non-empty array."""
    return F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int"))


def _block(xs: Column, i: Column) -> Column:
    return F.slice(xs, i * BLOCK + 1, F.lit(BLOCK))


def _before_blocks(totals: Column, op) -> Column:
    """array<int>: op over all totals before each one, from 0."""
    acc0 = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(totals, acc0, lambda a, t: F.struct(op(a["at"], t).cast("int").alias("at"),
                                                           F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])


def _located(text: Column, matches: Column, pattern: str, context: bool) -> Column:
    """array<struct<start, m, before>>: every match with its place and, with ``context``, the characters before it."""
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("g"), matches.alias("m"))

    def length(p: Column) -> Column:
        return F.length(p["g"]) + F.coalesce(F.length(p["m"]), F.lit(0))

    def last_chars(c: Column) -> Column:
        return F.substring(c, -CONTEXT_CHARS, CONTEXT_CHARS)

    def before_block(ps: Column, i: Column) -> Column:
        """The last characters before a block: every match has one at least."""
        some = F.slice(ps, F.greatest(i * BLOCK + 1 - CONTEXT_CHARS, F.lit(1)), F.least(i * BLOCK, F.lit(CONTEXT_CHARS)))
        return last_chars(F.array_join(F.transform(some, lambda p: F.concat(last_chars(p["g"]), p["m"])), ""))

    def step(a: Column, p: Column) -> Column:
        before = last_chars(F.concat(a["tail"], last_chars(p["g"]))) if context else F.lit("")
        start = a["at"] + F.length(p["g"])
        found = F.array(F.struct(start.alias("start"), p["m"].alias("m"), before.alias("before")))
        tail = last_chars(F.concat(before, p["m"])) if context else F.lit("")
        return F.when(p["m"].isNull(), a).otherwise(F.struct(
            (start + F.length(p["m"])).alias("at"), tail.alias("tail"), F.concat(a["out"], found).alias("out")))

    def of_block(ps: Column, b: Column) -> Column:
        acc0 = F.struct(b["at"].alias("at"), (before_block(ps, b["i"]) if context else F.lit("")).alias("tail"),
                        F.array().cast("array<struct<start:int,m:string,before:string>>").alias("out"))
        return F.aggregate(_block(ps, b["i"]), acc0, step, lambda a: a["out"])

    def over(ps: Column) -> Column:
        sums = F.transform(_blocks(ps), lambda i: F.aggregate(_block(ps, i), F.lit(0), lambda a, p: a + length(p)))
        starts = _before_blocks(sums, lambda a, t: a + t)
        return F.flatten(F.transform(F.arrays_zip(_blocks(ps).alias("i"), starts.alias("at")), lambda b: of_block(ps, b)))

    return let(pairs, over)


def _spans(kind: str, text: Column, matches: Column, pattern: str, prior: float, words: str | None, bonus: float) -> Column:
    rank = ORDER.index(kind)

    def span(x: Column) -> Column:
        start, m = x["start"], x["m"]
        score = F.lit(prior)
        if words:
            score = score + F.when(F.lower(x["before"]).rlike(words), bonus).otherwise(0.0)
        return F.struct(start.alias("start"), (start + F.length(m)).cast("int").alias("end"), F.lit(rank).alias("rank"),
                        F.lit(kind).alias("kind"), score.cast("double").alias("score"))

    valid = F.filter(_located(text, matches, pattern, bool(words)), lambda x: _valid(kind, x["m"]))
    spans = F.transform(valid, span)
    return F.filter(spans, lambda s: s["score"] >= THRESHOLD)


def _found(documents: DataFrame) -> DataFrame:
    """row (a struct of all columns), t (the text, null as empty), pii: array of (start, end, rank, kind, score) by start, then kind."""
    empty = F.array().cast(f"array<{SPAN}>")
    df = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.coalesce("text", F.lit("")).alias("t"))
    specs = {**{k: (p, 1.0, None, 0.0, t) for k, (p, t) in BASE.items()}, **{k: (*v, None) for k, v in ADDED.items()}}
    # matches first: most texts have none of a kind, and then nothing else is computed
    found = df.withColumn("d", F.col("t").rlike("[0-9]"))
    for kind, (pattern, _, _, _, must) in specs.items():
        gate = F.col("t").rlike(r"(?i)[=:]") if kind == "secret" else F.col("d") if kind != "email" else F.lit(True)
        if must:
            gate = gate & F.contains("t", F.lit(must))
        if kind == "card13" or kind == "card":
            gate = gate & F.col("t").rlike(r"[0-9][0-9\x20-]{11}")
        found = found.withColumn(f"m_{kind}", F.when(gate, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))))
    for kind, (pattern, prior, words, bonus, _) in specs.items():
        m = F.col(f"m_{kind}")
        found = found.withColumn(f"s_{kind}", F.when(
            F.size(m) > 0, _spans(kind, F.col("t"), m, pattern, prior, words, bonus)).otherwise(empty))
    allspans = F.array_sort(F.concat(*[F.col(f"s_{k}") for k in specs]),
                            lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"])
                            .otherwise(a["rank"] - b["rank"]))
    return found.select("row", "t", allspans.alias("pii"))


def find_spans(documents: DataFrame) -> DataFrame:
    """``documents`` plus ``pii``: array of (start, end, rank, kind, score) by start, then kind."""
    kept = [F.col("row").getField(c).alias(c) for c in documents.columns if c.lower() != "pii"]
    return _found(documents).select(*kept, "pii")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds and both span lists."""
    count = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("pii", lambda s: s["kind"].isin(list(BASE)))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("pii")).alias("spans"), F.size("pii").cast("long").alias("n_spans"))


def _pieces(text: Column) -> Column:
    """The text as an array of pieces of ``BLOCK`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """Code points [start, end) of the text that ``pieces`` make."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
    some = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(some, start - first * BLOCK + 1, end - start)).otherwise("")


def _opening(spans: Column) -> Column:
    """array<struct<upto, start, kind>>: the spans that overlap none before them, and where the last one before ends."""
    def step(a: Column, s: Column) -> Column:
        return F.struct(F.greatest(a["upto"], s["end"]).alias("upto"), F.when(s["start"] >= a["upto"], F.concat(
            a["out"], F.array(F.struct(a["upto"].alias("upto"), s["start"].alias("start"), s["kind"].alias("kind"))))).otherwise(
            a["out"]).alias("out"))

    def of_block(xs: Column, b: Column) -> Column:
        acc0 = F.struct(b["at"].alias("upto"), F.array().cast("array<struct<upto:int,start:int,kind:string>>").alias("out"))
        return F.aggregate(_block(xs, b["i"]), acc0, step, lambda a: a["out"])

    def over(xs: Column) -> Column:
        ends = F.transform(_blocks(xs), lambda i: F.array_max(F.transform(_block(xs, i), lambda s: s["end"])))
        before = _before_blocks(ends, lambda a, t: F.greatest(a, t))
        return F.flatten(F.transform(F.arrays_zip(_blocks(xs).alias("i"), before.alias("at")), lambda b: of_block(xs, b)))

    return let(spans, over)


def redact(documents: DataFrame) -> DataFrame:
    """Every span (overlapping ones merged, named by the first) replaced by ``<KIND>``; n_chars follows."""
    def written_out(pieces: Column) -> Column:
        parts = F.transform(_opening(F.col("pii")), lambda o: F.concat(
            _between(pieces, o["upto"], o["start"]), F.lit("<"), F.upper(o["kind"]), F.lit(">")))
        last = F.array_max(F.transform("pii", lambda s: s["end"]))
        return F.concat(F.array_join(parts, ""), _between(pieces, last, F.length("t")))

    hit = F.size("pii") > 0
    out = _found(documents).withColumn("redacted", F.when(hit, let(_pieces(F.col("t")), written_out)))
    columns = []
    for f in documents.schema.fields:
        old = F.col("row").getField(f.name)
        if f.name == "text":
            old = F.when(hit, F.col("redacted")).otherwise(old)
        elif f.name == "n_chars":
            old = F.when(hit, F.length("redacted").cast(f.dataType)).otherwise(old)
        columns.append(old.alias(f.name))
    return out.select(*columns)
