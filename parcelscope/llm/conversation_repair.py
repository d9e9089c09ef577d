"""Conversation structure repair by lightest derivations (Knuth's agenda).

A conversation's rows are edited so that their role initials read ``(s?(ua)+)?``.  Items are [i, q]: the first i rows
are edited and the grammar is in state q.  A deduction has an item and an edit as premises and another item as its
conclusion; weights are pairs (cost, audit), where costs add up and audits (the edits' initials) are joined.  That
function is superior and monotone: of two derivations of one item with equal cost neither audit begins the other, as that would
take inserts more.  So items leave the agenda in the order of their weights, each with its lightest derivation, until the
goal item does.  Ties in cost go to the audit that is least in ASCII.

Edits: Keep 0; Rerole to user or assistant 1; Delete 2, required for blank rows (no character but white space) and
duplicates (role and text of an earlier row); Insert an empty row of a user or assistant 5; a truncated row (its last character
that is not white space is none of ``.!?``) adds 5 unless deleted.

Scale.  Equal rows are grouped first, then rows without texts (``role``, digest of the text, fault) are dealt to tasks by range
of (conversation, turn), so that one conversation may cover many tasks.  A task derives, for every conversation that it has
rows of, the lightest derivation from each state to each state, ``SEGMENT`` rows at a time; parts of a
conversation that tasks share are composed in order by the same agenda.  Its result is one audit, a string as long as the
conversation has rows; the task that joins the parts holds at most sixteen of them.  The texts are then
sorted by conversation and stream by their audit; no task holds the texts of a conversation.

Rows: by turn (nulls first), then role, then digest of the text; a null role or text is one space; an empty role has no
initial and cannot be kept; rows of a null conversation are one conversation.  Repeated rows are duplicates.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_partitions, tidy, written
from .hot import join_groups

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs
SEGMENT = 256  # rows of a conversation that one run of the agenda covers
HELD_BYTES, HELD_ROWS = 4 << 20, 4096  # of a batch that a task gives back

# grammar states: nothing yet, after the system row, after a user row, after an assistant row
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ACCEPTING = (0, 3)
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}  # what a rerole or insert gives
ROLE = {"u": "user", "a": "assistant"}
GOAL = (-1, -1)

Row = tuple[str, str, int]  # role initial, fault (k none, b blank, d duplicate, t truncated), equal rows


# --- lightest derivations ----------------------------------------------------------------------

def lightest(axioms: Iterable[tuple], deductions: Callable, goal=None) -> dict:
    """item -> (cost, audit) of its lightest derivation, for the items that leave the agenda up to ``goal``.

    ``axioms``: (cost, audit, item).  ``deductions(item)``: (cost, audit, item) of the edges whose other premise is an axiom.
    """
    agenda, chart = list(axioms), {}
    heapq.heapify(agenda)
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in chart:
            continue
        chart[item] = (cost, audit)
        if item == goal:
            break
        for more, edits, to in deductions(item):
            if to not in chart:
                heapq.heappush(agenda, (cost + more, audit + edits, to))
    return chart


def repairs(rows: tuple[Row, ...], last: bool) -> Callable:
    """Deductions over ``rows``; ``last``: nothing follows, so accepting items lead to the goal."""
    def of(item: tuple[int, int]) -> Iterator[tuple]:
        i, q = item
        want = WANTED[q]
        if i == len(rows) and last and q in ACCEPTING:
            yield 0, "", GOAL
        yield INSERT, "I", (i, NEXT[q, want])
        if i == len(rows):
            return
        initial, fault, equal = rows[i]
        if fault in "bd":
            yield DELETE * equal, "D" * equal, (i + 1, q)
            return
        again, gone = DELETE * (equal - 1), "D" * (equal - 1)  # the first of equal rows, then its duplicates
        yield DELETE + again, "D" + gone, (i + 1, q)
        cut = TRUNCATED if fault == "t" else 0
        if (q, initial) in NEXT:
            yield cut + again, "K" + gone, (i + 1, NEXT[q, initial])
        yield REROLE + cut + again, "R" + gone, (i + 1, NEXT[q, want])
    return of


Front = dict[int, tuple[int, str]]  # state -> weight


def advanced(front: Front, rows: tuple[Row, ...]) -> Front:
    """The lightest weight of every state after ``rows``."""
    chart = lightest(((c, a, (0, q)) for q, (c, a) in front.items()), repairs(rows, last=False))
    return {q: chart[len(rows), q] for q in range(4) if (len(rows), q) in chart}


def finished(front: Front, rows: tuple[Row, ...] = ()) -> tuple[int, str]:
    return lightest(((c, a, (0, q)) for q, (c, a) in front.items()), repairs(rows, last=True), GOAL)[GOAL]


@lru_cache(1 << 14)
def whole(rows: tuple[Row, ...]) -> tuple[int, str]:
    return finished({0: (0, "")}, rows)


class Part:
    """What a task knows of a conversation: counts, and the fronts from each state that it may begin in."""

    def __init__(self, begins: bool):
        self.begins = begins
        self.fronts: dict[int, Front] = {q: {q: (0, "")} for q in ((0,) if begins else range(4))}
        self.held: list[Row] = []
        self.counts = {"b": 0, "d": 0, "t": 0}
        self.rows = self.illegal = self.turns = 0
        self.least = self.most = self.first_turn = self.last_turn = self.first = self.last = None

    def add(self, turn: int | None, initial: str, fault: str, equal: int) -> None:
        self.counts[fault] = self.counts.get(fault, 0) + 1
        self.counts["b" if fault == "b" else "d"] += equal - 1
        self.illegal += (equal - 1) + (self.rows > 0 and self.last + initial not in ("su", "ua", "au"))
        if turn is not None:
            self.turns += self.last_turn != turn
            self.least = turn if self.least is None else self.least
            self.most = turn
        if not self.rows:
            self.first, self.first_turn = initial, turn
        self.last, self.last_turn = initial, turn
        self.rows += equal
        self.held.append((initial, fault, equal))
        if len(self.held) == SEGMENT:
            self.derive()

    def derive(self) -> None:
        rows, self.held = tuple(self.held), []
        self.fronts = {q: advanced(front, rows) for q, front in self.fronts.items()}

    def result(self) -> tuple[int, str]:
        """(cost, audit), if the conversation lies in this task."""
        front = self.fronts[0]
        return whole(tuple(self.held)) if front == {0: (0, "")} else finished(front, tuple(self.held))

    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.turns


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
PARTS = (f"conv_id long, part int, complete boolean, {COUNTS}, rows long, turns long, least long, most long, first_turn long, last_turn long, "
         "first string, last string, fronts array<struct<start:int,state:int,cost:bigint,audit:string>>")
_FRONT = pa.list_(pa.struct([("start", pa.int32()), ("state", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    flat = schema.partition(", fronts ")
    fields = [x.split() for x in flat[0].split(", ")] + [["fronts", "list"]] * bool(flat[1])
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW.get(t, _FRONT)) for c, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn: one row for each conversation that the task has rows of."""
    number = TaskContext.get().partitionId()
    conv, part, out, size = None, None, [], 0

    def row(ends: bool) -> tuple:
        c = part.counts
        told = (part.illegal, *part.result()) if part.begins and ends else (part.illegal, None, None)
        if told[1] is None and part.held:
            part.derive()
        fronts = [] if told[1] is not None else [
            {"start": s, "state": q, "cost": w, "audit": a} for s, front in part.fronts.items() for q, (w, a) in front.items()]
        return (conv[0], number, told[1] is not None, part.gaps(), c["b"], c["d"], c["t"], *told, part.rows, part.turns, part.least, part.most,
                part.first_turn, part.last_turn, part.first, part.last, fronts)

    for b in batches:
        for c, turn, initial, fault, equal in zip(*(x.to_pylist() for x in b.columns)):
            if conv is None or conv[0] != c:
                if part is not None:
                    out.append(row(True))
                    size += part.rows
                conv, part = (c,), Part(begins=conv is not None)
            if fault is not None:
                part.add(turn, initial, fault, equal)
            if len(out) >= HELD_ROWS or size >= HELD_BYTES:
                yield _batch(out, PARTS)
                out, size = [], 0
    if part is not None:
        out.append(row(False))
    if out:
        yield _batch(out, PARTS)


REPORTS = f"conv_id long, {COUNTS}"


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts sorted by conversation and part: items of the parts so far and of the next one are the premises."""
    conv, state = None, None

    def report() -> pa.RecordBatch:
        least, most = state["least"], state["most"]
        gaps = 0 if least is None else most - least + 1 - state["turns"]
        return _batch([(conv[0], gaps, state["blank"], state["duplicate"], state["truncated"], state["illegal"], *finished(state["front"]))], REPORTS)

    for b in batches:
        for p in b.to_pylist():
            if conv is None or conv[0] != p["conv_id"]:
                if conv is not None:
                    yield report()
                conv = (p["conv_id"],)
                state = {k: 0 for k in ("blank", "duplicate", "truncated", "illegal", "turns", "rows")}
                state |= {"least": None, "most": None, "last": None, "last_turn": None, "front": {0: (0, "")}}
            for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
                state[k] += p[k]
            if p["rows"]:
                if state["rows"]:
                    state["illegal"] += state["last"] + p["first"] not in ("su", "ua", "au")
                    state["turns"] -= p["first_turn"] is not None and p["first_turn"] == state["last_turn"]
                state["least"] = p["least"] if state["least"] is None else state["least"]
                state["most"] = state["most"] if p["most"] is None else p["most"]
                state |= {"last": p["last"], "last_turn": p["last_turn"], "rows": state["rows"] + p["rows"]}
            edges: dict[int, list] = {}
            for f in p["fronts"]:
                edges.setdefault(f["start"], []).append((f["cost"], f["audit"], (1, f["state"])))
            chart = lightest(((c, a, (0, q)) for q, (c, a) in state["front"].items()),
                             lambda item: edges.get(item[1], []) if item[0] == 0 else [])
            state["front"] = {q: w for (at, q), w in chart.items() if at == 1}
    if conv is not None:
        yield report()


# --- Spark -------------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows damaged by crc32(``conv_id:turn``) % 20; 0 copies of the dropped ones."""
    one = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", one).alias("role"),
        F.coalesce("text", one).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("k"))
    return rows.select("conv_id", "turn", F.when(F.col("k") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       F.when(F.col("k") == 1, F.lit("")).when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", ""))
                       .otherwise(F.col("text")).alias("text"),
                       F.when(F.col("k") == 0, 0).when(F.col("k") == 3, 2).otherwise(1).alias("copies"))


def _digest():
    return F.unhex(F.md5(F.col("text").cast("binary")))


def plain(conversations: DataFrame) -> DataFrame:
    """The same columns without damage."""
    one = F.lit(" ")
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"), F.lit(1).alias("copies"))


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, copies): the counts, the cost and the audit of its repair."""
    spark = rows.sparkSession
    parts = n_partitions(spark)
    there = F.col("copies") > 0
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(end == "", F.lit("b")).when(~F.substring(end, -1, 1).isin(".", "!", "?"), F.lit("t")).otherwise(F.lit("k"))
    # a conversation all of whose rows are dropped keeps one row without a fault
    thin = rows.select("conv_id", *[F.when(there, c).alias(n) for c, n in (
        (F.col("turn"), "turn"), (F.col("role"), "role"), (_digest(), "digest"), (fault, "fault"))], "copies")
    thin = thin.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("copies").alias("equal"))
    thin = written(thin, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    seen = (thin.filter("fault is not null").groupBy("conv_id", "role", "digest")
            .agg(F.count("*").alias("n"), F.min(place).alias("earliest")).filter("n > 1"))
    thin = join_groups(thin, seen, ["conv_id", "role", "digest"], "n")
    earlier = (F.col("fault") != "b") & F.coalesce(F.col("earliest") < place, F.lit(False))
    thin = thin.select("conv_id", "turn", "role", "digest", F.when(earlier, F.lit("d")).otherwise(F.col("fault")).alias("fault"), "equal")
    order = ["conv_id", "turn", "role", "digest"]
    dealt = thin.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "equal")
    found = written(dealt.mapInArrow(tidy(_parts), PARTS), "parts")
    names = [c.split()[0] for c in REPORTS.split(", ")]
    shared = (found.filter("not complete").repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part")
              .mapInArrow(tidy(_composed), REPORTS))
    return found.filter("complete").select(*names).unionByName(shared)


REPAIRED = f"conv_id long, position long, edit string, turn long, role string, text string, {COUNTS}"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation its report row, then its rows in order: the report as position 0, then the repaired rows."""
    out, size = [], 0
    none = (None,) * 7
    conv = audit = None
    at = state = position = 0

    def inserts() -> None:
        nonlocal at, state, position
        while at < len(audit) and audit[at] == "I":
            letter = WANTED[state]
            at, state, position = at + 1, NEXT[state, letter], position + 1
            out.append((conv, position, "I", None, ROLE[letter], "", *none))

    for b in batches:
        for kind, c, turn, role, text, *counts in zip(*(x.to_pylist() for x in b.columns)):
            if kind == 0:
                if audit is not None:
                    inserts()
                conv, audit, at, state, position = c, counts[-1], 0, 0, 0
                out.append((c, 0, None, None, None, None, *counts))
                size += len(audit)
            else:
                inserts()
                edit, at = audit[at], at + 1
                if edit != "D":
                    letter = role[:1] if edit == "K" else WANTED[state]
                    state, position = NEXT[state, letter], position + 1
                    out.append((c, position, edit, turn, role if edit == "K" else ROLE[letter], text, *none))
                    size += len(text)
            if len(out) >= HELD_ROWS or size >= HELD_BYTES:
                yield _batch(out, REPAIRED)
                out, size = [], 0
    if audit is not None:
        inserts()
    if out:
        yield _batch(out, REPAIRED)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations of ``rows`` (conv_id, turn, role, text, copies), each in one partition and in order.

    Position 0 is a conversation's report (gaps, blank, duplicate, truncated, illegal, cost, audit); from 1 on the
    repaired rows with their edit (K, R or I), and the turn that they had.
    """
    reports = audits(rows).withColumn("kind", F.lit(0))
    texts = (rows.filter("copies > 0").withColumn("kind", F.explode(F.array_repeat(F.lit(1), F.col("copies"))))
             .select("kind", "conv_id", "turn", "role", "text", _digest().alias("digest")))
    both = reports.unionByName(texts, allowMissingColumns=True)
    names = [c.split()[0] for c in COUNTS.split(", ")]
    both = both.repartition(n_partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return both.select("kind", "conv_id", "turn", "role", "text", *names).mapInArrow(tidy(_edited), REPAIRED)


DIGEST = f"{REPORTS}, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    report, sha, out = None, None, []
    for b in batches:
        for conv, position, role, text, *counts in zip(*(x.to_pylist() for x in b.columns)):
            if position == 0:
                if report is not None:
                    out.append((*report, sha.hexdigest()))
                report, sha = (conv, *counts), hashlib.sha256()
            else:
                sha.update(f"{chr(10) if position > 1 else ''}{role}:{text}".encode())
            if len(out) >= HELD_ROWS:
                yield _batch(out, DIGEST)
                out = []
    if report is not None:
        out.append((*report, sha.hexdigest()))
    if out:
        yield _batch(out, DIGEST)


def digest(repaired: DataFrame) -> DataFrame:
    """Per conversation of ``repair``: its report and the SHA-256 of its rows ``role:text``, joined by new lines."""
    names = [c.split()[0] for c in COUNTS.split(", ")]
    return repaired.select("conv_id", "position", "role", "text", *names).mapInArrow(tidy(_digests), DIGEST)
