"""Conversation repair against an exhaustive search, over parts, ties, nulls and repeated rows."""

import hashlib
import itertools
import re
import zlib



from parcelscope.llm import conversation_repair as C
from parcelscope.llm import queries

from conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, kind string, audit string, equal int"


def _brute(rows):
    """Cheapest (cost, audit, repaired) of rows (role, text, fault): every edit of every row, and inserts between them."""
    best = None
    fits = re.compile("(s?(ua)+)?")

    def letters(i):
        return "D" if rows[i][2] in "bd" else "KDR"

    for edits in itertools.product(*(letters(i) for i in range(len(rows)))):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            cost, out = 5 * sum(gaps), []
            audit = "I" * gaps[0]
            out += [None] * gaps[0]
            for (role, text, fault), e, g in zip(rows, edits, gaps[1:]):
                cost += {"K": 0, "R": 1, "D": 2}[e] + (5 if fault == "t" and e != "D" else 0)
                audit += e + "I" * g
                if e != "D":
                    out.append((role if e == "K" else None, text))
                out += [None] * g
            if best is not None and (cost, audit) >= best[:2]:
                continue
            free = [k for k, x in enumerate(out) if x is None or x[0] is None]
            for give in itertools.product(("user", "assistant"), repeat=len(free)):
                full = list(out)
                for k, role in zip(free, give):
                    full[k] = (role, "" if out[k] is None else out[k][1])
                if fits.fullmatch("".join(r[:1] or " " for r, _ in full)):  # an empty role cannot be kept
                    best = (cost, audit, full)
                    break
    return best


def _damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        got = out.setdefault(conv, [])
        if k == 4:
            role = "user"
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        got += [(turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def _expected(conv_rows):
    rows = sorted(conv_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    seen, marked = set(), []
    for _, role, text in rows:
        tail = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = "b" if not tail else "d" if (role, text) in seen else "k" if tail[-1] in ".!?" else "t"
        seen.add((role, text))
        marked.append((role, text, fault))
    turns = [t for t, *_ in rows if t is not None]
    count = {f: sum(m[2] == f for m in marked) for f in "bdt"}
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    cost, audit, full = _brute(marked)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count["b"], count["d"], count["t"], illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in full).encode()).hexdigest())


ROLES, TEXTS = ("system", "user", "assistant", "tool", "", None), ("Hi.", "Why?", "cut", " \n", None, "Hi.", "x! \t")


def _random(n_conv, most, seed):
    import random
    rng = random.Random(seed)
    rows = []
    for c in range(n_conv):
        conv = None if c == 3 else c
        for t in range(rng.randint(0, most)):
            turn = None if rng.random() < 0.1 else t + (rng.random() < 0.2)
            rows.append((conv, turn, rng.choice(ROLES), rng.choice(TEXTS)))
    rows += rows[:5]  # repeated rows
    return rows


def _got(df):
    return {r.conv_id: tuple(r[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
            for r in df.collect()}



def test_random_conversations_equal_brute_force(spark):
    rows = _random(40, 4, 11)
    got = _got(C.digest(C.repair(C.damaged(spark.createDataFrame([(*r, "z", "z", 3) for r in rows], SCHEMA)))))
    damaged = _damaged(rows)
    assert got == {c: _expected(damaged[c]) for c in damaged}


def test_query_equals_brute_force_where_conversations_are_short(spark):
    got = _got(queries.op12_conversation_repair(spark, SF_SMALL))
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    damaged = _damaged(rows)
    assert set(got) == set(damaged)
    short = [c for c in damaged if len(damaged[c]) <= 5]
    assert len(short) > 5 and all(got[c] == _expected(damaged[c]) for c in short)


def _walk(rows):
    """Lightest (cost, audit) by plain dynamic programming."""
    front = {0: (0, "")}
    for i in range(len(rows) + 1):
        for _ in range(2):
            for q, (c, a) in list(front.items()):
                to = C.NEXT[q, C.WANTED[q]]
                front[to] = min(front.get(to, (1 << 60, "")), (c + 5, a + "I"))
        if i == len(rows):
            return min(front[q] for q in (0, 3) if q in front)
        initial, fault, equal = rows[i]
        after = {}
        for q, (c, a) in front.items():
            more = [(q, 2 * equal, "D" * equal)]
            if fault not in "bd":
                tail = ((equal - 1) * 2, "D" * (equal - 1))
                cut = 5 * (fault == "t")
                more = [(q, 2 + tail[0], "D" + tail[1]), (C.NEXT[q, C.WANTED[q]], 1 + cut + tail[0], "R" + tail[1])]
                if (q, initial) in C.NEXT:
                    more.append((C.NEXT[q, initial], cut + tail[0], "K" + tail[1]))
            for to, w, e in more:
                after[to] = min(after.get(to, (1 << 60, "")), (c + w, a + e))
        front = after


def test_agenda_and_parts_equal_dynamic_programming():
    import random
    rng = random.Random(4)
    for _ in range(400):
        rows = tuple((rng.choice("suat"), rng.choice("kkktbd"), rng.choice((1, 1, 1, 3))) for _ in range(rng.randint(0, 14)))
        want = _walk(rows)
        assert C.whole(rows) == want
        cut = rng.randint(0, len(rows))  # two parts, composed
        fronts = {q: C.advanced({q: (0, "")}, rows[cut:]) for q in range(4)}
        first, joined = C.advanced({0: (0, "")}, rows[:cut]), {}
        for q, (c, a) in first.items():
            for to, (c2, a2) in fronts[q].items():
                joined[to] = min(joined.get(to, (1 << 60, "")), (c + c2, a + a2))
        assert C.finished(joined) == want


def test_a_conversation_over_many_tasks(spark):
    """One conversation holds nearly all rows, dealt to several tasks and several segments of them."""
    roles = ("user", "assistant", "assistant", "user", "system", "tool")
    rows = [(7, i // 2, roles[i * 7 % 6], f"{i % 900} {'end.' if i % 5 else 'cut'}") for i in range(6000)]
    rows += [(c, 0, "user", "a.") for c in range(20)] + [(7, 5, "user", "same!")] * 900
    df = spark.createDataFrame([(*r, "", "", 1) for r in rows], SCHEMA)
    spread = C.audits(C.plain(df)).filter("conv_id = 7").collect()
    order = sorted((r[1:] for r in rows if r[0] == 7), key=lambda r: (r[0], r[1], hashlib.md5(r[2].encode()).digest()))
    seen, marked = set(), []
    for _, role, text in order:
        marked.append((role[:1], "d" if (role, text) in seen else "k" if text[-1] in ".!?" else "t", 1))
        seen.add((role, text))
    cost, audit = _walk(marked)
    assert len(spread) == 1 and (spread[0].cost, spread[0].audit) == (cost, audit)
    assert spread[0].duplicate == sum(m[1] == "d" for m in marked) and spread[0].truncated == sum(m[1] == "t" for m in marked)
    assert spread[0].illegal == sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    assert spread[0].gaps == 0


def test_repaired_rows_are_real_output(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Yes."), (1, 2, "user", "Why?"), (2, 0, "user", " "), (2, 1, "user", " ")]
    out = C.repair(C.plain(spark.createDataFrame([(*r, "", "", 0) for r in rows], SCHEMA))).orderBy("conv_id", "position").collect()
    turns = [(r.conv_id, r.position, r.edit, r.role, r.text) for r in out if r.position]
    reports = {r.conv_id: (r.cost, r.audit, r.blank, r.duplicate) for r in out if not r.position}
    assert reports == {1: (2, "KRR", 0, 0), 2: (4, "DD", 2, 0)}
    assert turns == [(1, 1, "K", "system", "Be kind."), (1, 2, "R", "user", "Yes."), (1, 3, "R", "assistant", "Why?")]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert C.digest(C.repair(C.damaged(df))).count() == 0
