"""PII: many matches in one text, clashing columns, redaction against Python, recall by kind on the documents."""

import random
import re

from parcelscope.llm import pii

from conftest import SF_SMALL

SF = SF_SMALL.replace("sf0.001", "sf0.01")
PIECES = ["a.b@c.org", "10.0.0.7", "999.1.1.1", "4111 1111 1111 1111", "+1 (555) 555-0100", "123-45-6789", "my ssn 123-45-6789", "call 555-123-4567",
          "555-123-4567", "IBAN DE89 3704 0044 0532 0130 00", "card 4222222222222", "token = abcdef0123456789", "é漢😀", "word", "\n", "x" * 60, "12345"]


def _merged(spans):
    out = []
    for s in spans:
        if out and s[0] < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]), out[-1][2])
        else:
            out.append(s)
    return out


def _redacted(text, spans):
    out, at = [], 0
    for a, b, kind in _merged(spans):
        out += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join(out) + text[at:]


def _python_spans(text):
    """The spans of the kinds that need no possessive groups, by re, with context words in the 40 characters before."""
    out = []
    for kind, (pattern, prior, words, bonus) in {k: pii.ADDED[k] for k in ("card13", "ssn", "tel", "secret")}.items():
        for m in re.finditer(pattern, text):
            before = text[max(0, m.start() - pii.CONTEXT_CHARS):m.start()].lower()
            if prior + (bonus if re.search(words, before) else 0) >= pii.THRESHOLD:
                out.append((m.start(), m.end(), kind))
    return sorted(out)


def test_long_texts_equal_python_over_block_borders(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(PIECES) for _ in range(n)) for n in (3, 40, 700, 3000)]
    texts += ["123-45-6789 " * n for n in (255, 256, 257, 511, 512, 513)] + ["ssn" + " 555-123-4567" * 600, "tel" + "\n" * 38 + "555-123-4567"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in pii.find_spans(df).collect():
        spans = [(s.start, s.end, s.kind) for s in r.pii]
        assert [s for s in spans if s[2] in ("ssn", "tel", "secret")] == [s for s in _python_spans(r.text) if s[2] in ("ssn", "tel", "secret")]
        assert spans == sorted(spans, key=lambda s: (s[0], pii.ORDER.index(s[2])))
        texts[r.doc_id] = (r.text, _redacted(r.text, spans))
    for r in pii.redact(df).collect():
        assert r.text == texts[r.doc_id][1]


def test_many_matches_take_linear_time(spark):
    import time
    text = "".join(f"10.0.{i % 256}.{i // 256 % 256} x\n" for i in range(50_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    assert pii.digest(pii.find_spans(df)).first().n_ip == 50_000
    assert pii.redact(df).first().text == "<IP> x\n" * 50_000
    assert time.time() - began < 60


def test_clashing_columns_survive(spark):
    cols = ["pii", "t", "_t", "d", "_d", "row", "redacted", "_spans", "m_ip", "s_ip", "spans", "n_chars", "a.b", "lang"]
    df = spark.createDataFrame([(1, "at 10.0.0.7 now", *["mine"] * 11, 15, "dot", "en"), (None, None, *["yours"] * 11, None, None, None)],
                               "doc_id long, text string, " + ", ".join(f"`{c}` {'int' if c == 'n_chars' else 'string'}" for c in sorted(
                                   cols, key=lambda c: (c in ("n_chars", "a.b", "lang"), cols.index(c)))))
    out = pii.redact(df)
    assert out.columns == df.columns
    a, b = sorted(out.collect(), key=lambda r: r.doc_id is None)
    assert a.text == "at <IP> now" and a.n_chars == 11 and b.text is None and b.n_chars is None
    assert {a[c] for c in cols[:11]} == {"mine"} and {b[c] for c in cols[:11]} == {"yours"} and a["a.b"] == "dot"
    found = pii.find_spans(df)
    assert found.columns == [c for c in df.columns if c != "pii"] + ["pii"]
    assert [[s.kind for s in r.pii] for r in sorted(found.collect(), key=lambda r: r.doc_id is None)] == [["ip"], []]


def test_recall_by_kind_on_the_documents(spark):
    """Of what the documents were given (found here by looser patterns), 0.9 at least lies in a span of its kind."""
    loose = {"email": r"[0-9a-z]+@mail[0-9]+\.example\.com", "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])", "phone": r"\+1 \(\d{3}\) 555-\d{4}",
             "secret": r'token = "[0-9a-f]{40}"'}
    hit, seen = dict.fromkeys(loose, 0), dict.fromkeys(loose, 0)
    for r in pii.find_spans(spark.read.parquet(f"{SF}/documents.parquet")).collect():
        for kind, pattern in loose.items():
            for m in re.finditer(pattern, r.text or ""):
                seen[kind] += 1
                hit[kind] += any(s.kind == kind and s.start < m.end() and s.end > m.start() for s in r.pii)
    assert all(seen.values()) and all(hit[k] >= 0.9 * seen[k] for k in loose), (hit, seen)
