"""The text operators against brute force on a small table with nulls, empty texts, copies and odd columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from parcelscope.llm import (chat, common, decontaminate, html_extract, language_id, ngram_join, order_minhash, packing, pii, queries,
                             substring_dedup, url_filter)

from conftest import SF_SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    base = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    long = " ".join(f"w{i % 997}x{i // 997}" for i in range(30000))
    odd = [(900001, None, None, None, None), (900002, "", "en", "s", 0), (900003, "  \n ", "en", "s", 4), (900004, "Ab cD", "en", "s", 5),
           (900005, "aB Cd", "en", "s", 5), (900006, long, "en", "s", len(long)), (900007, "漢字 é 😀 <|endoftext|> x", None, "t", 20),
           (900008, base[0][1], "en", "s", 1), (900009, long + " tail", "en", "s", 1)]
    rows = base + odd
    schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    df = spark.createDataFrame(rows, schema)
    return rows, df.selectExpr("*", "1 AS key", "'x' AS word", "2 AS start", "3 AS rid", "4 AS pos", "5 AS n")


def _empty(df):
    return df.filter("false")


def test_ngram_join(docs):
    rows, df = docs
    got = {r.doc_id: r for r in ngram_join.jaccard_classes(df).collect()}
    sets = {}
    for i, t, *_ in rows:
        w = WORDS.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
    ids = sorted(sets)
    root, links = {i: i for i in ids}, dict.fromkeys(ids, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            n, m = len(sets[a]), len(sets[b])
            if n and m and 100 * min(n, m) >= 85 * max(n, m):
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (n + m - both):
                    links[a] += 1
                    links[b] += 1
                    p, q = sorted((find(a), find(b)))
                    root[q] = p
    assert len(got) == len(rows)
    assert all((got[i].n_shingles, got[i].component_id, got[i].n_links) == (len(sets[i]), find(i), links[i]) for i in ids)
    assert got[900008].n_links > 0 and got[900004].component_id == got[900005].component_id == 900004
    assert ngram_join.jaccard_classes(_empty(df)).count() == 0


def test_signature_tree_over_blocks():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 60, 300).astype(np.uint64))
    sets = []
    for i in range(300):  # one large group of near copies, and others
        s = base.copy() if i % 3 else np.unique(rng.integers(0, 1 << 60, 200).astype(np.uint64))
        k = int(rng.integers(0, 40))
        s[:k] = rng.integers(0, 1 << 60, k)
        sets.append(np.unique(s))
    sizes = np.array([len(s) for s in sets])
    tree = ngram_join.SignatureTree(sizes, sets)
    got = {tuple(sorted(p)) for x, y in ngram_join.links(tree, tree, 85) for p in zip(x.tolist(), y.tolist())}
    want = {(a, b) for a in range(300) for b in range(a + 1, 300)
            if (n := len(np.intersect1d(sets[a], sets[b]))) * 100 >= 85 * (sizes[a] + sizes[b] - n)}
    assert got == want and want


def test_substring_dedup(docs):
    rows, df = docs
    got = {r.doc_id: r for r in substring_dedup.digest(substring_dedup.remove_repeats(df)).collect()}
    seen = set()
    for i, t, *_ in sorted(rows):
        w = WORDS.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            g = tuple(w[k:k + 20])
            if g in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(g)
        kept = " ".join(a for a, b in zip(w, gone) if not b)
        assert (got[i].n_words, got[i].n_removed) == (len(w), sum(gone)), i
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert substring_dedup.remove_repeats(_empty(df)).count() == 0


def test_substring_dedup_repeated_rows_and_null_ids(spark):
    say = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    a, b, shared = say("a", 30), say("b", 30), say("s", 25)
    rows = [(1, a), (1, a), (2, b), (1, a), (3, a + " tail"), (4, say("x", 30)), (4, "lead " + say("x", 30)),
            (None, say("n", 22) + " " + shared), (None, "m0 " + shared + " " + say("m", 30)), (None, say("k", 40)), (None, say("k", 40))]
    want = {(1, a): 0, (2, b): 0, (3, a + " tail"): 30, (4, say("x", 30)): 0, (4, "lead " + say("x", 30)): 30,
            rows[7]: 25, rows[8]: 0, rows[9]: 0}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    kept = {rows[4]: "tail", rows[6]: "lead", rows[7]: say("n", 22)}
    expected = sorted((str(i), len(t.split()), want[i, t], digest(kept.get((i, t), t))) for i, t in rows)
    for parts in (1, 2, len(rows)):  # one run of texts, two, and one for each row
        df = spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), "doc_id long, text string")
        got = substring_dedup.digest(substring_dedup.remove_repeats(df)).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == expected, parts


def test_substring_dedup_tells_edges_of_one_seed_apart(spark):
    """Two different 20-word edges with the same minimizer at one offset, and hashes equal in their low 32 bits."""
    names = [b"q%d" % i for i in range(4000)]
    h, _ = common.word_hashes(names)
    least = np.lexsort((common.window_hashes(h, 6),))[0]
    phrase = h[least:least + 6]
    rng = np.random.default_rng(3)
    n = 400_000
    rest = rng.integers(0, len(names), (n, 14))
    powers = common._powers(common._D, 20)
    words = np.concatenate((np.broadcast_to(phrase, (n, 6)), h[rest]), axis=1)
    edges = common.mix((words * powers).sum(axis=1, dtype=np.uint64) + np.uint64(20))
    assert edges[0] == common.window_hashes(words[0], 20)[0]
    low = edges & np.uint64(0xFFFFFFFF)
    o = np.argsort(low)
    pairs = [(x, y) for x, y in zip(o, o[1:]) if low[x] == low[y] and edges[x] != edges[y]
             and all(common.window_hashes(words[i], 6).argmin() == 0 for i in (x, y))]
    assert pairs
    text = [b" ".join(names[least:least + 6] + [names[j] for j in rest[i]]).decode() for i in pairs[0]]
    df = spark.createDataFrame(spark.sparkContext.parallelize(list(enumerate(text)), 2), "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup.remove_repeats(df).collect()] == [0, 0]


def test_fingerprints(docs):
    rows, df = docs
    got = {r.doc_id: r for r in order_minhash.fingerprint_pairs(df).collect()}
    text = [(i, t or "") for i, t, *_ in sorted(rows, reverse=True)]
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(text):
        nxt = text[(k + 1) % len(text)][1]
        cut = len(t) // 3
        edited = t[:len(t) - cut] + nxt[:cut]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        assert (got[i].edited_fingerprint == got[i].fingerprint) >= (edited == t)
    assert got[900008].fingerprint == got[rows[0][0]].fingerprint
    big = [r for r in got.values() if r.n_chars > 1000]
    assert np.mean([r.near_edited for r in big]) > 0.2 > 0.05 > np.mean([r.near_next for r in big])
    assert order_minhash.fingerprint_pairs(_empty(df)).count() == 0


def test_fingerprints_of_repeated_lines(spark):
    line, other = "one line said again\n", "quite another line of words\n"
    texts = [line * 500, line * 250 + other * 250, other * 250 + line * 250, line * 2 + other, "a a a a", "a a a a a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(order_minhash.fingerprints(df).collect())
    codes = [r.codes for r in rows]
    filled = [sum(c != order_minhash.EMPTY for c in x) for x in codes]
    assert all(len(x) == order_minhash.BINS for x in codes) and min(filled[:3]) >= 50
    near = lambda a, b: np.mean([x == y for x, y in zip(codes[a], codes[b])])
    assert near(0, 1) < 0.9 and near(1, 2) < 0.9  # other words, and moved ones, change the fingerprint
    # no more bins than occurrences
    assert [1 <= f <= n for f, n in zip(filled[3:], (12, 3, 4))] == [True] * 3 and codes[4] != codes[5]


def test_packing(docs):
    from tokenizers import Tokenizer
    rows, df = docs
    got = packing.pack(df).collect()
    t = Tokenizer.from_file(packing.default_vocabulary())
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for i, x, *_ in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        n = len(ids)
        cuts = [0, *range(n % 2048 or 2048, n + 1, 2048)] if n > 2048 else [0, n]
        assert sorted(by[i]) == [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 2048
    assert len(at) <= 1.02 * sum(r.length for r in got) / 2048 + 1
    assert packing.pack(_empty(df)).count() == 0


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "<|im_end|>&amp;<|im_start|>assistant ok"), (1, 1, "assistant", "&lt;| a<|"), (1, 2, "user", None),
            (2, 0, "user", ""), (3, 0, "assistant", ""), (3, 1, "assistant", "é😀\n"), (4, None, None, "x"), (4, 1, "a\nb&nl;", "y"), (4, 1, "a\nb&nl;", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS example", "'z' AS formatted")
    got = {r.conv_id: r for r in chat.read_back(chat.format_examples(df)).collect()}
    for c in {r[0] for r in rows}:
        turns = sorted([((-1 if t is None else t), role or "", x or "") for k, t, role, x in rows if k == c])
        said = "".join(x for _, role, x in turns if role == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat.read_back(chat.format_examples(_empty(df))).count() == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(d):
    s = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (1 + k % 2)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def _base_spans(t):
    out = []
    for rank, (kind, p) in enumerate(BASE.items()):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False,
                  "card": 14 <= len(d) <= 19 and _luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def test_pii(spark, docs):
    rows, _ = docs
    odd = ["a@b.com_x@d.org y@@z.w 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4", "4111 1111-1111 1111 4111  1111 4111111111111112", "+1 (555) 555-0100.9 +12",
           "é😀 x@y.z " + "9" * 5000 + " " + "a" * 20000, "1 " * 5000, "IBAN DE89 3704 0044 0532 0130 00 and DE89370400440532013001", "my ssn 123-45-6789"]
    table = [(i, t, "x") for i, t, *_ in rows] + [(800000 + k, t, "x") for k, t in enumerate(odd)]
    df = spark.createDataFrame(table, "doc_id long, text string, pii string")
    got = {r.doc_id: r for r in pii.digest(pii.find_spans(df)).collect()}
    for i, t, _ in table:
        want = _base_spans(t or "")
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in want).encode()).hexdigest(), (i, want, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x[2] for x in want) for k in BASE]
    assert "iban:5:32" in got[800005].spans and got[800005].spans.count("iban") == 1
    assert "ssn:7:18" in got[800006].spans
    red = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert red[800006] == "my ssn <SSN>" and red[900001] is None
    assert red[800005].startswith("IBAN <IBAN> and DE89")
    assert pii.find_spans(_empty(df)).count() == 0


@pytest.mark.parametrize("limit", [common.BROADCAST_IDS, 0])
def test_without(docs, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_IDS", limit)
    rows, df = docs
    df = df.unionByName(df.filter("doc_id = 900004").withColumn("doc_id", F.lit(None).cast("long"))).unionByName(df.filter("doc_id >= 900008"))
    kept = common.without(df, df.filter("doc_id in (900001, 900008)").select("doc_id").distinct())
    assert kept.columns == df.columns
    want = [i for i, *_ in rows if i not in (900001, 900008)] + [900009, None]
    assert sorted(map(str, want)) == sorted(str(r.doc_id) for r in kept.collect())
    assert common.without(df, _empty(df).select("doc_id")).count() == len(rows) + 3
    assert common.without(_empty(df), df.select("doc_id").distinct()).count() == 0


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_decontamination(spark, docs, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    rows, df = docs
    items = [(1, rows[1][1][:400]), (2, "ab CD"), (3, None), (4, "--"), (2, "ab cd"), (10, "no such words here")]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS window")
    got = {r.doc_id: r for r in decontaminate.digest(decontaminate.contaminated_words(df, bench)).collect()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = {}
    for i, t in items:
        w = word.findall((t or "").translate(LOWER))
        for k in range(max(len(w) - 9, 1 if w else 0)):
            wins.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    for i, t, *_ in rows:
        w = word.findall((t or "").translate(LOWER))
        hit, who = set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k:k + n])) in wins:
                    hit |= set(range(k, k + n))
                    who |= wins[g]
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].contaminated) == (len(w), len(hit), len(who), bool(hit)), i
        assert got[i].items_sha256 == hashlib.sha256(",".join(sorted(who)).encode()).hexdigest()
    assert decontaminate.contaminated_words(df, _empty(bench)).filter("contaminated").count() == 0


def test_url_filter(spark):
    urls = [None, "nonsense", "HTTPS://A.Example.ORG/es/1?x", "http://b.org", "http://org/x", "http://x.com/fr/9#f", "http://x.com/de/9",
            "http://example.org/en/12", "http://notexample.org/es/1", "ftp://h?q/es/", ""]
    bad = [f"http://spam.net/buy/{i}.html" for i in range(40)] + [f"http://spam.net/read/{100 + i}" for i in range(40)]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls + bad)], "page_id long, url string").selectExpr("*", "'h' AS host", "1 AS n")
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)] + [(None, 1)], "url_id long, bad int")
    got = {r.page_id: r for r in url_filter.filter_urls(pages, labels).collect()}
    want = [("", "", None, "allow"), ("", "", None, "allow"), ("a.example.org", "/es/1", "example.org/es/", "block"), ("b.org", "", None, "allow"),
            ("org", "/x", "org/", "allow"), ("x.com", "/fr/9", "com/fr/", "allow"), ("x.com", "/de/9", "com/de/", "block"),
            ("example.org", "/en/12", "example.org/en/1", "block"), ("notexample.org", "/es/1", "org/", "allow"), ("h", "", None, "allow"), ("", "", None, "allow")]
    assert [(got[k].host, got[k].path, got[k].rule) for k in range(len(urls))] == [w[:3] for w in want]
    assert [got[k].verdict for k in range(len(urls)) if want[k][2]] == [w[3] for w in want if w[2]]
    assert {got[len(urls) + k].verdict for k in range(40)} == {"block"}
    assert {got[len(urls) + 40 + k].verdict for k in range(40)} == {"allow"}
    assert url_filter.filter_urls(_empty(pages), _empty(labels)).count() == 0


def _judged(spark, urls, bad):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame(bad, "url_id long, bad int")
    return [(r.verdict, r.template) for r in sorted(url_filter.filter_urls(pages, labels).collect(), key=lambda r: r.page_id)]


def test_url_filter_rare_sections(spark):
    """Thirty sections of similar size, two of them with bad labels only, and single pages with one bad label."""
    words = [a + b for a in ("alpha", "beta", "gamma", "delta", "omega", "sigma") for b in ("one", "two", "six", "ten", "old")]
    urls = [f"http://big.net/{w}/{100 * k + i}" for k, w in enumerate(words) for i in range(20)]
    urls += [f"http://big.net/lone{w}/{10000 + k}" for k, w in enumerate(words)]
    bad = [(100 * k + i, int(k in (3, 17))) for k in range(30) for i in range(20)] + [(10000, 1)]
    got = _judged(spark, urls, bad)
    for k, w in enumerate(words):
        want = ("block", f"/{w}/{{num}}") if k in (3, 17) else ("allow", "/{word}/{num}")
        assert set(got[20 * k:20 * k + 20]) == {want}, (k, got[20 * k])
    assert set(got[600:]) == {("allow", "/{word}/{num}")}


def test_url_filter_deep_paths(spark):
    urls = [f"http://deep.net/shop/en/2024/a/{s}/x/y/{1000 * k + i}" for k, s in enumerate(("casino", "help")) for i in range(40)]
    urls += ["http://one.net/a/b/c/d/e/f/g.html", "http://two.net/", "http://deep.net/shop/en"]
    got = _judged(spark, urls, [(1000 * k + i, 1 - k) for k in range(2) for i in range(30)])
    assert set(got[:40]) == {("block", "/shop/en/{num}/a/casino/x/y/{num}")}
    assert set(got[40:80]) == {("allow", "/shop/en/{num}/a/help/x/y/{num}")}
    assert [t for _, t in got[80:]] == ["/a/b/c/d/e/f/g.html", "/", "/shop/en"]


def test_html_extraction(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    model = html_extract.train(pages)
    odd = [(None, ""), ("", ""), ("<body><main><p>Tiny &amp; <b>bold</b>\n text.</p><p>Next", "Tiny & bold text. Next"),
           ("<article><h1>T</h1><p>Body one.<div class='ad'>Buy</div><form>x</form><p>Two&nbsp;.</article><section id=comments><p>Nice words, a lot of them. Yes.</p></section>", "T Body one. Two ."),
           ("<script>var a='<p>x</p>'</script>", "")]
    df = spark.createDataFrame([(k, "u", h) for k, (h, _) in enumerate(odd)], "page_id long, url string, html string").selectExpr("*", "'q' AS text")
    got = {r.page_id: r.text for r in html_extract.extract(df, model).collect()}
    assert [got[k] for k in range(len(odd))] == [t for _, t in odd]
    assert html_extract.extract(_empty(df)).count() == 0


def test_html_extraction_of_unclosed_elements(spark):
    model = html_extract.train(spark.read.parquet(f"{SF_SMALL}/pages.parquet"))
    body = "<article><h1>T</h1><p>Body one, and some more. Two.</p></article>"
    want = html_extract.main_text(body, model)
    assert want == "T Body one, and some more. Two."
    for tag in ("button", "select", "noscript", "object", "svg", "math", "iframe", "template"):
        assert html_extract.main_text(f"<{tag} class=x>{body}", model) == want, tag
        assert html_extract.main_text(f"<{tag}>{body}<div><{tag}>late</{tag}></div>", model) == want, tag  # the close is another's
        assert html_extract.main_text(f"<{tag}>a<{tag}>b</{tag}><p>c</p></{tag}>{body}", model) == want, tag
    assert html_extract.main_text(f"<script>{body}", model) == ""


def test_language_id(spark, docs):
    noise = "".join(chr(33 + (i * 7919) % 90) + chr(0x2500 + (i * 104729) % 400) for i in range(1500))
    rows, df = docs
    df = df.unionByName(df.limit(1).selectExpr("999999L AS doc_id", f"'{noise.replace(chr(92), '').replace(chr(39), '')}' AS text", "lang", "source",
                                               "n_chars", "key", "word", "start", "rid", "pos", "n"))
    got = {r.id: r for r in language_id.identify(language_id.document_rows(df)).collect()}
    known = [(i, lang) for i, _, lang, *_ in rows if i < 900000]
    assert np.mean([got[i].lang == lang for i, lang in known]) > 0.98
    assert all(got[i].kept for i, _ in known) and not got[999999].kept
    # held out: the declared language is wrong, the text speaks
    swapped = language_id.document_rows(df.filter("doc_id < 900000")).selectExpr(
        "kind", "id", "body", "CASE WHEN id % 20 = 0 THEN 'fr' ELSE declared END AS declared", "host", "suffix")
    got = {r.id: r for r in language_id.identify(swapped).collect()}
    assert np.mean([got[i].lang == lang for i, lang in known]) > 0.95
    kept = language_id.keep_identified(df)
    assert kept.columns == df.columns and kept.filter("doc_id = 999999").count() == 0
    assert language_id.identify(language_id.document_rows(_empty(df))).count() == 0


def test_language_id_of_rare_languages(spark):
    """A language with a share of 0.4%, and more than 64 languages."""
    rng = np.random.default_rng(11)

    def texts(letters, n):
        words = ["".join(rng.choice(list(letters), int(rng.integers(3, 9)))) for _ in range(60)]
        return [" ".join(rng.choice(words, 60)) for _ in range(n)]

    latin = texts("abcdefghijklmnop", 2000)
    rare = texts("абвгдежзиклмнопр", 8)
    rows = [(t, "en") for t in latin] + [(t, "ru") for t in rare]
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame([(k, t, l, "s") for k, (t, l) in enumerate(rows)], schema)
    got = {r.id: r for r in language_id.identify(language_id.document_rows(df)).collect()}
    assert all(got[k].lang == l and got[k].kept for k, (_, l) in enumerate(rows))
    rows = [(t, f"x{k:02}") for k in range(70) for t in texts([chr(0x4E00 + 40 * k + j) for j in range(16)], 4 + k % 3)]
    df = spark.createDataFrame([(k, t, l, "s") for k, (t, l) in enumerate(rows)], schema)
    languages, logs = language_id.train(language_id.document_rows(df).withColumn("body", F.col("body").cast("binary")))
    assert languages == [f"x{k:02}" for k in range(70)] and logs.shape == (70, language_id.TABLE)


def test_registered_sql(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    for key, sql in queries.SQL.items():
        df = queries.QUERIES[key](spark, SF_SMALL)
        cols = sorted(df.columns)
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert sorted(map(str, map(tuple, df.select(cols).collect()))) == sorted(map(str, want)), key


def test_pipeline(spark):
    import corpus_pipeline
    assert "pipeline" in E.queries() and len(corpus_pipeline.STAGES) == 5
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    sets = {}
    for i, t in rows:
        w = WORDS.findall(t.translate(LOWER))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            n = len(sets[a] & sets[b]) if a < b else 0
            if n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    keep = {i for i in sets if find(i) == i}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = set()
    for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect():
        w = word.findall(r.text.translate(LOWER))
        wins |= {tuple(w[k:k + 10]) for k in range(max(len(w) - 9, 1))}
    text = dict(rows)
    for i in list(keep):
        w = word.findall(text[i].translate(LOWER))
        if any(tuple(w[k:k + 10]) in wins for k in range(len(w) - 9)):
            keep.discard(i)
    assert {r.doc_id for r in out} == keep


def test_decontamination_separators_are_looked_up_one_by_one(spark):
    """Every ASCII character but 0-9, a-z, A-Z parts words; no ranges or intersections, which cost three times the time."""
    assert "&&" not in decontaminate.SEPARATOR and "-" not in decontaminate.SEPARATOR
    codes = [*range(0, 0x300), 0x2028, 0x1F600, 0x10FFFF]
    rows = spark.createDataFrame([(c, f"a{chr(c)}b") for c in codes], "c int, text string")
    got = {r.c: list(r.w) for r in rows.select("c", decontaminate._words(F.col("text")).alias("w")).collect()}
    assert got == {c: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", f"a{chr(c)}b") for c in codes}
