"""N-gram Jaccard join by signature trees.

A text's set is its distinct ``NGRAM``-word shingles (the whole sequence if it has fewer words), as
64-bit hashes.  Two texts link when ``100 * intersection >= PERCENT * union``.

1. Texts with equal sets are one class (a 64-bit key of the set); copies are never paired.
2. Shingles are dealt by hash range (one packed row per range and run of texts), where
   those in two or more classes are kept with their class count.  A class with too many
   shingles of its own can have no partner (prefix principle: a partner must share one of
   the ``n - ceil(0.85 n) + 1`` rarest) and leaves here.
3. Classes that share a prefix shingle form candidate groups (connected components).
4. In a group, classes become leaves of a signature tree: every node holds the OR of
   its classes' token bitmaps and their size range.  Two nodes are traversed together and
   dropped when the sizes cannot fit or when the largest overlap that the bitmaps allow is too small;
   leaf pairs are counted exactly (products of 0/1 matrices over their shingles).
   Groups beyond ``BLOCK`` classes are cut into blocks, and pairs of blocks are tasks.
5. Components over the links give each document's class id.

A hash range holds as many shingle entries as the shuffle partitions ask for; one shingle
costs 5 bytes per *different* text that has it.  Nulls and texts without words have an empty
set, link with nothing and are their own component.  Repeated doc_ids each give a row.  A
null doc_id is carried along and counts as larger than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, n_partitions, slices, tidy, window_hashes, without, word_hashes, written
from .graph import components

NGRAM, PERCENT = 4, 85
BLOCK = 2000
HASHED_BYTES = 512 << 10  # text bytes hashed at once, about 60 bytes of arrays each
LEAF, FAN, BITS = 32, 8, 1024


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text, A-Z lower-cased."""
    h, counts = word_hashes(texts, lower=True)
    grams = window_hashes(h, n)
    out, at = [], 0
    for c in counts.tolist():
        if c >= n:
            out.append(np.unique(grams[at:at + c - n + 1]))
        elif c:
            out.append(window_hashes(h[at:at + c], c))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def _key(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _keys_of(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for ids, texts in chunks(b.column(0).to_pylist(), _bytes(b.column(1)), limit=HASHED_BYTES):
                sets = shingle_sets(texts, n)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array([_key(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64())], ["doc_id", "key", "n"])
    return run


TEXTS, SHINGLES = 0, 1


def _dealt(n: int, ranges: int):
    """Rows (r, kind, run, packed).  For a run of texts: its keys and sizes once, and its shingles by hash range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        number = TaskContext.get().partitionId() << 32
        for b in slices(batches):
            for (texts,) in chunks(_bytes(b.column(0)), limit=2 * HASHED_BYTES):
                keys, sets = [], []
                for s in shingle_sets(texts, n):
                    k = _key(s)
                    if len(s) and k not in seen:  # a copy in this partition adds nothing
                        seen.add(k)
                        keys.append(k)
                        sets.append(s)
                if len(seen) > 1_000_000:
                    seen.clear()
                if not sets:
                    continue
                sizes = np.array([len(s) for s in sets], np.uint32)
                karr = np.array(keys, np.int64)
                print32 = (karr.view(np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                flat = np.concatenate(sets)
                doc = np.repeat(np.arange(len(sets)), sizes)
                where = ((flat >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(where, kind="stable")  # by range, then text, then hash
                flat, doc, where = flat[order], doc[order], where[order]
                cut = [0, *(np.flatnonzero(np.diff(where)) + 1).tolist(), len(flat)]
                rows_r, rows_k = [number % ranges], [TEXTS]
                rows_b = [np.uint32(len(sets)).tobytes() + karr.tobytes() + sizes.tobytes()]
                for lo, hi in zip(cut, cut[1:]):
                    d, counts = np.unique(doc[lo:hi], return_counts=True)
                    part = flat[lo:hi]
                    rows_r.append(int(where[lo]))
                    rows_k.append(SHINGLES)
                    # the low 40 bits; the range and these tell shingles apart
                    rows_b.append(np.uint32(len(d)).tobytes() + d.astype(np.uint16).tobytes() + counts.astype(np.uint32).tobytes()
                                  + print32[d].tobytes() + (part & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()
                                  + ((part >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(rows_r, pa.int32()), pa.array(rows_k, pa.int8()),
                                                  pa.array([number] * len(rows_r), pa.int64()), pa.array(rows_b, pa.binary())],
                                                 ["r", "kind", "run", "packed"])
                number += 1
    return run


def _unpacked(blob: bytes):
    """Of one run in one range: text numbers, their prints (both by shingle) and hashes."""
    m = int(np.frombuffer(blob, np.uint32, 1)[0])
    at = 4
    d = np.frombuffer(blob, np.uint16, m, at)
    at += 2 * m
    counts = np.frombuffer(blob, np.uint32, m, at)
    at += 4 * m
    prints = np.frombuffer(blob, np.uint32, m, at)
    at += 4 * m
    total = int(counts.sum())
    low = np.frombuffer(blob, np.uint32, total, at)
    high = np.frombuffer(blob, np.uint8, total, at + 4 * total)
    return np.repeat(d, counts), np.repeat(prints, counts), low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))


TOKEN = np.dtype([("doc", "<u2"), ("df", "u1"), ("high", "u1"), ("low", "<u4")])


def by_group(batches: Iterator[pa.RecordBatch], width: int = 1) -> Iterator[tuple[tuple, list]]:
    """Consecutive rows with equal first ``width`` columns (input sorted by them): (key, columns)."""
    key, held = None, None
    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        for row in zip(*cols):
            if row[:width] != key:
                if held:
                    yield key, [list(c) for c in zip(*held)]
                key, held = row[:width], []
            held.append(row[width:])
    if held:
        yield key, [list(c) for c in zip(*held)]


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per hash range: the shingles of two or more classes, one row (run, r, packed) for each run of texts."""
    for (r, kind), (runs, blobs) in by_group(batches, 2):
        if kind == TEXTS:
            yield pa.RecordBatch.from_arrays([pa.array(runs, pa.int64()), pa.array([-1] * len(runs), pa.int32()),
                                              pa.array(blobs, pa.binary())], ["run", "r", "packed"])
            continue
        parts = [_unpacked(x) for x in blobs]
        of = np.repeat(np.arange(len(parts)), [len(p[2]) for p in parts])
        doc, prints, h = (np.concatenate([p[i] for p in parts]) for i in range(3))
        del parts
        order = np.argsort(h)
        hs = h[order]
        same = hs[1:] == hs[:-1]
        many = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
        if not len(many):
            continue
        # copies of one class count once: distinct prints of each shingle
        many = many[np.lexsort((prints[many], h[many]))]
        h, prints, doc, of = h[many], prints[many], doc[many], of[many]
        head = np.concatenate(([True], h[1:] != h[:-1]))
        fresh = head | np.concatenate(([True], prints[1:] != prints[:-1]))
        df = np.add.reduceat(fresh.astype(np.int64), np.flatnonzero(head))[np.cumsum(head) - 1]
        keep = df > 1
        h, doc, of, df = h[keep], doc[keep], of[keep], df[keep]
        order = np.argsort(of, kind="stable")
        tok = np.zeros(len(h), TOKEN)
        tok["doc"], tok["df"] = doc[order], np.minimum(df[order], 255)
        tok["low"], tok["high"] = h[order] & np.uint64(0xFFFFFFFF), h[order] >> np.uint64(32)
        bounds = np.searchsorted(of[order], np.arange(len(runs) + 1)).tolist()
        for i, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
            if hi > lo:
                yield pa.RecordBatch.from_arrays([pa.array([runs[i]], pa.int64()), pa.array([r], pa.int32()),
                                                  pa.array([tok[lo:hi].tobytes()], pa.binary())], ["run", "r", "packed"])


def _prefixes(percent: int):
    """Rows sorted by run: its classes that may have a partner, as (key, n, tokens sorted, prefix)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (ranges, blobs) in by_group(batches):
            head = blobs[ranges.index(-1)]
            m = int(np.frombuffer(head, np.uint32, 1)[0])
            keys, sizes = np.frombuffer(head, np.int64, m, 4), np.frombuffer(head, np.uint32, m, 4 + 8 * m).astype(np.int64)
            toks = [(r, np.frombuffer(x, TOKEN)) for r, x in zip(ranges, blobs) if r >= 0]
            if not toks:
                continue
            doc = np.concatenate([t["doc"] for _, t in toks])
            df = np.concatenate([t["df"] for _, t in toks])
            h = np.concatenate([t["low"].astype(np.uint64) | (t["high"].astype(np.uint64) << np.uint64(32))
                                | (np.uint64(r) << np.uint64(40)) for r, t in toks])
            order = np.lexsort((h, df, doc))
            doc, h = doc[order], h[order]
            bounds = np.searchsorted(doc, np.arange(m + 1))
            need = -(-percent * sizes // 100)
            take = (sizes - need + 1) - (sizes - np.diff(bounds))  # prefix length without the shingles of its own
            out = [[], [], [], []]
            for d in np.flatnonzero(take > 0).tolist():
                t = h[bounds[d]:bounds[d + 1]]
                for o, v in zip(out, (int(keys[d]), int(sizes[d]), np.sort(t).tobytes(), t[: take[d]].astype(np.int64))):
                    o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()),
                                              pa.array(out[3], pa.list_(pa.int64()))], ["key", "n", "tokens", "prefix"])
    return run


class SignatureTree:
    """Classes (size, sorted tokens) as leaves below nodes with OR-combined bitmaps and size ranges."""

    def __init__(self, sizes: np.ndarray, tokens: list[np.ndarray]):
        low = [int(t[0]) if len(t) else 0 for t in tokens]
        self.order = np.lexsort((sizes, low))  # texts with a common smallest shingle stand together
        self.sizes = sizes[self.order]
        self.tokens = [tokens[i] for i in self.order]
        bits = np.zeros((len(sizes), BITS // 8), np.uint8)
        for i, t in enumerate(self.tokens):
            b = (t * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(54)).astype(np.int64)
            bits[i] = np.packbits(np.bincount(b, minlength=BITS)[:BITS] > 0)
        held = np.array([len(t) for t in self.tokens])
        extra = held - np.unpackbits(bits, axis=1).sum(axis=1)  # tokens that share a bit
        # levels from the leaves up: bitmap, smallest and largest size, most shared bits
        cut = np.arange(0, len(sizes), LEAF)
        level = (np.bitwise_or.reduceat(bits, cut), np.minimum.reduceat(self.sizes, cut),
                 np.maximum.reduceat(self.sizes, cut), np.maximum.reduceat(extra, cut))
        self.levels = [level]
        while len(level[1]) > 1:
            cut = np.arange(0, len(level[1]), FAN)
            level = (np.bitwise_or.reduceat(level[0], cut), np.minimum.reduceat(level[1], cut),
                     np.maximum.reduceat(level[2], cut), np.maximum.reduceat(level[3], cut))
            self.levels.append(level)


_POP = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int32)


def leaf_pairs(a: SignatureTree, b: SignatureTree, percent: int) -> Iterator[tuple[int, int]]:
    """Dual traversal: pairs of leaves that may hold a link (each unordered pair once if a is b)."""
    stack = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        if a is b and la == lb and i > j:
            continue
        ba, mina, maxa, xa = (x[i] for x in a.levels[la])
        bb, minb, maxb, xb = (x[j] for x in b.levels[lb])
        if 100 * maxa < percent * minb or 100 * maxb < percent * mina:
            continue  # sizes cannot fit
        most = int(_POP[ba & bb].sum()) + min(int(xa), int(xb))
        if 100 * most < percent * max(mina, minb):
            continue  # the bitmaps cannot overlap enough
        if la == 0 and lb == 0:
            yield int(i), int(j)
        elif la >= lb and la > 0 and not (a is b and la == lb):
            stack += [(la - 1, k, lb, j) for k in range(i * FAN, min((i + 1) * FAN, len(a.levels[la - 1][1])))]
        elif a is b and la == lb:
            stack += [(la - 1, k, lb - 1, m) for k in range(i * FAN, min((i + 1) * FAN, len(a.levels[la - 1][1])))
                      for m in range(j * FAN, min((j + 1) * FAN, len(b.levels[lb - 1][1])))]
        else:
            stack += [(la, i, lb - 1, k) for k in range(j * FAN, min((j + 1) * FAN, len(b.levels[lb - 1][1])))]


def links(a: SignatureTree, b: SignatureTree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Exact links as index pairs (into the input order of a and b)."""
    for i, j in leaf_pairs(a, b, percent):
        ia, ib = range(i * LEAF, min((i + 1) * LEAF, len(a.tokens))), range(j * LEAF, min((j + 1) * LEAF, len(b.tokens)))
        ta, tb = [a.tokens[k] for k in ia], [b.tokens[k] for k in ib]
        vocab, code = np.unique(np.concatenate(ta + tb), return_inverse=True)
        m = np.zeros((len(ta) + len(tb), len(vocab)), np.float32)
        m[np.repeat(np.arange(len(ta) + len(tb)), [len(t) for t in ta + tb]), code] = 1
        both = m[: len(ta)] @ m[len(ta):].T
        na, nb = a.sizes[i * LEAF: i * LEAF + len(ta), None], b.sizes[None, j * LEAF: j * LEAF + len(tb)]
        x, y = np.nonzero(100 * both.astype(np.int64) >= percent * (na + nb - both.astype(np.int64)))
        if a is b and i == j:
            x, y = x[x < y], y[x < y]
        if len(x):
            yield a.order[x + i * LEAF], b.order[y + j * LEAF]


def _group_links(percent: int):
    """Rows sorted by (group, i, j): links of each block pair as (key, n_links, root)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), (block, key, n, weight, tokens) in by_group(batches, 3):
            key, n, weight, block = np.array(key), np.array(n), np.array(weight), np.array(block)
            sets = [np.frombuffer(t, np.uint64) for t in tokens]
            of = [np.flatnonzero(block == x) for x in ((i,) if i == j else (i, j))]
            if any(len(x) == 0 for x in of):
                continue
            trees = [SignatureTree(n[x], [sets[k] for k in x]) for x in of]
            count, root = np.zeros(len(key), np.int64), np.arange(len(key))

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for x, y in links(trees[0], trees[-1], percent):
                x, y = of[0][x], of[-1][y]
                np.add.at(count, x, weight[y])
                np.add.at(count, y, weight[x])
                for p, q in zip(x.tolist(), y.tolist()):
                    p, q = find(p), find(q)
                    if p != q:
                        root[max(p, q)] = min(p, q)
            linked = np.flatnonzero(count)
            if len(linked):
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[linked]), pa.array(count[linked]), pa.array([int(key[find(k)]) for k in linked.tolist()], pa.int64())],
                    ["key", "links", "root"])
    return run


def jaccard_classes(documents: DataFrame, ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id, n_links (documents it links with)."""
    spark = documents.sparkSession
    parts = n_partitions(spark)
    text = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    docs = written(text.mapInArrow(tidy(_keys_of(ngram)), "doc_id long, key long, n long"), "keys")
    classes = docs.filter("key is not null").groupBy("key").agg(F.count("*").alias("weight"), F.min("doc_id").alias("least"))

    dealt = text.select("text").mapInArrow(tidy(_dealt(ngram, parts)), "r int, kind byte, run long, packed binary")
    tokens = (dealt.repartition(parts, "r").sortWithinPartitions("r", "kind")
              .mapInArrow(tidy(_repeated), "run long, r int, packed binary"))
    cand = written(tokens.repartition(parts, "run").sortWithinPartitions("run")
                   .mapInArrow(tidy(_prefixes(percent)), "key long, n long, tokens binary, prefix array<long>")
                   .dropDuplicates(["key"]), "candidates")
    # candidate groups: classes that share a prefix shingle
    pre = cand.select("key", F.explode("prefix").alias("t"))
    centre = pre.groupBy("t").agg(F.min("key").alias("c"), F.count("*").alias("m")).filter("m > 1")
    group = components(pre.join(centre.select("t", "c"), "t").filter("key <> c").select(F.col("key").alias("a"), F.col("c").alias("b")))
    sizes = group.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    member = (cand.select("key", "n", "tokens").join(group.withColumnRenamed("node", "key"), "key").join(sizes, "root")
              .join(classes.select("key", "weight"), "key")
              .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    pairs = member.withColumn("o", F.explode(others)).select(
        "root", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "key", "n", "weight", "tokens")
    found = (pairs.repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j")
             .mapInArrow(tidy(_group_links(percent)), "key long, links long, root long"))
    found = written(found, "links")
    comp = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    least = (comp.withColumnRenamed("node", "key").join(classes.select("key", "least"), "key")
             .groupBy("root").agg(F.min("least").alias("component")))
    linked = (found.groupBy("key").agg(F.sum("links").alias("links"))
              .join(comp.withColumnRenamed("node", "key"), "key").join(least, "root").select("key", "links", "component"))
    per = classes.join(linked, "key", "left").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "least").alias("component_id"))
    return docs.join(per, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(documents: DataFrame, ngram: int, percent: int) -> DataFrame:
    """One document of each component (the smallest doc_id); texts without words stay.  Columns kept."""
    classes = jaccard_classes(documents, ngram, percent)
    gone = classes.filter("component_id is not null and doc_id <> component_id").select("doc_id").distinct()
    return without(documents, gone)
