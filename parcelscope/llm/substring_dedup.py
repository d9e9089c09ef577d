"""Substring dedup by repeated word k-mers.

Edges are the k-mers of ``WINDOW`` words, as in a De Bruijn graph; the graph itself (nodes, degrees, paths
compacted by joins) is not built.  Neighbouring edges of a path are neighbours in each document, so merging
touching marks document by document gives the spans without shuffling nodes.  An edge that occurs twice is
repeated; all its occurrences but the one with the smallest source coordinate (doc_id,
start) are marked, and the words that marked edges cover are removed.

1. Every edge is dealt to the hash range of its minimizer (the least hash among its
   ``SEED``-word k-mers).  Neighbouring edges with one minimizer occurrence are a run, and a
   run travels as one piece: its start once, and the 64-bit hash of each edge, which identifies
   the edge within its range.
2. Edges repeated within a run of texts are marked at once and sent once; so an edge that
   many documents share costs a range one entry per run of texts, not per document.
3. A range groups its edges by identity and marks by source coordinate.
4. A join brings a document's marks together; marked edges that touch merge into one
   span of words, which is then cut out.

Nulls and texts of fewer than ``WINDOW`` words lose nothing.  A null doc_id counts as the
largest.  A document is a (doc_id, hash of its text): rows with both equal are repeated rows, lose
nothing on each other's account and give equal results; different texts under one doc_id (or none)
are documents of their own, and among equal (doc_id, start) the smaller text hash is first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix, n_partitions, window_hashes, word_hashes
from .ngram_join import by_group

WINDOW, SEED = 20, 6
NO_ID = (1 << 63) - 1
_MARKS = 1


def _rows(kind, r, blobs, docs, prints):
    return pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), pa.array(kind, pa.int8()), pa.array(docs, pa.int64()),
                                       pa.array(prints, pa.int64()), pa.array(blobs, pa.binary())],
                                      ["r", "kind", "doc_id", "print", "packed"])


def _dealt(ranges: int, w: int, k: int):
    """Rows (r, kind, doc_id, print, packed): runs of edges by hash range, and marks found at once."""
    span = w - k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [NO_ID if i is None else i for i in b.column(0).to_pylist()]
            texts = [x or b"" for x in b.column(2).to_pylist()]
            for ids_c, prints_c, texts_c in chunks(ids, b.column(1).to_pylist(), texts):
                # repeated rows count once: their marks are joined to each of them
                once = {key: i for i, key in enumerate(zip(ids_c, prints_c))}
                order = [once[key] for key in sorted(once)]
                doc_ids = np.array([ids_c[i] for i in order], np.int64)
                prints = np.array([prints_c[i] for i in order], np.int64)
                h, counts = word_hashes([texts_c[i] for i in order])
                edges = np.maximum(counts - w + 1, 0)
                total = int(edges.sum())
                if not total:
                    continue
                begin = np.cumsum(counts) - counts
                doc = np.repeat(np.arange(len(counts)), edges)
                pos = np.arange(total) - np.repeat(np.cumsum(edges) - edges, edges)  # start within its document
                at = begin[doc] + pos
                eh = window_hashes(h, w)[at]
                seeds = window_hashes(h, k)
                lead = np.empty(total, np.int64)
                for lo in range(0, total, 200_000):
                    views = np.lib.stride_tricks.sliding_window_view(seeds, span)[at[lo:lo + 200_000]]
                    lead[lo:lo + 200_000] = views.argmin(axis=1)
                q = at + lead
                # marks within this run of texts
                if (doc_ids[1:] == doc_ids[:-1]).any():  # several texts of one doc_id: the earlier start is first
                    by = np.lexsort((prints[doc], pos, doc_ids[doc]))
                    first = by[np.unique(eh[by], return_index=True)[1]]
                else:
                    first = np.unique(eh, return_index=True)[1]
                dup = np.ones(total, bool)
                dup[first] = False
                if dup.any():
                    d, p = doc[dup], pos[dup]
                    cut = np.concatenate(([0], np.flatnonzero(np.diff(d)) + 1, [len(d)])).tolist()
                    yield _rows([_MARKS] * (len(cut) - 1), [int(doc_ids[d[x]]) % ranges for x in cut[:-1]],
                                [p[x:y].astype(np.uint32).tobytes() for x, y in zip(cut, cut[1:])],
                                [int(doc_ids[d[x]]) for x in cut[:-1]], [int(prints[d[x]]) for x in cut[:-1]])
                # runs: neighbouring edges of a document with one minimizer occurrence
                new = np.concatenate(([True], (q[1:] != q[:-1]) | (doc[1:] != doc[:-1])))
                start = np.flatnonzero(new)
                length = np.diff(np.concatenate((start, [total])))
                alive = np.add.reduceat((~dup).astype(np.int64), start) > 0
                start, length = start[alive], length[alive]
                sh = mix(seeds[q[start]] ^ np.uint64(0x5851F42D4C957F2D))
                where = ((sh >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                o = np.argsort(where, kind="stable")
                start, length, where = start[o], length[o], where[o]
                cut = np.concatenate(([0], np.flatnonzero(np.diff(where)) + 1, [len(where)])).tolist()
                r_out, b_out = [], []
                for x, y in zip(cut, cut[1:]):
                    s, n = start[x:y], length[x:y]
                    du, dn = np.unique(doc[s], return_counts=True)
                    every = np.repeat(s - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    r_out.append(int(where[x]))
                    b_out.append(np.array([len(du), y - x], np.uint32).tobytes() + doc_ids[du].tobytes() + prints[du].tobytes() + dn.astype(np.uint32).tobytes()
                                 + pos[s].astype(np.uint32).tobytes() + n.astype(np.uint8).tobytes() + eh[every].tobytes())
                yield _rows([0] * len(r_out), r_out, b_out, [None] * len(r_out), [None] * len(r_out))
    return run


def _unpacked(blob: bytes):
    """doc_id, text hash, start and identity of every edge of a packed row."""
    m, n = (int(x) for x in np.frombuffer(blob, np.uint32, 2))
    at = 8
    out = []
    for kind, size in ((np.int64, m), (np.int64, m), (np.uint32, m), (np.uint32, n), (np.uint8, n)):
        out.append(np.frombuffer(blob, kind, size, at))
        at += out[-1].nbytes
    ids, prints, runs, pos, length = out
    ident = np.frombuffer(blob, np.uint64, -1, at)
    length = length.astype(np.int64)
    step = np.arange(len(ident)) - np.repeat(np.cumsum(length) - length, length)
    return (np.repeat(np.repeat(ids, runs), length), np.repeat(np.repeat(prints, runs), length),
            np.repeat(pos.astype(np.int64), length) + step, ident)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per hash range: the starts of all occurrences but the first, as rows (doc_id, print, starts)."""
    names = ["doc_id", "print", "starts"]
    for (_, kind), (docs, prints, blobs) in by_group(batches, 2):
        if kind == _MARKS:
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(prints, pa.int64()), pa.array(blobs, pa.binary())], names)
            continue
        parts = [_unpacked(x) for x in blobs]
        doc, text, pos, ident = (np.concatenate([p[i] for p in parts]) for i in range(4))
        del parts
        o = np.argsort(ident)
        s = ident[o]
        same = s[1:] == s[:-1]
        many = o[np.concatenate((same, [False])) | np.concatenate(([False], same))]
        if not len(many):
            continue
        doc, text, pos, ident = doc[many], text[many], pos[many], ident[many]
        o = np.lexsort((text, pos, doc, ident))
        doc, text, pos, ident = doc[o], text[o], pos[o], ident[o]
        # every occurrence whose coordinate differs from the first of its identity
        head = np.concatenate(([True], ident[1:] != ident[:-1]))
        src = np.flatnonzero(head)[np.cumsum(head) - 1]
        later = (doc != doc[src]) | (text != text[src]) | (pos != pos[src])
        doc, text, pos = doc[later], text[later], pos[later]
        o = np.lexsort((pos, text, doc))
        doc, text, pos = doc[o], text[o], pos[o].astype(np.uint32)
        if not len(doc):
            continue
        at = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]))))
        ends = np.concatenate((at, [len(doc)])) * 4
        packed = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(pos.tobytes())])
        for lo in range(0, len(at), 20000):
            some = at[lo:lo + 20000]
            yield pa.RecordBatch.from_arrays([pa.array(doc[some]), pa.array(text[some]), packed.slice(lo, 20000).cast(pa.binary())], names)


def _cut(w: int):
    """Spans and kept text of every document from its marks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[] for _ in range(5)]
            for doc, text, marks in zip(*[c.to_pylist() for c in b.columns]):
                words = (text or b"").split()  # bytes.split: runs of space and U+0009..U+000D
                spans, kept, removed = [], words, 0
                if marks:
                    p = np.unique(np.concatenate([np.frombuffer(m, np.uint32) for m in marks])).astype(np.int64)
                    p = p[p < len(words)]
                    # a path ends where the next marked edge does not touch its words
                    edge = np.flatnonzero(np.concatenate(([True], p[1:] > p[:-1] + w, [True])))
                    spans = [(int(p[x]), min(int(p[y - 1]) + w, len(words))) for x, y in zip(edge[:-1], edge[1:])]
                    kept, at = [], 0
                    for lo, hi in spans:
                        kept += words[at:lo]
                        removed += hi - lo
                        at = hi
                    kept += words[at:]
                for o, v in zip(out, (doc, len(words), removed, [{"start": x, "stop": y} for x, y in spans], b" ".join(kept))):
                    o.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                 pa.array(out[4], pa.binary())], ["doc_id", "n_words", "n_removed", "spans", "kept"])
    return run


def remove_repeats(documents: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, spans of removed words, kept (UTF-8 text, words joined by a space)."""
    parts = n_partitions(documents.sparkSession)
    text = F.col("text").cast("binary")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"), text.alias("text"))
    dealt = docs.mapInArrow(_dealt(parts, window, seed), "r int, kind byte, doc_id long, print long, packed binary")
    marks = (dealt.repartition(parts, "r").sortWithinPartitions("r", "kind")
             .mapInArrow(_marked, "doc_id long, print long, starts binary")
             .groupBy(F.col("doc_id").alias("_id"), F.col("print").alias("_print")).agg(F.collect_list("starts").alias("starts")))
    mine = (F.coalesce("doc_id", F.lit(NO_ID)) == F.col("_id")) & (F.col("print") == F.col("_print"))
    joined = docs.join(marks, mine, "left").select("doc_id", "text", "starts")
    return joined.mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, "
                                           "spans array<struct<start:bigint,stop:bigint>>, kept binary")


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
