"""Best-fit packing of tokenized documents by a grouping genetic algorithm on islands.

A document is its token ids and a closing id ``EOS``.  Longer ones than ``CAPACITY`` are cut into
full pieces, the first of which holds the remainder; full pieces are sequences of their own.

The other pieces are dealt to blocks of about ``BLOCK`` pieces.  Every block evolves on
``ISLANDS`` islands: an individual is a set of bins (sequences); crossover injects the other
parent's best-filled bins whole, removes the bins that then hold a piece twice, and puts the
displaced pieces back by best fit, longest first.  After each epoch the islands' elites
migrate to the next island through a shuffle; the best island of a block gives its sequences.
Work and memory per task depend on ``BLOCK`` only, whatever the number of documents.

Token ids are those of the tokenizer's vocabulary file: a text is cut before every
space that a word follows, where no pre-token can reach across, and each distinct cut
is encoded once.  Null texts are empty (one piece: ``EOS``).  Repeated rows are packed each.
"""

from __future__ import annotations

import os
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import _B, _BI, _powers, chunks, mix, n_partitions, slices, tidy, written
from .ngram_join import by_group

CAPACITY, EOS = 2048, 0
BLOCK, ISLANDS, EPOCHS, POPULATION, INJECTED = 4096, 2, 2, 6, 0.3
GENERATIONS, PATIENCE = 40, 4  # at most, and without a better individual
SLACK = 24  # tokens that an exact completion of a sequence may leave free
CACHE = 200_000  # cuts that an encoder keeps, about 60 bytes each
ENCODED_BYTES = 256 << 10  # text bytes encoded at once, about 60 bytes of arrays each

# bytes that may begin white space, after which a space is not cut from what follows
_NO_CUT = np.zeros(256, bool)
_NO_CUT[:33] = True
_NO_CUT[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of many texts at once; distinct cuts are encoded once and kept (up to CACHE of them)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.encode = self._fast(path) or (lambda s, t=Tokenizer.from_file(path): t.encode(s, add_special_tokens=False).ids)
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    @staticmethod
    def _fast(path: str):
        """The same vocabulary given as ranks beside the file, if it is there."""
        ranks = path.removesuffix(".json") + ".tiktoken"
        if not os.path.exists(ranks):
            return None
        import base64
        import json

        import public_tokenizers
        import tiktoken
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(path, encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special)
        names = tuple(special)
        return lambda s: enc.encode(s, allowed_special="all") if any(x in s for x in names) else enc.encode_ordinary(s)

    def _learn(self, hashes: np.ndarray, cuts: list[bytes]) -> None:
        """Adds cuts (sorted by hash) that are not known yet."""
        new = [self.encode(c.decode(errors="replace")) for c in cuts]
        size = np.array([len(x) for x in new], np.int64)
        at = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate((self.pool, np.array([i for x in new for i in x], np.uint32)))
        where = np.searchsorted(self.hashes, hashes)
        self.hashes, self.at, self.size = (np.insert(x, where, y) for x, y in (
            (self.hashes, hashes), (self.at, at), (self.size, size)))

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text closed by EOS, and the number of ids of each text."""
        buf = b"\n".join(texts) + b"\n"  # the separators are cut away again
        a = np.frombuffer(buf, np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        begins = np.concatenate(([0], ends[:-1] + 1))
        first_of = np.zeros(len(a), bool)
        first_of[:-1] = (a[:-1] == 32) & ~_NO_CUT[a[1:]]
        first_of[begins[begins < ends]] = True
        starts = np.flatnonzero(first_of)
        text_of = np.searchsorted(ends, starts, side="right")
        stops = np.minimum(np.concatenate((starts[1:], [len(a)])), ends[text_of])
        n = len(a)
        s = np.concatenate((np.zeros(1, np.uint64), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * _powers(_B, n), dtype=np.uint64)))
        h = mix((s[stops] - s[starts]) * _powers(_BI, n)[starts] + (stops - starts).astype(np.uint64))
        u, first, code = np.unique(h, return_index=True, return_inverse=True)
        if len(self.hashes) > CACHE:
            self._forget()
        place = np.searchsorted(self.hashes, u)
        fresh = np.ones(len(u), bool)
        inside = place < len(self.hashes)
        fresh[inside] = self.hashes[place[inside]] != u[inside]
        if fresh.any():
            f = first[fresh]
            self._learn(u[fresh], [buf[x:y] for x, y in zip(starts[f].tolist(), stops[f].tolist())])
            place = np.searchsorted(self.hashes, u)
        at, n_of = self.at[place][code], self.size[place][code]
        counts = np.bincount(text_of, weights=n_of, minlength=len(texts)).astype(np.int64)
        src = np.repeat(at - (np.cumsum(n_of) - n_of), n_of) + np.arange(int(n_of.sum()))
        out = np.full(int(counts.sum()) + len(texts), EOS, np.uint32)
        keep = np.ones(len(out), bool)
        keep[np.cumsum(counts + 1) - 1] = False
        out[keep] = self.pool[src]
        return out, counts + 1


_ENCODERS: dict[str, Encoder] = {}


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _ENCODERS.setdefault(path, None) or Encoder(path)
        _ENCODERS[path] = enc  # its vocabulary is kept by the Python worker for its next task, its cuts are not
        enc._forget()
        for b in slices(batches):
            texts = [x or b"" for x in b.column(1).to_pylist()]
            for docs, part in chunks(b.column(0).to_pylist(), texts, limit=ENCODED_BYTES):
                ids, counts = enc.ids(part)
                rows, at = [], 0
                for doc, n in zip(docs, counts.tolist()):
                    start, piece = 0, 0
                    stop = n % capacity or min(n, capacity)
                    while start < n:
                        rows.append((doc, piece, start, stop - start, zlib.crc32(ids[at + start:at + stop].astype("<u4").tobytes())))
                        start, stop, piece = stop, stop + capacity, piece + 1
                    at += n
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([
                    pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:]]],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
        enc._forget()
    return run


def _best_fit(bins: list[list[int]], free: list[int], items: list[int], size: list[int], capacity: int) -> None:
    """Puts items into the fullest bins that take them, in the given order."""
    by_free: dict[int, list[int]] = {}
    mask = 0
    for i, f in enumerate(free):
        by_free.setdefault(f, []).append(i)
        mask |= 1 << f
    for it in items:
        s = size[it]
        fits = mask >> s
        if fits:
            f = s + (fits & -fits).bit_length() - 1
            row = by_free[f]
            i = row.pop()
            if not row:
                mask &= ~(1 << f)
            bins[i].append(it)
        else:
            i, f = len(bins), capacity
            bins.append([it])
            free.append(capacity)
        f -= s
        free[i] = f
        by_free.setdefault(f, []).append(i)
        mask |= 1 << f


class Individual:
    def __init__(self, bins: list[list[int]], size: list[int], capacity: int):
        self.bins = bins
        self.fill = [sum(size[i] for i in b) for b in bins]
        self.score = (-len(bins), sum((f / capacity) ** 2 for f in self.fill))  # fewer bins, then uneven fill


def _completed(items: list[int], size: list[int], capacity: int, rng: random.Random, noise: float) -> list[list[int]]:
    """Bins of ``items``: each begins with a long one (by chance ``noise`` not the longest) and takes the one or two pieces
    that fill it best, looked up in a bitmap of the lengths left and its mirror image."""
    by: dict[int, list[int]] = {}
    for it in items:
        by.setdefault(size[it], []).append(it)
    mask = mirror = 0
    for s in by:
        mask |= 1 << s
        mirror |= 1 << (capacity - s)
    left, bins = len(items), []

    def take(s: int) -> int:
        nonlocal mask, mirror, left
        row = by[s]
        it = row.pop()
        left -= 1
        if not row:
            mask &= ~(1 << s)
            mirror &= ~(1 << (capacity - s))
        return it

    def filling(free: int) -> tuple[int, ...]:
        """Lengths of one or two pieces that leave least free, else the longest that fits."""
        for t in range(free, max(0, free - SLACK), -1):
            if mask >> t & 1:
                return (t,)
            pairs = mask & (mirror >> (capacity - t)) & ((1 << t) - 1)
            while pairs:
                x = pairs.bit_length() - 1
                if 2 * x != t or len(by[x]) > 1:
                    return x, t - x
                pairs &= ~(1 << x)
        return ((mask & ((2 << free) - 1)).bit_length() - 1,)

    while left:
        s = mask.bit_length() - 1
        if noise and rng.random() < noise:
            least = int(s * (0.5 + 0.5 * rng.random()))
            above = mask >> least
            s = least + (above & -above).bit_length() - 1
        row, free = [take(s)], capacity - s
        while free > 0 and mask & ((2 << free) - 1):
            for x in filling(free):
                row.append(take(x))
                free -= x
        bins.append(row)
    return bins


def _seeded(size: list[int], capacity: int, rng: random.Random, noise: float | None) -> Individual:
    """Best fit, longest first (no noise given), or bins completed one by one."""
    order = sorted(range(len(size)), key=lambda i: -size[i])
    if noise is not None:
        return Individual(_completed(order, size, capacity, rng, noise), size, capacity)
    bins: list[list[int]] = []
    _best_fit(bins, [], order, size, capacity)
    return Individual(bins, size, capacity)


def _cross(a: Individual, b: Individual, size: list[int], capacity: int, rng: random.Random) -> Individual:
    """b's best-filled bins whole, a's bins that do not clash, the displaced by best fit.

    The emptiest bins are opened as well; of their pieces and the displaced, well-filled bins are made again as far
    as they go, and the pieces of the others are put back by best fit, longest first.
    """
    ranked = sorted(range(len(b.bins)), key=lambda i: -b.fill[i] + rng.random() * 0.01 * capacity)
    given = ranked[: max(1, int(INJECTED * len(ranked) * (0.5 + rng.random())))]
    inside = bytearray(len(size))
    for i in given:
        for it in b.bins[i]:
            inside[it] = 1
    bins, free, loose = [b.bins[i][:] for i in given], [capacity - b.fill[i] for i in given], []
    for x, f in zip(a.bins, a.fill):
        if any(inside[it] for it in x):
            loose += [it for it in x if not inside[it]]
        else:
            bins.append(x[:])
            free.append(capacity - f)
    worst = sorted(range(len(bins)), key=lambda i: -free[i])[: max(1, len(bins) // 20)]
    worst += [i for i in range(len(bins)) if free[i] > SLACK]
    for i in sorted(set(worst), reverse=True):
        loose += bins.pop(i)
        free.pop(i)
    again = _completed(loose, size, capacity, rng, rng.random())
    loose = []
    for x in again:
        f = capacity - sum(size[it] for it in x)
        if f <= SLACK:
            bins.append(x)
            free.append(f)
        else:
            loose += x
    loose.sort(key=lambda it: -size[it])
    _best_fit(bins, free, loose, size, capacity)
    return Individual(bins, size, capacity)


def evolve(size: list[int], capacity: int, seeds: list[list[int]], seed: int) -> list[int]:
    """The bin of every item after some generations; ``seeds``: elites (bin of every item) that join."""
    rng = random.Random(seed)
    pop = []
    for assigned in seeds:
        bins: dict[int, list[int]] = {}
        for it, b in enumerate(assigned):
            bins.setdefault(b, []).append(it)
        pop.append(Individual(list(bins.values()), size, capacity))
    bound = -(-sum(size) // capacity)
    if not any(len(p.bins) == bound for p in pop):  # a block at its bound is done
        pop.append(_seeded(size, capacity, rng, None))
    while len(pop) < POPULATION and not any(len(p.bins) == bound for p in pop):
        pop.append(_seeded(size, capacity, rng, 0.2 * (len(pop) - 1)))
    pop.sort(key=lambda p: p.score, reverse=True)
    idle = 0
    for _ in range(GENERATIONS):
        if len(pop[0].bins) == bound or idle == PATIENCE:
            break  # no packing has fewer, or none better was found for long
        before = pop[0].score
        for _ in range(2):
            x, y = sorted(rng.sample(range(len(pop)), 2))
            pop.append(_cross(pop[x], pop[y], size, capacity, rng))
        pop = sorted(pop, key=lambda p: p.score, reverse=True)[:POPULATION]
        idle = 0 if pop[0].score > before else idle + 1
    best = max(pop, key=lambda p: p.score)
    out = [0] * len(size)
    for b, x in enumerate(best.bins):
        for it in x:
            out[it] = b
    return out


def _epoch(capacity: int, epoch: int):
    """Rows sorted by (block, island), then uid: one epoch of an island."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block, island), (uid, length, own, guest) in by_group(batches, 2):
            seeds = [own, guest] if own[0] is not None else []
            bins = evolve(length, capacity, seeds, (block * ISLANDS + island) * EPOCHS + epoch)
            yield pa.RecordBatch.from_arrays([
                pa.array([block] * len(uid), pa.int64()), pa.array([island] * len(uid), pa.int32()), pa.array(uid, pa.int64()),
                pa.array(length, pa.int64()), pa.array(bins, pa.int64())], ["block", "island", "uid", "length", "bin"])
    return run


def pack(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = documents.sparkSession
    parts = n_partitions(spark)
    text = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    pieces = text.mapInArrow(tidy(_pieces(vocabulary or default_vocabulary(), capacity)),
                             "doc_id long, piece int, start long, length long, ids_crc32 long")
    pieces = written(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    short = pieces.filter(F.col("length") < capacity).select("uid", "length")
    blocks = max(1, -(-short.count() // BLOCK))
    state = short.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks))).withColumn(
        "island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    state = state.select("block", "island", "uid", "length", F.lit(None).cast("long").alias("own"), F.lit(None).cast("long").alias("guest"))
    for epoch in range(EPOCHS):
        run = (state.repartition(parts, "block", "island").sortWithinPartitions("block", "island", "uid")
               .mapInArrow(tidy(_epoch(capacity, epoch)), "block long, island int, uid long, length long, bin long"))
        run = written(run, "islands")
        # elites migrate: every island's solution is a guest on the next one
        guest = run.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), "uid", F.col("bin").alias("guest"))
        state = run.withColumnRenamed("bin", "own").join(guest, ["block", "island", "uid"]).select(
            "block", "island", "uid", "length", "own", "guest")
    score = run.groupBy("block", "island").agg(F.max("bin").alias("bins")).groupBy("block").agg(
        F.min(F.struct("bins", "island")).alias("best")).select("block", F.col("best.island").alias("island"))
    placed = run.join(score, ["block", "island"]).select(
        "uid", (F.col("block") * F.lit(1 << 24) + F.col("bin")).alias("sequence_id"))
    out = pieces.join(placed, "uid", "left").withColumn(
        "sequence_id", F.coalesce("sequence_id", -1 - F.col("uid")))  # full pieces
    w = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                      F.coalesce(F.sum("length").over(w), F.lit(0)).cast("long").alias("offset"))
