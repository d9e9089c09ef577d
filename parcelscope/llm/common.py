"""Shared pieces: table access, written intermediates, and vectorised word hashing.

Intermediates are written as Parquet below ``spark.checkpoint.dir`` (shared by
all executors), so a lost executor costs a re-read and never a recomputation of
the lineage before them.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BROADCAST_IDS = 1_000_000  # ids (about 24 bytes each) that a broadcast may hold
CHUNK_BYTES, CHUNK_ROWS = 2 << 20, 50_000  # text bytes and texts that one vectorised step handles


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a private one only for a local master."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file://" + tempfile.mkdtemp(prefix="llm-work-")


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here."""
    path = f"{shared_dir(df.sparkSession)}/llm/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``documents`` whose doc_id is not in ``ids`` (distinct, one column doc_id); null doc_ids stay.

    The ids are written and counted first: up to ``BROADCAST_IDS`` they are broadcast and no text is shuffled.
    """
    gone = written(ids, "gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return documents.join(gone, "doc_id", "left_anti").select(*documents.columns)


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; ``translate`` runs just where there is a capital."""
    return F.when(c.rlike("[A-Z]"), F.translate(c, UPPER, LOWER)).otherwise(c)


# --- vectorised word hashing (used inside tasks) -------------------------------------------

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_D = np.uint64(0xD6E8FEB86659FD93)
_BI = np.uint64(pow(int(_B), -1, 1 << 64))
_DI = np.uint64(pow(int(_D), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _POWERS[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of every text, and the number of words of each text.

    Words are runs of bytes other than space and U+0009..U+000D.
    """
    buf = b" ".join(texts) + b" "
    if lower:
        buf = buf.translate(_LOWER)
    a = np.frombuffer(buf, np.uint8)
    sp = _SPACE[a]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], sp)).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    n = len(a)
    s = np.concatenate((np.zeros(1, np.uint64), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * _powers(_B, n), dtype=np.uint64)))
    h = mix((s[ends] - s[starts]) * _powers(_BI, n)[starts] + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    upto = np.searchsorted(starts, bounds)
    return h, np.diff(np.concatenate(([0], upto)))


def window_hashes(h: np.ndarray, w: int) -> np.ndarray:
    """Hash of each run of ``w`` consecutive word hashes (runs may cross texts; mask them)."""
    if len(h) < w:
        return np.zeros(0, np.uint64)
    n = len(h)
    s = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * _powers(_D, n), dtype=np.uint64)))
    return mix((s[w:] - s[:-w]) * _powers(_DI, n)[: n - w + 1] + np.uint64(w))


def tidy(run):
    """A mapInArrow function that leaves the reused Python worker as small as it was: what its task held is
    freed, and the allocators give the free pages back, so that workers do not add up from stage to stage."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _POWERS.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; elsewhere the allocator decides
            if trim:
                trim(0)
    return task


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches cut (without copying) to ``rows`` rows, so that what is made of one in Python stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def chunks(*columns: list, size=lambda row: len(row[-1]), limit: int = CHUNK_BYTES):
    """Rows of parallel columns in runs of about ``limit`` bytes, CHUNK_ROWS at most (the last column holds bytes)."""
    part, held = [], 0
    for row in zip(*columns):
        part.append(row)
        held += size(row)
        if held >= limit or len(part) >= CHUNK_ROWS:
            yield [list(c) for c in zip(*part)]
            part, held = [], 0
    if part:
        yield [list(c) for c in zip(*part)]
