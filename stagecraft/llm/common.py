"""Shared helpers: the cluster's shared folder, training splits, word and shingle hashes."""

from __future__ import annotations

import contextlib
import ctypes
import itertools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The bytes that separate words (space, and tab to carriage return).
SEPARATOR_BYTES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
# The same words as a Java/Spark regular expression.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Bytes of text that one numpy pass handles at once; a single longer text is its own pass.
CHUNK_BYTES = 1 << 20

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SHINGLE_BASE = 0xD6E8FEB86659FD93
_SHORT_TAG = 0xA5A5A5A55A5A5A5A


# -- folders and splits ------------------------------------------------------
def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    It is set to a temporary folder only where it is unset and the master is a single
    machine (tests); on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark reads it by: without one it is a path of the cluster's
    default file system, which Python code in a task can't know."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it back
    (columns stay prunable; a lost executor costs no recomputation)."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Shared:
    """A broadcast object of one of this package's classes. It is pickled with its class, as
    plain broadcasts aren't; a worker unpickles it once and keeps it for later tasks."""

    def __init__(self, spark: SparkSession, value) -> None:
        self._sent = spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(value)})

    @property
    def value(self):
        held = self._sent.value
        if "value" not in held:
            held["value"] = cloudpickle.loads(held["pickled"])
        return held["value"]


class Scratch:
    """Tables that an operator writes on its way, and drops once nothing reads them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._paths = spark, {}

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read back, as :func:`written`; an older table of that name is
        dropped, so nothing but the new one may have been made of it."""
        path = new_folder(self._spark, name)
        df.write.parquet(path)
        self.drop(name)
        self._paths[name] = path
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete the tables of these names."""
        for name in names:
            if path := self._paths.pop(name, None):
                at = self._spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(at, True)

    def drop_all(self, *but: str) -> None:
        self.drop(*[name for name in self._paths if name not in but])


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries made in here delete their shuffle files when they end."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for the documents a model must not learn from; a null id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(True))


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def release() -> None:
    """Give memory that a task has freed back to the system. Python workers live on from stage to
    stage, and what Arrow and the allocator keep for later counts against the next one's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


# -- Arrow batches -----------------------------------------------------------
def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.null_count == 0 else column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def pieces(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (or one longer row) that cover a batch."""
    n, start = len(offsets) - 1, 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


def texts_of(column: pa.Array) -> Iterator[memoryview]:
    """The UTF-8 bytes of each row, without a copy; a null text counts as empty."""
    data, offsets = utf8_buffers(column)
    view = memoryview(data)
    for i in range(len(offsets) - 1):
        yield view[offsets[i] : offsets[i + 1]]


# -- hashes ------------------------------------------------------------------
def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    separator = np.zeros(256, dtype=bool)
    separator[SEPARATOR_BYTES] = True
    return lower, separator


_LOWER_TABLE, _SEPARATOR_TABLE = _byte_tables()
_powers_of: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for the next batch."""
    if len(_powers_of.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 65536)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers_of[name] = np.multiply.accumulate(steps)
    return _powers_of["up"][:n], _powers_of["down"][:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (A-Z lowered) of each text: (hash, text's word offsets, start byte, end byte).

    ``data[offsets[i]:offsets[i + 1]]`` is text i. A word's hash is a polynomial of its
    bytes modulo 2**64, taken as a difference of running sums, then mixed.
    """
    base = int(offsets[0])
    text = _LOWER_TABLE[data[base : int(offsets[-1])]]
    at = offsets - base
    n = len(text)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), empty, empty
    inside = ~_SEPARATOR_TABLE[text]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = at[(at > 0) & (at < n)]
    first[bounds] = inside[bounds]  # a word never runs from one text into the next
    starts = np.flatnonzero(first)
    last = np.empty(n, dtype=bool)
    last[:-1] = inside[:-1] & (~inside[1:] | first[1:])
    last[-1] = inside[-1]
    ends = np.flatnonzero(last) + 1
    up, down = _powers(n + 1)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return hashes, np.searchsorted(starts, at), starts + base, ends + base


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text, in order: (hash, text's offsets).

    A text of fewer than k words (at least one) has its whole sequence as its one shingle.
    """
    counts = np.diff(offsets)
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(int(out_offsets[-1]), dtype=np.uint64)
    if not len(out):
        return out, out_offsets
    factors = np.array([pow(_SHINGLE_BASE, j, 1 << 64) for j in range(k)], dtype=np.uint64)
    long = counts >= k
    if len(words) >= k and long.any():
        n = len(words) - k + 1
        rolled = words[:n].copy()
        for j in range(1, k):
            rolled += words[j : j + n] * factors[j]
        rolled = mix(rolled)
        keep = np.zeros(len(words) + 1, dtype=np.int32)
        np.add.at(keep, offsets[:-1][long], 1)
        np.add.at(keep, offsets[1:][long] - k + 1, -1)
        taken = rolled[np.cumsum(keep)[:n] > 0]
        put = np.repeat(long, sizes)
        out[put] = taken
    for size in range(1, k):
        rows = np.flatnonzero(counts == size)
        if len(rows):
            total = np.full(len(rows), _SHORT_TAG * size % (1 << 64), dtype=np.uint64)
            for j in range(size):
                total += words[offsets[rows] + j] * factors[j]
            out[out_offsets[rows]] = mix(total)
    return out, out_offsets


def distinct_sorted(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order: (values, text's offsets)."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(offsets) - 1))]).astype(np.int64)


def universal_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(factors, terms) of n universal hashes x -> factor * x + term modulo 2**64."""
    drawn = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * _BASE)
    return drawn[:n] | np.uint64(1), drawn[n:]


def minima(values: np.ndarray, starts: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """For each universal hash (rows), its minimum over each run of ``values`` that begins at ``starts``."""
    out = np.empty((len(factors), len(starts)), dtype=np.uint64)
    buffer = np.empty_like(values)
    for m in range(len(factors)):
        np.multiply(values, factors[m], out=buffer)
        buffer += terms[m]
        np.minimum.reduceat(buffer, starts, out=out[m])
    return out


# -- encoding by parts -------------------------------------------------------
class PartEncoder:
    """Ids of texts that are encoded part by part: each distinct part is encoded once and
    remembered; a text's ids are gathered from those of its parts.

    ``encode`` deals a list of parts out into groups: it yields (parts, all their ids, number of
    ids of each part). The first ``limit`` parts are remembered, which holds all frequent ones;
    later ones are encoded again in every call that meets them.
    """

    def __init__(self, encode, limit: int = 600_000) -> None:
        self._encode, self._limit = encode, limit
        self._number: dict[str, int] = {}
        self._ids = np.zeros(0, np.uint32)
        self._sizes = np.zeros(0, np.int64)

    def __call__(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text) of texts given as their parts."""
        parts = list(itertools.chain.from_iterable(texts))
        ends = np.cumsum([len(text) for text in texts], dtype=np.int64)
        at = np.fromiter(map(self._number.get, parts, itertools.repeat(-1)), dtype=np.int64, count=len(parts))
        missing = np.flatnonzero(at < 0).tolist()
        known_ids, known_sizes = self._ids, self._sizes
        if missing:
            absent = [parts[i] for i in missing]
            groups = list(self._encode(list(set(absent))))
            new: dict[str, int] = {}
            for of, _, _ in groups:
                new.update(zip(of, itertools.count(len(known_sizes) + len(new))))
            at[missing] = np.fromiter(map(new.__getitem__, absent), dtype=np.int64, count=len(absent))
            known_ids = np.concatenate([known_ids, *[ids.astype(np.uint32) for _, ids, _ in groups]])
            known_sizes = np.concatenate([known_sizes, *[sizes for _, _, sizes in groups]])
            if len(self._number) < self._limit:
                self._number.update(new)
                self._ids, self._sizes = known_ids, known_sizes
        starts = np.cumsum(known_sizes) - known_sizes
        sizes = known_sizes[at]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = known_ids[np.repeat(starts[at] - total[:-1], sizes) + np.arange(total[-1])]
        return ids, np.diff(np.concatenate([[0], total[ends]])).astype(np.int64)


def text_slices(column: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of parts of a string column of about ``limit`` bytes; null counts as empty."""
    _, offsets = utf8_buffers(column)
    for start, stop in pieces(offsets, limit):
        yield start, [t or "" for t in column.slice(start, stop - start).to_pylist()]
