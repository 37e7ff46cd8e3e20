"""Operator 10: benchmark decontamination.

A size-partitioned MinHash containment search finds short test items inside long documents. A
hit needs a share ``threshold`` of an item's distinct k-word shingles in the document.

* Items are partitioned by their number of distinct shingles, into classes that double in size.
  A MinHash over a whole long document says nothing about a short item, so for each class the
  documents are searched in windows of matching length: two adjacent blocks of the class's upper
  size. An item that lies in a document then makes up a good part of some window.
* A window's signature is the minimum of ``MINIMA`` universal hashes over its shingles. Each
  minimum is a band of its own (one equal minimum makes a candidate), which with 64 minima finds
  a pair of Jaccard similarity 0.19 - the lowest that a contiguous hit at 0.8 can have, where
  the item is just over the lower bound of its class - but for 1 in 10**6.
* Items under ``SMALL_ITEM`` shingles are found by each of their shingles, which is exact.
* Every candidate is verified by exact containment of the shingles' words in the whole document.

The benchmark is the stated query set and meets all documents in blocks of at most ``BLOCK_ITEMS``
items and ``BLOCK_BYTES`` of their texts (or one longer item); a block is a bounded broadcast.
Documents are neither shuffled nor sorted.

Defined results: a null or empty text, of a document or an item, holds nothing and is found
nowhere. A text of fewer than k words has its whole word sequence as its one shingle, so such an
item is only found in a document of just these words. Items that hold the same words are each reported.
Repeated rows are judged alike. An empty benchmark or document table gives an empty result.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import dataclasses
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagecraft.llm.common import (
    WORD_PATTERN,
    Shared,
    distinct_sorted,
    minima,
    pieces,
    release,
    shingle_hashes,
    universal_family,
    utf8_buffers,
    word_hashes,
    written,
)

SHINGLE_WORDS = 5
THRESHOLD = 0.8
MINIMA = 64
SMALL_ITEM = 8
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20
# Parts of a block that its items are dealt into first, so that blocks can be filled evenly.
SLOTS = 16
FACTORS, TERMS = universal_family(MINIMA)


@dataclasses.dataclass(frozen=True)
class ItemClass:
    """Items of one size class: at most ``upper`` distinct shingles each. ``keys[m]`` are the
    sorted m-th minima, ``items[m]`` the items they belong to (for small items one pair: their
    shingles)."""

    upper: int
    keys: list[np.ndarray]
    items: list[np.ndarray]


@dataclasses.dataclass(frozen=True)
class Items:
    ids: list[int]
    shingles: list[np.ndarray]
    words: list[list[bytes]]
    classes: list[ItemClass]


def words_of(text: bytes) -> list[bytes]:
    """The words of a text, A-Z lowered."""
    return re.findall(WORD_PATTERN.encode(), text.lower())


def shingle_set(words: list[bytes], k: int) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))}


def compile_items(rows: list[tuple[int, bytes]], k: int) -> Items:
    """Signatures of the items (id, text) by size class."""
    rows = sorted(r for r in rows if words_of(r[1]))
    data = np.frombuffer(b"".join(t for _, t in rows), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for _, t in rows])]).astype(np.int64)
    hashes, word_at, _, _ = word_hashes(data, offsets)
    values, at = distinct_sorted(*shingle_hashes(hashes, word_at, k))
    sets = [values[at[i] : at[i + 1]] for i in range(len(rows))]
    groups: dict[int, list[int]] = {}
    for i, s in enumerate(sets):
        groups.setdefault(0 if len(s) < SMALL_ITEM else len(s).bit_length(), []).append(i)
    classes = []
    for level, members in sorted(groups.items()):
        joined = np.concatenate([sets[i] for i in members])
        sizes = np.array([len(sets[i]) for i in members])
        if level == 0:
            keys, items = [joined], [np.repeat(members, sizes)]
        else:
            keys = list(minima(joined, np.cumsum(sizes) - sizes, FACTORS, TERMS))
            items = [np.array(members)] * MINIMA
        order = [np.argsort(x, kind="stable") for x in keys]
        classes.append(
            ItemClass(1 << level if level else 1, [x[o] for x, o in zip(keys, order)], [y[o] for y, o in zip(items, order)])
        )
    return Items([i for i, _ in rows], sets, [words_of(t) for _, t in rows], classes)


def matches(found: np.ndarray, keys: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``found`` whose value is a key, with the key's items (all of a repeated key)."""
    left = np.searchsorted(keys, found, side="left")
    hit = np.flatnonzero(keys[np.minimum(left, len(keys) - 1)] == found)
    left = left[hit]
    n = np.searchsorted(keys, found[hit], side="right") - left
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(hit, n), items[np.repeat(left, n) + offset]


def joined_blocks(low: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima of blocks of twice the length: the 1st and 2nd of each row, the 3rd and 4th, ..."""
    first_of = np.searchsorted(owner, owner)
    first = np.flatnonzero((np.arange(len(owner)) - first_of) % 2 == 0)
    second = np.minimum(first + 1, len(owner) - 1)
    second = np.where(owner[second] == owner[first], second, first)
    return np.minimum(low[:, first], low[:, second]), owner[first]


def candidates(items: Items, values: np.ndarray, at: np.ndarray) -> set[tuple[int, int]]:
    """(row, item) that share a minimum; ``values[at[i]:at[i + 1]]`` are row i's shingles in order."""
    found: set[tuple[int, int]] = set()
    if not len(values):
        return found
    low = owner = None
    for group in items.classes:
        if group.upper == 1:
            where, item = matches(values, group.keys[0], group.items[0])
            row = np.searchsorted(at, where, side="right") - 1
            found.update(zip(row.tolist(), item.tolist()))
            continue
        if low is None:
            blocks = -(-np.diff(at) // group.upper)
            owner = np.repeat(np.arange(len(blocks)), blocks)
            nth = np.arange(len(owner)) - (np.cumsum(blocks) - blocks)[owner]
            low = minima(values, at[owner] + nth * group.upper, FACTORS, TERMS)
            upper = group.upper
        while upper < group.upper:  # two blocks make one of the next class
            low, owner = joined_blocks(low, owner)
            upper *= 2
        window = low.copy()  # a row's last block is a window of its own
        pair = np.flatnonzero(owner[1:] == owner[:-1])
        window[:, pair] = np.minimum(low[:, pair], low[:, pair + 1])
        for m in range(MINIMA):
            where, item = matches(window[m], group.keys[m], group.items[m])
            found.update(zip(owner[where].tolist(), item.tolist()))
    return found


def contained(items: Items, item: int, held: set[tuple[bytes, ...]], k: int) -> tuple[int, int]:
    """(distinct shingles of the item that are in ``held``, distinct shingles of the item), exact."""
    wanted = shingle_set(items.words[item], k)
    return len(wanted & held), len(wanted)


def item_blocks(wanted: DataFrame, block_items: int, block_bytes: int) -> list[DataFrame]:
    """``wanted`` (item_id, text) in parts of at most so many items and bytes of text, or of one item.

    Items are dealt into slots by a hash, more slots until none is over a bound; adjacent slots
    then make up a block. Only the slots' sizes come to the driver."""
    size = (F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"))
    whole = wanted.agg(*size).first()
    if whole.n <= block_items and whole.bytes <= block_bytes:
        return [wanted] if whole.n else []
    slots = SLOTS * max(-(-whole.n // block_items), -(-whole.bytes // block_bytes))
    while True:
        slot = F.pmod(F.xxhash64("item_id", "text"), F.lit(slots))
        sizes = sorted(wanted.groupBy(slot.alias("slot")).agg(*size).collect())
        if all(x.n == 1 or (x.n <= block_items and x.bytes <= block_bytes) for x in sizes):
            break
        slots *= 2
    blocks, n, held = [], 0, 0
    for x in sizes:
        if not blocks or n + x.n > block_items or held + x.bytes > block_bytes:
            blocks.append([x.slot, x.slot])
            n = held = 0
        blocks[-1][1] = x.slot
        n, held = n + x.n, held + x.bytes
    return [wanted.where(slot.between(first, last)) for first, last in blocks]


def find_items(documents: DataFrame, benchmark: DataFrame, k: int = SHINGLE_WORDS, threshold: float = THRESHOLD,
               block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_found and n_shingles (of the item) of every hit.

    ``documents`` has doc_id and text, ``benchmark`` item_id and text. The benchmark comes to the
    driver block by block (:func:`item_blocks`); the documents are read once a block.
    """
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text")
    wanted = benchmark.select("item_id", "text").where("text IS NOT NULL AND item_id IS NOT NULL").distinct()
    schema = "doc_id bigint, item_id bigint, n_found bigint, n_shingles bigint"
    found = []
    for block in item_blocks(wanted, block_items, block_bytes):
        items = compile_items([(r[0], r[1].encode()) for r in block.collect()], k)
        if items.ids:
            found.append(docs.mapInArrow(_search(Shared(spark, items), k, threshold), schema))
    return functools.reduce(DataFrame.union, found) if found else spark.createDataFrame([], schema)


def _search(sent, k: int, threshold: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = utf8_buffers(batch.column(1))
            out = []
            for start, stop in pieces(offsets):
                here = offsets[start : stop + 1]
                hashes, word_at, _, _ = word_hashes(data, here)
                values, at = shingle_hashes(hashes, word_at, k)
                split, held = -1, set()
                for row, item in sorted(candidates(items, values, at)):
                    # Few of a row's shingles settle most chance candidates, without its words.
                    mine = items.shingles[item]
                    if np.isin(mine, values[at[row] : at[row + 1]]).sum() < threshold * len(mine):
                        continue
                    if row != split:  # a row's own shingles, once for all its candidates
                        split, held = row, shingle_set(words_of(data[here[row] : here[row + 1]].tobytes()), k)
                    n, of = contained(items, item, held, k)
                    if n >= threshold * of:
                        out.append((ids[start + row], items.ids[item], n, of))
            columns = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "n_found", "n_shingles"]
            )
        release()

    return search


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without those that hold a benchmark item (all columns; null ids stay)."""
    hits = written(find_items(documents, benchmark, **options).select("doc_id").distinct(), "hits")
    return documents.join(hits, "doc_id", "left_anti")


def decontamination_query(spark, sf_dir: str) -> DataFrame:
    """Op 10: every (document, item) hit of the whole benchmark in all documents."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_items(documents, benchmark)


DECONTAMINATION_SQL = r"""
WITH words AS (
    SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    UNION ALL
    SELECT 'i', item_id, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark
), places AS (
    SELECT kind, id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS pos FROM words WHERE len(w) > 0
), shingles AS (
    SELECT DISTINCT kind, id, array_to_string(w[pos : pos + 4], ' ') AS s FROM places
), sizes AS (
    SELECT id, count(*) AS n FROM shingles WHERE kind = 'i' GROUP BY id
)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_found, any_value(z.n) AS n_shingles
FROM shingles i JOIN shingles d ON d.kind = 'd' AND d.s = i.s JOIN sizes z ON z.id = i.id
WHERE i.kind = 'i'
GROUP BY d.id, i.id
HAVING count(*) >= 0.8 * any_value(z.n)
"""
