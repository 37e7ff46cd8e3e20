"""Operator 6: language-model scores by a weighted backoff automaton.

Training counts words (A-Z lowered, and one end per text) and all n-grams of up to ``ORDER`` of
them over the texts that are learned from. Every n-gram that occurs is in the model, whatever the
size of the corpus; none is pruned and no table of them is collected or broadcast.

Smoothing: p(w | h) = (c(hw) + STRENGTH * p(w | h')) / (c(h) + STRENGTH), h' being h without its
first word; p(w) = (c(w) + 1) / (N + V + 1). The shares of a context add up to one.

States of the automaton are the empty one and the n-grams of fewer than ORDER words. It reads a
text word by word and carries its state, the longest known n-gram that ends here. If the state has
an arc for the next word, that arc's log probability is added; else the failure arc to the state
without its first word adds the log of STRENGTH / (c(h) + STRENGTH), down to the empty state, where
the unigram is added. Segments of texts are read side by side, so the number of numpy steps
doesn't grow with the longest text.

The automaton is distributed with the texts:

1. ``blocks``: texts are cut into blocks of about ``BLOCK_TOKENS`` tokens (or one longer text),
   written as word numbers with the block's distinct words.
2. ``asked``: each block sends the hashes of its distinct n-grams with their counts in its training
   texts, to the bucket of the hash. A frequent n-gram is one entry a block, so none is hot; buckets
   grow with the corpus, to about ``BUCKET_TOKENS`` entries each.
3. ``answers``: a bucket adds the counts up and sends each block the sums, in the block's order.
4. A block compiles the states and arcs that its texts can reach and reads them. An n-gram's
   context and suffix occur where it does, so the block knows their counts as well.

Words are known by a 64-bit hash. Defined results: a null or empty text is its end alone. A null
id is not learned from by the query. Without training documents N = V = 0 and every token is
unknown, with a score of 0. Repeated rows count and are scored each; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagecraft.llm.common import (
    CHUNK_BYTES,
    Scratch,
    held_out,
    mix,
    pieces,
    release,
    shuffles_dropped,
    utf8_buffers,
    word_hashes,
    written,
)

ORDER = 3
# Chosen on the held-out texts of check_s: 50 gives the best mean log10 probability of 1, 4, 16 and 50 (-4.23, -3.96, -3.76, -3.66 a token).
STRENGTH = 50.0
BLOCK_TOKENS = 2_000_000
BUCKET_TOKENS = 1_000_000
# Words of a text that are read one after another; its segments are read side by side.
SEGMENT = 48
# The hash that stands for the end of a text.
END = np.uint64(0xE0D0E0D0E0D0E0D1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


# -- n-grams -----------------------------------------------------------------
def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each text with its end: (hashes, offsets)."""
    words, at, _, _ = word_hashes(data, offsets)
    return np.insert(words, at[1:], END), at + np.arange(len(at))


def joined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from the hashes of its first n - 1 words and of its last word."""
    return mix(context * _STEP + word)


def grams(words: np.ndarray, at: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position of the first word, hash) of the n-grams of each length up to ``order``."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    gram = words
    for n in range(order):
        if n:
            # gram[i] is the n-gram that begins at i; make those of n + 1 words.
            gram = joined(gram[:-1], words[n:])
        inside = np.flatnonzero(owner[: len(gram)] == owner[n:])
        yield inside, gram[inside]


# -- the automaton -----------------------------------------------------------
@dataclasses.dataclass(frozen=True)
class Level:
    """The known n-grams of one length that occur in some texts: their counts in all training
    texts, and the numbers, one level below, of their first n - 1 words (context) and their last
    n - 1 words (suffix)."""

    n: np.ndarray
    context: np.ndarray
    suffix: np.ndarray


@dataclasses.dataclass(frozen=True)
class Automaton:
    """State 0 is the empty one; 1, 2, ... are the known n-grams of fewer than ORDER words, by
    length, with their ``length``, ``fail`` (the state without the first word) and ``backoff`` (its
    log10 weight). Every known n-gram of two words or more is an arc from its context, numbered by
    length: its log10 ``weight`` and the state it leads ``to``."""

    order: int
    length: np.ndarray
    fail: np.ndarray
    backoff: np.ndarray
    weight: np.ndarray
    to: np.ndarray


def compile_automaton(levels: list[Level], total: int, distinct: int, strength: float) -> Automaton:
    """States and arcs of the n-grams in ``levels``, by length; ``total`` and ``distinct`` are N and V."""
    inner = [len(x.n) for x in levels[:-1]]
    first = np.cumsum([1, *inner])  # number of each length's first state
    length = np.repeat(np.arange(len(levels)), [1, *inner])
    fail, backoff = np.zeros(len(length), dtype=np.int64), np.zeros(len(length))
    p = (levels[0].n + 1.0) / (total + distinct + 1.0)
    weight, to = [np.zeros(0)], [np.zeros(0, np.int64)]
    for n in range(1, len(levels)):
        here, below = levels[n], levels[n - 1]
        # A context never ends in a text's end, so its count is that of all its continuations.
        p = (here.n + strength * p[here.suffix]) / (below.n[here.context] + strength)
        backoff[first[n - 1] : first[n]] = np.log10(strength / (below.n + strength))
        weight.append(np.log10(p))
        if n < len(inner):
            to.append(first[n] + np.arange(len(here.n)))
            fail[to[-1]] = first[n - 1] + here.suffix
        else:  # as long as they get: on to the state that they end with
            to.append(first[n - 1] + here.suffix)
    return Automaton(len(levels), length, fail, backoff, np.concatenate(weight), np.concatenate(to))


def compose(words: np.ndarray, at: np.ndarray, order: int, counts) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """(levels, arcs, count of each word) of some texts; ``counts(n, hashes)`` gives the counts in
    training texts of their distinct n-grams of n + 1 words, sorted by hash.

    ``arcs[n]`` has for each word the arc of the n + 1 words that end with it, or -1; ``arcs[0]``
    the state that the empty one goes to with it."""
    arcs = np.full((order, len(words)), -1, dtype=np.int64)
    levels, begins, known, count = [], np.zeros(0, np.int64), 0, np.zeros(len(words), np.int64)
    for n, (position, gram) in enumerate(grams(words, at, order)):
        found, which = np.unique(gram, return_inverse=True)
        of = counts(n, found)
        seen = of > 0
        number = np.where(seen, np.cumsum(seen) - 1, -1)
        place = np.empty(len(found), dtype=np.int64)
        place[which] = position  # where one of its occurrences begins
        place = place[seen]
        if n:
            levels.append(Level(of[seen], begins[place], begins[place + 1]))
            arcs[n, position + n] = np.where(seen, number + known, -1)[which]
            known += len(place)
        else:
            levels.append(Level(of[seen], place, place))  # both are the empty state
            arcs[0] = (number + 1)[which] if order > 1 else 0
            count = of[which]
        begins = np.full(len(words), -1, dtype=np.int64)
        begins[position] = number[which]
    return levels, arcs, count


def traverse(model: Automaton, arcs: np.ndarray, unigram: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log10 probability of each text: its words are read left to right, with a carried state.
    ``unigram`` is each word's log10 unigram probability, ``arcs`` as :func:`compose` gives them
    (a state of n words is the last n words, so its arc is that of the n + 1 words that end here). A
    long text is read in segments side by side, so the number of numpy steps doesn't grow with it."""
    texts = np.repeat(np.arange(len(at) - 1), -(-np.diff(at) // SEGMENT))
    nth = np.arange(len(texts)) - np.searchsorted(texts, texts)
    begin = at[texts] + nth * SEGMENT
    # The last order - 1 words make a state, so a segment reads those before it first.
    before = np.minimum(nth * SEGMENT, model.order - 1)
    sizes = np.minimum(at[texts + 1] - begin, SEGMENT) + before
    order = np.argsort(-sizes, kind="stable")
    starts, before = (begin - before)[order], before[order]
    state = np.zeros(len(order), dtype=np.int64)
    total = np.zeros(len(order))
    # Segments that still have a word, longest first, so that they stay the first ones.
    left = np.searchsorted(-sizes[order], -np.arange(sizes.max() if len(sizes) else 0), side="left")
    for step, n in enumerate(left.tolist()):
        here, s = starts[:n] + step, state[:n]
        gained = np.zeros(n)
        open_ = np.flatnonzero(s > 0)
        landed = np.zeros(n, dtype=bool)
        while len(open_):
            arc = arcs[model.length[s[open_]], here[open_]]
            hit = arc >= 0
            on = open_[hit]
            gained[on] += model.weight[arc[hit]]
            s[on] = model.to[arc[hit]]
            landed[on] = True
            off = open_[~hit]
            gained[off] += model.backoff[s[off]]
            s[off] = model.fail[s[off]]
            open_ = off[s[off] > 0]
        rest = np.flatnonzero(~landed)
        gained[rest] += unigram[here[rest]]
        s[rest] = arcs[0, here[rest]]
        total[:n] += np.where(step >= before[:n], gained, 0.0)
    return np.bincount(texts[order], weights=total, minlength=len(at) - 1)


# -- blocks of texts ---------------------------------------------------------
def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, all first bytes before all second ones and so on."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T), 1)


def unpacked(data, dtype) -> np.ndarray:
    """The numbers of :func:`packed`."""
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


BLOCK = (
    "block bigint, n_tokens bigint, n_taught bigint, doc_ids array<bigint>, taught array<boolean>, "
    "sizes array<bigint>, words binary, numbers binary"
)


def _row(names: list[str], columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=names)


def _block(block: int, parts: list) -> pa.RecordBatch:
    words, sizes, ids, taught = (list(x) for x in zip(*parts))
    words, sizes = np.concatenate(words), np.concatenate(sizes)
    ids, taught = pa.concat_arrays(ids), np.concatenate(taught)
    distinct, numbers, n = np.unique(words, return_inverse=True, return_counts=True)
    by_count = np.argsort(-n, kind="stable")  # frequent words get small numbers
    rank = np.empty(len(distinct), dtype=np.uint32)
    rank[by_count] = np.arange(len(distinct), dtype=np.uint32)
    one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t))
    return _row(
        ["block", "n_tokens", "n_taught", "doc_ids", "taught", "sizes", "words", "numbers"],
        [
            pa.array([block], pa.int64()),
            pa.array([len(words)], pa.int64()),
            pa.array([int(sizes[taught].sum())], pa.int64()),
            one(ids, pa.int64()),
            one(taught, pa.bool_()),
            one(sizes, pa.int64()),
            pa.array([distinct[by_count].tobytes()], pa.binary()),
            pa.array([packed(rank[numbers])], pa.binary()),
        ],
    )


def _cutter(limit: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, size = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(1))
            for start, stop in pieces(offsets, min(CHUNK_BYTES, 8 * limit)):
                words, at = tokens(data, offsets[start : stop + 1])
                if parts and size + len(words) > limit:
                    yield _block(block, parts)
                    block, parts, size = block + 1, [], 0
                taught = batch.column(2).slice(start, stop - start).to_numpy(zero_copy_only=False).astype(bool)
                parts.append((words, np.diff(at), batch.column(0).slice(start, stop - start), taught))
                size += len(words)
        if parts:
            yield _block(block, parts)
        release()

    return cut


def _texts_of_block(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, text's offsets, whether each word is learned from) of a block."""
    words = np.frombuffer(row["words"], dtype=np.uint64)[unpacked(row["numbers"], np.uint32)]
    sizes = np.array(row["sizes"], dtype=np.int64)
    return words, np.concatenate([[0], np.cumsum(sizes)]), np.repeat(np.array(row["taught"], dtype=bool), sizes)


def _buckets(distinct: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` buckets begins in sorted hashes: buckets are ranges of hashes."""
    starts = [np.uint64(-(-(i << 64) // n)) for i in range(n)]
    return np.concatenate([np.searchsorted(distinct, np.array(starts, dtype=np.uint64)), [len(distinct)]])


def _asker(order: int, buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, at, taught = _texts_of_block(row)
                for length, (position, gram) in enumerate(grams(words, at, order)):
                    distinct, which = np.unique(gram, return_inverse=True)
                    n = np.bincount(which, weights=taught[position], minlength=len(distinct)).astype(np.uint32)
                    starts = _buckets(distinct, buckets)
                    used = np.flatnonzero(np.diff(starts))
                    parts = [slice(a, b) for a, b in zip(starts[used], starts[used + 1])]
                    yield _row(
                        ["bucket", "block", "grams", "n"],
                        [
                            pa.array(length * buckets + used, pa.int64()),
                            pa.array(np.full(len(used), row["block"]), pa.int64()),
                            # Differences of sorted hashes take fewer bytes.
                            pa.array([packed(np.diff(distinct[x], prepend=np.uint64(0))) for x in parts], pa.binary()),
                            pa.array([packed(n[x]) for x in parts], pa.binary()),
                        ],
                    )
        release()

    return ask


def _answer(asked: pa.Table) -> pa.Table:
    """The sums of a bucket: what each block asked for, in its order; ``known`` (on one row) is the
    number of distinct n-grams that occur in training texts."""
    grams_ = [np.cumsum(unpacked(x, np.uint64), dtype=np.uint64) for x in asked.column("grams").to_pylist()]
    distinct, which = np.unique(np.concatenate(grams_), return_inverse=True)
    n = np.concatenate([unpacked(x, np.uint32) for x in asked.column("n").to_pylist()])
    sums = np.bincount(which, weights=n, minlength=len(distinct)).astype(np.int64)
    parts = np.split(sums[which], np.cumsum([len(x) for x in grams_])[:-1])
    known = np.zeros(len(parts), dtype=np.int64)
    known[0] = np.count_nonzero(sums)
    return pa.table(
        {
            "block": asked.column("block"),
            "bucket": asked.column("bucket"),
            "known": pa.array(known),
            "sums": pa.array([packed(x) for x in parts], pa.binary()),
        }
    )


def _reader(order: int, buckets: int, total: int, distinct: int, strength: float):
    def read(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        words, at, _ = _texts_of_block(row)
        answers = answers.sort_by("bucket")
        of = answers.column("bucket").to_numpy() // buckets
        sums = answers.column("sums")

        def counts(n: int, found: np.ndarray) -> np.ndarray:
            mine = [unpacked(sums[i].as_py(), np.int64) for i in np.flatnonzero(of == n)]
            return np.concatenate([np.zeros(0, np.int64), *mine])

        levels, arcs, count = compose(words, at, order, counts)
        model = compile_automaton(levels, total, distinct, strength)
        unigram = np.log10((count + 1.0) / (total + distinct + 1.0))
        text = np.repeat(np.arange(len(at) - 1), np.diff(at))
        over = lambda x: np.bincount(text, weights=x, minlength=len(at) - 1)
        scored = pa.table(
            {
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "n_tokens": pa.array(np.diff(at), pa.int64()),
                "n_known": pa.array(over(count > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(at) - 1, total), pa.int64()),
                "base_score": pa.array(over(unigram)),
                "score": pa.array(traverse(model, arcs, unigram, at)),
            }
        )
        release()
        return scored

    return read


SCORES = "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score_documents(documents: DataFrame, taught: Column, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every whole text, by the
    model of those rows for which ``taught`` is true (null is false)."""
    scratch = Scratch(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(taught, F.lit(False)).alias("taught"))
    blocks = scratch.written(texts.mapInArrow(_cutter(BLOCK_TOKENS), BLOCK), "lm-blocks")
    tokens_, total = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_taught"), F.lit(0))).first()
    buckets = max(1, -(-tokens_ // BUCKET_TOKENS))
    asked = blocks.mapInArrow(_asker(order, buckets), "bucket bigint, block bigint, grams binary, n binary")
    with shuffles_dropped(documents.sparkSession):
        answers = scratch.written(
            asked.groupBy("bucket").applyInArrow(_answer, "block bigint, bucket bigint, known bigint, sums binary"), "lm-answers"
        )
    distinct = answers.where(F.col("bucket") < buckets).agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    read = _reader(order, buckets, total, distinct, strength)
    scored = written(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(read, SCORES), "lm-scores")
    scratch.drop_all()
    return scored


def lm_query(spark, sf_dir: str) -> DataFrame:
    """Op 6 over all documents, learning from ids with crc32(doc_id) mod 7 <> 2."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    apart = held_out(F.col("doc_id"), 7, 2)
    return score_documents(documents, ~apart).select(
        "doc_id", apart.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
