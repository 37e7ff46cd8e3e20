"""Operator 9: SentencePiece encoding and decoding by a weighted finite-state transducer.

The transducer reads the characters of a normalised text and writes pieces. Its states are
pieces: the last one written. An arc reads the characters of the next piece, and its weight
lives in the tropical semiring (minimum, plus).

* Unigram models: an arc weighs minus the piece's score; the lightest path is the encoding.
* BPE models: merging by score is not a sum of piece scores. But a sequence of pieces is the
  result of merging exactly if every two neighbours are the result of merging their joined
  text. So an arc from piece a to piece b weighs 0 if merging leaves (a, b) as they are and
  infinity if not; the one path of finite weight is the encoding, and the shortest path finds
  it. Arcs are weighed when a text first needs them (lazy composition) and kept.

The normaliser is part of the machine: the space symbol, the dummy prefix. Characters without
a piece go to byte pieces (byte fallback) or to the unknown piece. Where no piece holds a space
symbol after another character, a lattice falls apart at the words, so each distinct word is
composed once per task (a bounded memory) and texts are put together from their words.

Decoding is the inverse machine: pieces to their characters, byte pieces to bytes, the space
symbol to a space, without the dummy prefix.

Models whose normaliser has a character map are refused. Defined results: a null or empty text
has no ids and decodes to the empty text; a text that holds the space symbol itself decodes
with a space in its place (``round_trip`` false); repeated rows are each encoded; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagecraft.llm.common import PartEncoder, Shared, release, text_slices

SPACE = "\u2581"
# Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
# What an unknown character costs in a unigram model beyond the worst piece.
UNKNOWN_PENALTY = 10.0
# Arcs and words that a worker remembers (about 100 and 250 bytes each).
ARC_ENTRIES = 400_000
MEMO_PARTS = 120_000
# Bytes of text whose words and ids are Python objects at one time.
SLICE_BYTES = 1 << 19


def _alone(char: str) -> tuple[list, list]:
    """The edges of a character without a piece: nothing ever merges it."""
    return [(char, -math.inf)], [(char, -math.inf)]


class Transducer:
    """A compiled model. Built on the driver from a model file; small (one entry per piece)."""

    def __init__(self, model_file: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that keep every character are supported")
        if model.trainer_spec.model_type not in (UNIGRAM, BPE) or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only unigram and BPE models with the space symbol before words are supported")
        if any(p.type == USER_DEFINED for p in model.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.dummy_prefix = rules.add_dummy_prefix
        self.bpe = model.trainer_spec.model_type == BPE
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.bytes = [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None
        self.by_words = all(SPACE not in p.lstrip(SPACE) for p in self.id)
        self.surface = [self._surface(p) for p in model.pieces]
        if self.bpe:
            self._compile_merges()
        else:
            self.unknown_cost = UNKNOWN_PENALTY - min(self.score.values(), default=0.0)
        # What pieces end with: whether it is itself a piece (the input side of the machine,
        # read backwards from where a piece ends).
        self.suffixes = {p[i:]: False for p in self.id for i in range(len(p))} | dict.fromkeys(self.id, True)

    @staticmethod
    def _surface(piece) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[1:-1], 16)])
        if piece.type == NORMAL:
            return piece.piece.replace(SPACE, " ").encode()
        return " \u2047 ".encode() if piece.type == UNKNOWN else b""

    # -- BPE: which neighbours merging leaves alone
    def merged(self, text: str) -> list[tuple]:
        """Merging a short text: trees (text, left tree, right tree) of its pieces."""
        parts: list[tuple] = [(c, None, None) for c in text]
        while len(parts) > 1:
            best = None
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i][0] + parts[i + 1][0])
                if score is not None and (best is None or score > best[0]):
                    best = (score, i)
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [(parts[i][0] + parts[i + 1][0], parts[i], parts[i + 1])]
        return parts

    def _compile_merges(self) -> None:
        """For each piece, the pieces on its left and right edge while it is being merged, from
        single character to the piece itself, each with the score of the merge that ends it."""
        self.edges: dict[str, tuple[list, list] | None] = {}
        for piece in list(self.id):
            found = self.merged(piece)
            if len(found) > 1:  # merging never gives this piece
                del self.id[piece]
                continue
            sides = []
            for side in (1, 2):
                chain, node = [piece], found[0]
                while node[side]:
                    node = node[side]
                    chain.append(node[0])
                chain.reverse()
                sides.append([(p, self.score[q]) for p, q in zip(chain, chain[1:])] + [(piece, -math.inf)])
            ordered = all(x[1] >= y[1] for s in sides for x, y in zip(s, s[1:]))
            self.edges[piece] = (sides[0], sides[1]) if ordered else None

    def stays(self, a: str, b: str) -> bool:
        """Whether merging ``a + b`` gives just (a, b)."""
        if len(a) > 1 and a not in self.edges or len(b) > 1 and b not in self.edges:
            return False
        left = self.edges[a] if a in self.edges else _alone(a)
        right = self.edges[b] if b in self.edges else _alone(b)
        if left is None or right is None:  # merges out of score order: merge to see
            return [n[0] for n in self.merged(a + b)] == [a, b]
        # The piece at the end of a and the one at the start of b, each with the score of the
        # merge that ends it. Of equal scores the merge on the left comes first.
        rest_a, rest_b = iter(left[1]), iter(right[0])
        (end, next_a), (start, next_b) = next(rest_a), next(rest_b)
        score = self.score
        while True:
            across = score.get(end + start)
            if across is not None and across > next_a and across >= next_b:
                return False
            if next_a >= next_b:
                if next_a == -math.inf:
                    return True
                end, next_a = next(rest_a)
            else:
                start, next_b = next(rest_b)

    # -- composition and shortest path
    def shortest_paths(self, texts: list[str], arcs: dict[str, dict[str, bool]]) -> Iterator[list[str]]:
        """The pieces (or unknown characters) on the lightest path through each text. The path to
        a place depends on what is before it alone, so a text that begins like the one before
        (sort them) goes on where they part."""
        longest = max(map(len, texts), default=0)
        last, back = [""] * (longest + 1), [0] * (longest + 1)
        cost = [0.0] * (longest + 1)
        before = ""
        for text in texts:
            same = 0
            for a, b in zip(before, text):
                if a != b:
                    break
                same += 1
            if self.bpe:
                self._extend_merges(text, same, last, back, arcs)
            else:
                self._extend_scores(text, same, cost, back)
            before = text
            out = []
            n = len(text)
            while n:
                out.append(text[back[n] : n])
                n = back[n]
            out.reverse()
            yield out

    def _extend_merges(self, text: str, same: int, last: list[str], back: list[int], arcs: dict) -> None:
        suffixes = self.suffixes
        for end in range(same + 1, len(text) + 1):
            for start in range(end - 1, -1, -1):
                piece = text[start:end]
                known = suffixes.get(piece)
                if not known and end - start > 1:
                    if known is None:
                        break  # no piece ends like this
                    continue
                if start:
                    before = last[start]
                    after = arcs.get(before)
                    if after is None:
                        after = arcs[before] = {}
                    fine = after.get(piece)
                    if fine is None:
                        fine = after[piece] = self.stays(before, piece)
                    if not fine:
                        continue
                last[end], back[end] = piece, start
                break

    def _extend_scores(self, text: str, same: int, cost: list[float], back: list[int]) -> None:
        for end in range(same + 1, len(text) + 1):
            best = math.inf
            for start in range(end - 1, -1, -1):
                piece = text[start:end]
                if piece in self.id:
                    weight = -self.score[piece]
                elif end - start == 1:
                    weight = self.unknown_cost
                elif piece not in self.suffixes:
                    break
                else:
                    continue
                if cost[start] + weight < best:
                    best = cost[end] = cost[start] + weight
                    back[end] = start

    def ids_of(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for piece in pieces:
            at = self.id.get(piece)
            if at is not None:
                out.append(at)
            elif self.bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            elif not out or out[-1] != self.unknown:  # unknown characters in a row are one piece
                out.append(self.unknown)
        return out

    def parts(self, text: str) -> list[str]:
        """The normalised text in parts that no piece crosses."""
        if not text:
            return []
        text = text.replace(" ", SPACE)
        if self.dummy_prefix:
            text = SPACE + text
        if not self.by_words or not self.bytes and not self.bpe:
            return [text]
        return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", text)

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


class Encoder:
    """A transducer with its remembered arcs and words."""

    def __init__(self, transducer: Transducer) -> None:
        self.transducer = transducer
        self.arcs: dict[str, dict[str, bool]] = {}
        self.by_parts = PartEncoder(self._encode, limit=MEMO_PARTS)

    def _encode(self, parts: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        if sum(map(len, self.arcs.values())) > ARC_ENTRIES:
            self.arcs.clear()
        t = self.transducer
        parts = sorted(parts)
        found = [t.ids_of(path) for path in t.shortest_paths(parts, self.arcs)]
        flat = np.fromiter((i for ids in found for i in ids), dtype=np.uint32)
        yield parts, flat, np.array([len(ids) for ids in found], dtype=np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text)."""
        return self.by_parts([self.transducer.parts(t) for t in texts])


ENCODED = "doc_id bigint, ids array<int>, n_ids bigint, ids_crc32 bigint, round_trip boolean"


def encode_documents(documents: DataFrame, model_file: str) -> DataFrame:
    """doc_id, ids, n_ids, ids_crc32 (of the ids as little-endian 32-bit integers) and
    round_trip (whether the ids decode to the text) of every whole text."""
    sent = Shared(documents.sparkSession, Encoder(Transducer(model_file)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = sent.value  # stays in the worker, so later tasks find its words
        for batch in batches:
            doc_ids = batch.column(0)
            for start, texts in text_slices(batch.column(1), SLICE_BYTES):
                ids, sizes = encoder(texts)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = ids.astype(np.int32)
                crc, same = [], []
                for row, text in enumerate(texts):
                    mine = ids[ends[row] : ends[row + 1]]
                    crc.append(zlib.crc32(mine.astype("<u4").tobytes()))
                    same.append(encoder.transducer.decode(mine.tolist()) == text)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(start, len(texts)).cast(pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)),
                        pa.array(sizes, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array(same, pa.bool_()),
                    ],
                    names=["doc_id", "ids", "n_ids", "ids_crc32", "round_trip"],
                )
            release()

    return documents.select("doc_id", "text").mapInArrow(encode, ENCODED)


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids (a null list decodes to the empty text)."""
    sent = Shared(encoded.sparkSession, Transducer(model_file))

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        return pa.array([sent.value.decode(x or []) for x in ids.to_pylist()], pa.string())

    return encoded.select("doc_id", decode("ids").alias("text"))


def sentencepiece_query(spark, sf_dir: str) -> DataFrame:
    """Op 9: all documents by piece_bpe_32k."""
    import public_tokenizers

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_documents(documents, public_tokenizers.path("piece_bpe_32k.model"))
