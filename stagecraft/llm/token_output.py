"""Operator 3: token ids in packed binary files.

Every text is encoded with a ``tokenizers`` file, an end id follows each document, and the ids
go into files of fixed-width bit packing: each id takes the fewest bits that hold the vocabulary.

A file ("shard") holds documents in ascending (doc_id, hash of the text) order, and so do the
shards by name. Layout, all little-endian:

    magic  8 bytes        "TOKPACK1"
    head   6 x uint64     bits of an id, ids in a block, documents, documents with a null id
                          (they come first), ids, blocks
    ids    int64 each     doc_id of each document (0 for a null)
    sizes  uint64 each    number of ids of each document, the end id included
    blocks uint64 each    byte offset of each block in the payload, and the payload's length
    payload               blocks; bit b of id j of a block is bit j * bits + b of the block

Any range of ids is read by unpacking only its blocks (``read_ids``). A shard holds at most
``SHARD_IDS`` ids, unless one document has more. Documents are dealt by ranges of (doc_id, hash),
so ids that many rows share are spread too; a task holds one batch and one shard at a time. A
shard appears under its name by one rename, so a task that runs again or twice leaves one file.

Defined results: a null or empty text has the end id alone; a null doc_id sorts first; repeated
rows are all written; an empty table gives no shard and no row; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stagecraft.llm.common import PartEncoder, new_folder, qualified, text_slices

MAGIC = b"TOKPACK1"
HEAD = "<6Q"
BLOCK_IDS = 4096
# Characters and parts that go to the library at once.
ENCODE_CHARS = 100_000
JOINED_PARTS = 2000
# Parts that a worker remembers, and bytes of text that it encodes in one go.
MEMO_PARTS = 1_000_000
TEXT_BYTES = 6 << 20
SHARD_IDS = 4_000_000
# A space and white space: there a pre-token may end elsewhere.
AFTER_SPACE = [" " + c for c in " \t\n\x0b\x0c\r\x85\xa0"]
# Characters whose classes all Unicode versions agree on; a text with others is encoded whole.
SETTLED = re.compile("[^\\x00-\\u024f\\u2010-\\u2027\\u20a0-\\u20ac]")
# Letters, then ASCII marks but no apostrophe: after a space these are two pre-tokens at most.
PLAIN = re.compile("([A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u024f]+)([!-&(-/:-@\\[-`{-~]*)")
# The characters that stand for bytes in byte-level files, where they aren't the byte's own.
UNPRINTED = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate(UNPRINTED)}
AFTER = BYTE_CHARS[ord(" ")]


# -- packing -----------------------------------------------------------------
def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id under ``vocabulary``."""
    return max(int(vocabulary - 1).bit_length(), 1)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """One block: ids of ``bits`` bits each, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    matrix = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(matrix.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(block: bytes, bits: int, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    if bits in (8, 16, 32):
        return np.frombuffer(block, dtype=f"<u{bits // 8}", count=n).astype(np.uint32)
    matrix = np.unpackbits(np.frombuffer(block, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return matrix.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


def shard_bytes(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK_IDS) -> bytes:
    """A shard file; documents with a null id must come first."""
    blocks = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    nulls = sum(d is None for d in doc_ids)
    head = struct.pack(HEAD, bits, block, len(doc_ids), nulls, len(ids), len(blocks))
    table = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    return b"".join([MAGIC, head, table.tobytes(), sizes.astype("<u8").tobytes(), offsets.tobytes(), *blocks])


class Shard:
    """A shard file's content, unpacked on demand."""

    def __init__(self, content: bytes) -> None:
        if bytes(content[:8]) != MAGIC:
            raise ValueError("not a token shard")
        self.content = content
        self.bits, self.block, n, nulls, self.n_ids, n_blocks = struct.unpack_from(HEAD, content, 8)
        at = 8 + struct.calcsize(HEAD)
        self.doc_ids = np.frombuffer(content, "<i8", n, at)
        self.null = np.arange(n) < nulls
        self.sizes = np.frombuffer(content, "<u8", n, at + 8 * n).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.offsets = np.frombuffer(content, "<u8", n_blocks + 1, at + 16 * n)
        self._payload = at + 16 * n + 8 * (n_blocks + 1)

    def read_ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard, from their blocks alone."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        parts = []
        for b in range(first, last + 1):
            n = min(self.block, self.n_ids - b * self.block)
            raw = self.content[self._payload + int(self.offsets[b]) : self._payload + int(self.offsets[b + 1])]
            parts.append(unpack(raw, self.bits, n))
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]


# -- encoding ----------------------------------------------------------------
class Encoder:
    """Ids of whole texts by a ``tokenizers`` file.

    Plain byte-level BPE never joins pre-tokens, and before a space that a visible character
    follows a pre-token always ends. So the library encodes each distinct part between such
    spaces once, and a text's ids are those of its parts. Other files, and texts that spell a
    special token, hold rare characters or have other white space after a space, go through the
    library whole.
    """

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        told = json.loads(spec)
        before = told.get("pre_tokenizer") or {}
        self.in_parts = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not told.get("normalizer")
            and not told.get("truncation")
            and not told.get("padding")
        )
        special = [t["content"] for t in told.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.bytes_of = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.bytes_of[i] = len(token)  # byte-level: a character stands for a byte
        self.model = self.tokenizer.model
        self.by_parts = PartEncoder(self.parts, limit=MEMO_PARTS)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts, a few at a time (the library's results are large)."""
        out: list[np.ndarray] = []
        start = size = 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= ENCODE_CHARS or i + 1 == len(texts):
                found = self.tokenizer.encode_batch_fast(texts[start : i + 1], add_special_tokens=False)
                out += [np.array(e.ids, dtype=np.uint32) for e in found]
                start, size = i + 1, 0
        return out

    def parts(self, keys: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Ids of parts, in groups (keys, all ids, number of each). A key stands for itself after
        a space; one that begins with a space stands for the rest of it, a text's start. Of plain
        words the library's model gets the pre-tokens; other parts after a space are joined and
        encoded in one go, and cut at their lengths in bytes."""
        starts = [k for k in keys if k[0] == " "]
        if starts:
            found = self.whole([k[1:] for k in starts])
            yield starts, np.concatenate(found), np.array([len(f) for f in found], dtype=np.int64)
        later: list[str] = []
        yield from self.plain((k for k in keys if k[0] != " "), later)
        for i in range(0, len(later), JOINED_PARTS):
            group = later[i : i + JOINED_PARTS]
            text = " " + " ".join(group)
            (ids,) = self.whole([text])
            ends = np.cumsum(list(map(len, group)) if text.isascii() else [len(k.encode()) for k in group])
            cut = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends + np.arange(1, len(group) + 1)) + 1
            yield group, ids, np.diff(cut, prepend=0)

    def plain(self, keys: Iterator[str], others: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """The group of :meth:`parts` whose keys match PLAIN; the rest goes to ``others``."""
        group: list[str] = []
        ids, sizes = array("I"), array("q")
        ends: dict[str, list[int]] = {"": []}  # of the marks
        tokenize, match, id_of = self.model.tokenize, PLAIN.fullmatch, attrgetter("id")
        for key in keys:
            found = match(key)
            if not found:
                others.append(key)
                continue
            word, marks = found.groups()
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(BYTE_CHARS)
            if marks not in ends:
                ends[marks] = [t.id for t in tokenize(marks)]
            own = [*map(id_of, tokenize(AFTER + word)), *ends[marks]]
            ids.extend(own)
            sizes.append(len(own))
            group.append(key)
        if group:
            yield group, np.array(ids, dtype=np.uint32), np.array(sizes, dtype=np.int64)

    def regular(self, text: str) -> bool:
        """Whether the text can be encoded in parts."""
        return not (
            text.endswith(" ")
            or any(x in text for x in AFTER_SPACE)
            or SETTLED.search(text)
            or self.special
            and self.special.search(text)
        )

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text)."""
        direct = [i for i, t in enumerate(texts) if not self.in_parts or not self.regular(t)]
        if not direct:
            return self._in_parts(texts)
        apart = dict(zip(direct, self.whole([texts[i] for i in direct])))
        ids, sizes = self._in_parts([t for i, t in enumerate(texts) if i not in apart])
        rest = iter(np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else ())
        found = [apart[i] if i in apart else next(rest) for i in range(len(texts))]
        return np.concatenate(found), np.array([len(f) for f in found], dtype=np.int64)

    def _in_parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        keys = [t.split(" ") for t in texts]
        for of in keys:
            if of[0]:
                of[0] = " " + of[0]
            else:  # the text begins with a space (or is empty)
                del of[0]
        return self.by_parts(keys)


# -- files -------------------------------------------------------------------
def write_tokens(documents: DataFrame, tokenizer_file: str, folder: str, end_id: int = 0) -> DataFrame:
    """Write the shards of ``documents`` (doc_id, text) into ``folder`` and return their table:
    shard, n_docs, n_ids (kept as Parquet in ``folder``/manifest)."""
    from tokenizers import Tokenizer

    spark = documents.sparkSession
    folder = qualified(spark, folder)
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = f.read()
    bits = bits_for(max(Tokenizer.from_str(spec).get_vocab_size(with_added_tokens=True), end_id + 1))
    sent = spark.sparkContext.broadcast({"spec": spec})
    spread = F.xxhash64("text")
    ordered = (
        documents.select("doc_id", "text", spread.alias("spread"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("spread"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "spread", "text")
        .select("doc_id", "text")
    )
    made = ordered.mapInArrow(_writer(sent, folder, bits, end_id), "shard string, n_docs bigint, n_ids bigint")
    made.write.parquet(f"{folder}/manifest")
    return spark.read.schema(made.schema).parquet(f"{folder}/manifest")


def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder's qualified URI (``file:/..`` is local)."""
    if "://" in uri:
        return pyarrow.fs.FileSystem.from_uri(uri)
    return pyarrow.fs.LocalFileSystem(), uri.removeprefix("file:")


def _writer(sent, folder: str, bits: int, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "encoder" not in sent.value:  # stays in the worker, so later tasks find its words
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            sent.value["encoder"] = Encoder(sent.value["spec"])
        encode = sent.value["encoder"]
        task = TaskContext.get()
        files, path = open_folder(folder)
        files.create_dir(f"{path}/shards", recursive=True)
        docs: list[int | None] = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held, n = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, n
            name = f"shard-{task.partitionId():08d}-{n:06d}.bin"
            content = shard_bytes(docs, np.concatenate(sizes), np.concatenate(ids), bits)
            part = f"{path}/shards/_{name}.{task.taskAttemptId()}"
            with files.open_output_stream(part) as out:
                out.write(content)
            files.move(part, f"{path}/shards/{name}")
            row = pa.RecordBatch.from_pydict({"shard": [name], "n_docs": [len(docs)], "n_ids": [held]})
            docs.clear(), sizes.clear(), ids.clear()
            held, n = 0, n + 1
            return row

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for start, texts in text_slices(batch.column(1), TEXT_BYTES):
                flat, counts = encode(texts)
                ends = np.cumsum(counts)
                flat = np.insert(flat, ends, end_id)  # after each document
                docs += doc_ids[start : start + len(texts)]
                sizes.append(counts + 1)
                ids.append(flat)
                held += len(flat)
                if held >= SHARD_IDS:
                    yield flush()
        if docs:
            yield flush()

    return write


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """shard, doc_id, start (in the shard), n_tokens and ids_crc32 of every document in the files."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(content.as_buffer().to_pybytes())
                ids = shard.read_ids(0, shard.n_ids).astype("<u4")
                crc = [
                    zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(shard.starts.tolist(), shard.sizes.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path.rpartition("/")[2]] * len(crc), pa.string()),
                        pa.array(shard.doc_ids, pa.int64(), mask=shard.null),
                        pa.array(shard.starts, pa.int64()),
                        pa.array(shard.sizes, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(f"{folder}/shards")
    return files.select("path", "content").mapInArrow(
        read, "shard string, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_table(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document.

    The running sum of the shards' sizes is one window over one row per shard."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    return (
        read_tokens(spark, folder)
        .join(shards, "shard")
        .select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
    )


def token_query(spark, sf_dir: str) -> DataFrame:
    """Op 3: all documents by byte_bpe_50k with end id 0, from the files."""
    import public_tokenizers

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "tokens")
    manifest = write_tokens(documents, public_tokenizers.path("byte_bpe_50k.json"), folder, end_id=0)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return token_table(spark, folder, manifest)
