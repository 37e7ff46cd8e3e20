"""Compressed sizes against raw-content zstandard dictionaries (for operators 5 and 7)."""

from __future__ import annotations

import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F

# A text is compressed in pieces of this many bytes, each against the dictionary alone, so
# that the dictionary matters as much at the end of a long text as at its start.
PIECE_BYTES = 4096
LEVEL = 3
# Bytes of training text in one dictionary at most.
DICTIONARY_BYTES = 256 << 10


def fair_share(sizes: list[int], limit: int) -> int:
    """The largest size to cut to so that all together, a byte between them, take ``limit`` bytes."""
    left, most = limit - len(sizes), 0
    for n, size in enumerate(sorted(sizes)):
        most = left // (len(sizes) - n)
        if size > most:
            return max(most, 0)
        left -= size
    return max(sizes, default=0)


def dictionary(snippets: list[bytes], limit: int = DICTIONARY_BYTES) -> bytes:
    """Training snippets one after another. Each of them is in it: where they take more than
    ``limit`` bytes together, the longest are cut to the same size."""
    most = fair_share([len(x) for x in snippets], limit)
    return b"\n".join(x[:most] for x in snippets)


def passage(text: Column, doc_id: Column, chars: int) -> Column:
    """``chars`` characters of a text from a place that its id's hash chooses; a shorter text whole."""
    places = F.greatest(F.length(text) - chars + 1, F.lit(1))
    start = F.pmod(F.xxhash64(doc_id.cast("string"), F.lit("place")), places) + 1
    return F.substring(text, start.cast("int"), F.lit(chars))


class Sizer:
    """Compressed size of a whole text against one dictionary."""

    def __init__(self, content: bytes) -> None:
        if len(content) >= 8:
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            options = {"dict_data": data}
        else:
            options = {}
        self._compress = zstandard.ZstdCompressor(
            level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **options
        ).compress

    def __call__(self, text: memoryview) -> int:
        return sum(len(self._compress(text[i : i + PIECE_BYTES])) for i in range(0, len(text), PIECE_BYTES))
