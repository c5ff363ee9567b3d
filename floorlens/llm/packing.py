"""Bounded-space online best-fit packing of token sequences.

Each task takes its documents in input order and keeps a fixed number of open bins. A bit
set has one bit for each free space that some open bin has; the lowest set bit at or above a
piece's length is the best fit. If nothing fits and all bins are in use, the fullest is
closed, then a new one opens. Only documents longer than a bin are cut.

The packing follows the input's own partitions without a shuffle, so a lost task packs the
same rows again in the same order and gives the same bins. Small partitions are coalesced
first, to about `partition_bytes`, as every task leaves its open bins as they are.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floorlens.llm.common import fresh, text_of

CAPACITY = 4096
ROWS_AT_ONCE = 200
END_ID = 1
#: Fixed value: the tokenizer's word pattern, for lower-case letters up to U+00FF.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+"
#: Printable ASCII and composed Latin letters: what that form of the pattern holds for.
_SIMPLE = r"[!-~À-ÖØ-öø-ÿ]*"


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte beyond ASCII: bytes that
    are printable in Latin-1 stand for themselves, others follow from U+0100 in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b if b in shown else 256 + rest.index(b)) for b in range(128, 256)}


class OpenBins:
    """Open bins in a bit set keyed by free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.count, self.opened = 0, 0, 0
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]

    def place(self, length: int) -> tuple[int, int]:
        """The bin that takes `length` tokens, and the offset in it."""
        fits = self.bits >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.count == self.most:  # the fullest has the least free space: the lowest bit
                self._take((self.bits & -self.bits).bit_length() - 1)
            space, number = self.capacity, self.opened
            self.opened += 1
        if space > length:  # a full bin is closed at once
            self.by_space[space - length].append(number)
            self.bits |= 1 << (space - length)
            self.count += 1
        return number, self.capacity - space

    def _take(self, space: int) -> int:
        stack = self.by_space[space]
        number = stack.pop()
        if not stack:
            self.bits ^= 1 << space
        self.count -= 1
        return number


class ChunkIds(dict):
    """Token ids of space-free chunks, as little-endian 32-bit bytes.

    No token of a tokenizer that drops white space crosses a space or line end, so a text's
    ids are those of its chunks. Chunks of common letters are split into words here and only new
    words go to the tokenizer's model; others go through the whole tokenizer. Long chunks and
    words are not remembered, and both memories are forgotten in whole when they grow large:
    they hold some 40 MB at most, whatever the texts.
    """

    LIMIT, LONGEST = 120_000, 40

    def __init__(self, path: str | None):
        super().__init__()
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.split, self.simple = re.compile(_WORDS).findall, re.compile(_SIMPLE).fullmatch
        self.letters = _byte_letters()

    def __missing__(self, chunk: str) -> bytes:
        if self.simple(chunk) and "<|" not in chunk:
            known, learn = self.words.get, self._word
            ids = b"".join([known(w) or learn(w) for w in self.split(chunk.lower())])
        else:
            ids = array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.clear()
            self[chunk] = ids
        return ids

    def _word(self, word: str) -> bytes:
        coded = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.model.tokenize(coded)]).tobytes()
        if len(word) <= self.LONGEST:
            if len(self.words) >= self.LIMIT:
                self.words.clear()
            self.words[word] = ids
        return ids

    def ids_of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def token_pieces(ids: bytes, capacity: int) -> Iterator[tuple[int, bytes]]:
    """Start and ids of each piece of a document that ends with the end id."""
    for start in range(0, len(ids), 4 * capacity):
        yield start // 4, ids[start : start + 4 * capacity]


def packed(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    open_bins: int = 256,
    tokenizer: str | None = None,
    partition_bytes: int = 128 << 20,
) -> DataFrame:
    """Pieces of all documents: key, piece, start, length, ids (32-bit little-endian),
    sequence_id, offset.

    `tokenizer` is a tokenizer file on every executor (None: the public 49k word BPE).
    A null or empty text is its end id alone. Null or repeated keys are kept, a document for
    each row; other columns are left out; an empty table gives an empty result.
    """
    name = fresh(df.select(key), "_text")
    docs = df.select(F.col(key), text_of(text).alias(name))
    total = docs.agg(F.sum(F.octet_length(name).cast("long"))).first()[0] or 0
    docs = docs.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-total // partition_bytes)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        chunk_ids, bins = ChunkIds(tokenizer), OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        end = END_ID.to_bytes(4, "little")
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):  # only so many texts and their ids are held as Python values
                some = batch.slice(first, ROWS_AT_ONCE)
                at, rows = [], []
                for i, ids in enumerate(map(chunk_ids.ids_of, some.column(1).to_pylist())):
                    for piece, (start, part) in enumerate(token_pieces(ids + end, capacity)):
                        length = len(part) // 4
                        number, offset = bins.place(length)
                        at.append(i)
                        rows.append((piece, start, length, part, base + number, offset))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = [key, "piece", "start", "length", "ids", "sequence_id", "offset"]
                yield pa.record_batch([some.column(0).take(pa.array(at, pa.int32())), *columns], names=names)

    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    return docs.mapInArrow(pack, schema)


def packing_digest(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        F.col(key).alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
