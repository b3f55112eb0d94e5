"""Sum-of-squares packing of tokenised documents into fixed windows."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_DDL = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
)


class SumOfSquaresPacker:
    """Places items one by one, each into the fill level (or a new window) after which the sum of the squared counts
    of partially filled windows is least. The counts of all levels are one array; ties go to the fullest level.
    """

    def __init__(self, capacity: int):
        import numpy as np

        self.capacity = capacity
        self.count = np.zeros(capacity + 1, dtype=np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """The window and offset of an item of 1 to ``capacity`` units."""
        room = self.capacity - size
        # From level g to g + size: the sum changes by 2 (count[g + size] - count[g]) + 2, or without the first part
        # where the window is full, or without the second where it is new.
        change = 2 * self.count[size:] + 1
        change[-1] = 0
        here = self.count[:room + 1]
        change[1:] += 1 - 2 * here[1:]
        change[1:][here[1:] == 0] = 1 << 62
        level = int(room - change[::-1].argmin())
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
        else:
            window = self.made
            self.made += 1
        if level + size < self.capacity:
            self.open[level + size].append(window)
            self.count[level + size] += 1
        return window, level


@lru_cache(maxsize=2)
def _encoder(path: str):
    from tokenizers import Tokenizer

    from cardpulse.llm.chunks import ChunkEncoder, ids_by_chunk

    tokenizer = Tokenizer.from_file(path)

    def encode(text):
        return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    newline = encode("\n")[0]

    def make(chunks):
        return ids_by_chunk(chunks, encode, newline)

    return ChunkEncoder(make, limit=1_000_000)


def _cut(path: str, capacity: int, end_id: int):
    """A function from batches (doc_id, text) to pieces of at most ``capacity`` ids."""

    def cut(batches: Iterator) -> Iterator:
        import os
        from zlib import crc32

        import pyarrow as pa

        from cardpulse.llm.chunks import text_groups

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(path)
        end = end_id.to_bytes(4, "little")
        wide = 4 * capacity
        for batch in batches:
            at = 0
            doc_ids = batch.column(0).to_pylist()
            for texts in text_groups(batch.column(1)):
                rows = []
                for chunks in encoder.encode(texts):
                    doc_id = doc_ids[at]
                    at += 1
                    ids = b"".join(chunks) + end
                    total = len(ids) // 4
                    for first in range(0, len(ids), wide):
                        piece = ids[first:first + wide]
                        rows.append((doc_id, first // 4, len(piece) // 4, crc32(piece), total))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return cut


def document_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every document's ids (``end_id`` last) cut at multiples of ``capacity``: doc_id, start, length, ids_crc32,
    doc_tokens. Pieces carry no ids; a reader of the texts makes them again. Each text is encoded whole.
    """
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _cut(tokenizer_path, capacity, end_id), PIECE_DDL)


def _pack(capacity: int):
    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        packer = SumOfSquaresPacker(capacity)
        for batch in batches:
            placed = [packer.place(size) for size in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array([base + w for w, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())],
                names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return pack


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of ``document_pieces`` with ``sequence_id`` and ``offset``.

    A null or empty text is one piece that holds ``end_id`` only. Repeated rows are packed as separate documents, also
    where they share an id; a null id stays null. Other columns are ignored; an empty table packs to nothing.

    Texts are encoded where they are read; only pieces, some 40 bytes each, are shuffled. Each task packs its share in
    the order of ids with a packer of its own, whose memory is one number per open window. Adaptive execution sets
    the number of tasks by the volume of pieces, so windows that stay partly filled are few against all.
    """
    pieces = document_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    shares = pieces.repartition(F.xxhash64("doc_id", "start", "ids_crc32")).sortWithinPartitions(
        "doc_id", "start", "ids_crc32")
    return shares.mapInArrow(_pack(capacity), PIECE_DDL + ", sequence_id bigint, offset bigint")
