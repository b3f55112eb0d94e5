"""Byte-level BPE over rank files with the tokenizers library, and back."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def byte_table() -> list[str]:
    """The visible character of each byte: printable ones stand for themselves, the others follow from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts from which merging by rank makes ``token``; None if it never does.

    Merges are never undone, so wherever a token arises by merging, the merges inside it are those of the token on its
    own, and its last two parts are always the same. One merge for each token thus gives what "merge the adjacent pair
    whose union ranks lowest" gives.
    """
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if at < 0:
            return None
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


@lru_cache(maxsize=2)
def _tools(path: str, pattern: str, chunked: bool):
    """A function from texts to their ids in parts (bytes), and the bytes of each id. The chunks of ``chunks`` end where
    matches of one pattern end; for others whole texts are encoded (``chunked`` false).
    """
    import numpy as np
    from tokenizers import Regex, Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

    from cardpulse.llm.chunks import ChunkEncoder, ids_by_chunk

    ranks = read_ranks(path)
    table = byte_table()
    shown = {token: "".join(table[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        if len(token) > 1 and (pair := last_merge(token, ranks)):
            merges.append((shown[pair[0]], shown[pair[1]]))
    # A word that is a token as a whole is taken as such, whether or not merges make it.
    model = BPE({shown[t]: r for t, r in ranks.items()}, merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = Sequence([
        Split(Regex(pattern), "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)])

    def encode(text):
        return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    newline = encode("\n")[0]
    encoder = ChunkEncoder(lambda chunks: ids_by_chunk(chunks, encode, newline)).encode if chunked else (
        lambda texts: [[np.asarray(encode(t), dtype="<u4").tobytes()] for t in texts])
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return encoder, pieces


def char_starts(text: str, lengths):
    """For ids of ``lengths`` bytes each, the character in which each one starts. An id that starts inside a character
    gets that character.
    """
    import numpy as np

    raw = np.frombuffer(text.encode(), np.uint8)
    char_of_byte = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char_of_byte[np.cumsum(lengths) - lengths].astype(np.int32)


def _encode(path: str, pattern: str, offsets: bool, chunked: bool):
    def run(batches: Iterator) -> Iterator:
        import os

        import numpy as np
        import pyarrow as pa

        from cardpulse.llm.chunks import text_groups

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, pieces = _tools(path, pattern, chunked)
        sizes = np.array([len(p) for p in pieces]) if offsets else None
        for batch in batches:
            at = 0
            for texts in text_groups(batch.column(1)):
                ids = [np.frombuffer(b"".join(chunks), "<i4") for chunks in encoder(texts)]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(ends, np.concatenate(ids))]
                if offsets:
                    starts = [char_starts(t, sizes[i]) for t, i in zip(texts, ids)]
                    lists.append(pa.ListArray.from_arrays(ends, np.concatenate(starts)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), *lists],
                    names=["doc_id", "ids", *["offsets"] * offsets])
                at += len(texts)

    return run


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, offsets: bool = False,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every whole text, optionally with ``offsets``: the character at which
    each id starts.

    Ids are those that merging by rank gives within each match of ``pattern`` (which has to match all of a text); no
    special tokens. Words are cached only for ``public_tokenizers.PATTERN``. Null texts are
    empty and have no ids; null ids, repeated rows and repeated ids stay as they are, one row each; other columns
    are ignored.
    """
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _encode(ranks_path, pattern, offsets, pattern == public_tokenizers.PATTERN), "doc_id bigint, ids array<int>" + ", offsets array<int>" * offsets)


def _decode(path: str, pattern: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        _, pieces = _tools(path, pattern, True)
        piece = pieces.__getitem__
        for batch in batches:
            raw = [b"".join(map(piece, ids.as_py() or ())) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["doc_id", "ids", "decoded"])

    return run


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the bytes of all ids joined. Bytes are joined before anything reads
    them as text, so characters that are split between ids come out whole; null ids decode to no bytes.
    """
    return encoded.select("doc_id", "ids").mapInArrow(
        _decode(ranks_path, pattern), "doc_id bigint, ids array<int>, decoded binary")


def decoded_text(raw: bytes) -> str:
    """Decoded bytes as text; the bytes of a character that is cut off become U+FFFD."""
    return raw.decode("utf-8", errors="replace")
