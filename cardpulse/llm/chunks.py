"""Encoding whole texts word by word with a cache.

The split pattern of byte-level vocabularies never joins what a white-space rule or the end of a word separates, so
a text is the concatenation of chunks that encode on their own to the same ids. Most chunks are frequent words; only
those not seen before go to the tokenizer.
"""

from __future__ import annotations

import re

# White space as the split pattern takes it (fixed values); Python's own class has four control characters more.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# What is no white space stays in one chunk, except that a word of letters before a full stop, a comma or white space
# is a chunk of its own, and a Latin word before any ASCII sign or digit. Chunk borders are borders of the pattern.
_CHUNK = re.compile(
    f" ?[^\\W\\d_]++(?![^{_SPACE}.,])| ?[A-Za-zÀ-ÖØ-öø-ɏ]++(?=[!-@\\[-`{{-~])| ?[^{_SPACE}]+|"
    f"[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_BLANK = re.compile(f"[{_SPACE}]+")


def ids_by_chunk(chunks: list[str], encode, newline: int) -> list[bytes]:
    """The ids of each chunk as little-endian unsigned 32-bit numbers. Chunks with something other than white space go
    to ``encode`` (text to ids) as the lines of one text: a line feed between them is always a token of its own, with
    the id ``newline``, and no such chunk holds one.
    """
    import numpy as np

    out: list = [None] * len(chunks)
    lines = []
    for i, chunk in enumerate(chunks):
        if _BLANK.fullmatch(chunk):
            out[i] = np.asarray(encode(chunk), dtype="<u4").tobytes()
        else:
            lines.append(i)
    if lines:
        ids = np.asarray(encode("\n".join([chunks[i] for i in lines])), dtype="<u4")
        ends = np.append(np.flatnonzero(ids == newline), len(ids))
        if len(ends) != len(lines):
            raise ValueError("the vocabulary does not keep line feeds apart")
        raw = ids.tobytes()
        begins = [0, *(4 * ends[:-1] + 4).tolist()]
        for i, begin, end in zip(lines, begins, (4 * ends).tolist()):
            out[i] = raw[begin:end]
    return out


class ChunkEncoder:
    """``encode(texts)`` gives for each text the list of its chunks' values.

    ``make`` maps a list of new chunks to their values. Up to ``limit`` chunks of at most 64 characters stay in the
    cache; beyond that, new ones are made anew in each batch. Results don't depend on it.
    """

    def __init__(self, make, limit: int = 400_000):
        self.make, self.limit, self.known = make, limit, {}

    def encode(self, texts: list[str]) -> list[list]:
        get = self.known.get
        split = [_CHUNK.findall(t) for t in texts]
        found = [list(map(get, chunks)) for chunks in split]
        missed = {}  # chunk to the places (text, position) that lack its value
        for i, values in enumerate(found):
            at = -1
            for _ in range(values.count(None)):
                at = values.index(None, at + 1)
                missed.setdefault(split[i][at], []).append((i, at))
        new = list(missed)
        for start in range(0, len(new), 10_000):
            part = new[start:start + 10_000]
            for chunk, value in zip(part, self.make(part)):
                for i, at in missed[chunk]:
                    found[i][at] = value
                if len(self.known) < self.limit and len(chunk) <= 64:
                    self.known[chunk] = value
        return found


def text_groups(column, size: int = 4_000_000):
    """The strings of an Arrow column (null: empty) in lists of about ``size`` characters."""
    group, held = [], 0
    for value in column:
        text = value.as_py() or ""
        group.append(text)
        held += len(text)
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group
