"""Byte-level BPE encoding and decoding with a public rank file.

``encode`` and ``decode`` are column functions: text to ids, ids to bytes; ``round_trip`` does both.
Each worker loads the rank file once. Long texts are cut before the pattern runs, at places where it always ends a
match, so ids equal those of the uncut text whatever its length:

* before a white-space character that follows another character. No match of the pattern goes on
  from the one to the other, and the look-ahead is only tried inside white space;
* a long run of white space is one match up to its last character (to its end, if the text ends
  there). It is merged directly, because the pattern engine's stack grows with such a run.

Null text counts as empty: no ids, no bytes.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the pattern engine has it (Unicode's property).
_WHITE = "".join(
    map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029))
) + "".join(map(chr, (0x202F, 0x205F, 0x3000)))
_RUN = re.compile(f"[{_WHITE}]{{1000,}}")
_SAFE = re.compile(f"[^{_WHITE}](?=[{_WHITE}])")
CHUNK = 1 << 16
# Results go back to Spark in slices of about so many ids (4 MB), whatever the batch.
SLICE = 1 << 20


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The library's encoder over a local rank file (lines of base64 bytes and rank)."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def segments(text: str, chunk: int = CHUNK) -> Iterator[tuple[str, bool]]:
    """The text in pieces, each with whether it is a long run of white space."""
    start = 0
    for run in _RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from ((part, False) for part in _chunks(text, start, run.start(), chunk))
        yield text[run.start() : end], True
        start = end
    yield from ((part, False) for part in _chunks(text, start, len(text), chunk))


def _chunks(text: str, start: int, end: int, chunk: int) -> Iterator[str]:
    while end - start > chunk:
        cut = _SAFE.search(text, start + chunk - 1, end)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    if start < end:
        yield text[start:end]


def encode_text(text: str, rank_file: str, pattern: str, chunk: int = CHUNK) -> list[int]:
    codec = encoding(rank_file, pattern)
    if len(text) <= min(chunk, 1000):
        return codec.encode_ordinary(text)
    ids: list[int] = []
    for part, white in segments(text, chunk):
        # The run is a single match; the library merges its bytes without the pattern.
        ids += codec._encode_single_piece(part) if white else codec.encode_ordinary(part)
    return ids


class _Slice:
    """Results of consecutive texts in flat buffers, which Arrow takes over without a copy."""

    def __init__(self) -> None:
        self.ids, self.ends = array("i"), array("i", [0])
        self.data, self.data_ends = bytearray(), array("i", [0])

    def add(self, ids: list[int] = (), data: bytes = b"") -> None:
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        self.data += data
        self.data_ends.append(len(self.data))

    @property
    def full(self) -> bool:
        return len(self.ids) >= SLICE or len(self.data) >= 4 * SLICE

    def lists(self) -> pa.Array:
        flat = pa.Array.from_buffers(pa.int32(), len(self.ids), [None, pa.py_buffer(self.ids)])
        ends = pa.Array.from_buffers(pa.int32(), len(self.ends), [None, pa.py_buffer(self.ends)])
        return pa.ListArray.from_arrays(ends, flat)

    def blobs(self) -> pa.Array:
        buffers = [None, pa.py_buffer(self.data_ends), pa.py_buffer(self.data)]
        return pa.Array.from_buffers(pa.binary(), len(self.data_ends) - 1, buffers)


def encode(text: Column, rank_file: str, pattern: str) -> Column:
    """Token ids (array<int>) of a text column; ``rank_file`` lies at that path on every worker."""

    @F.arrow_udf("array<int>")
    def token_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            part = _Slice()
            for text in texts:
                part.add(encode_text(text.as_py() or "", rank_file, pattern))
                if part.full:
                    yield part.lists()
                    part = _Slice()
            yield part.lists()

    return token_ids(text)


def decode(ids: Column, rank_file: str, pattern: str) -> Column:
    """The bytes of an array<int> column of token ids. Ids may end inside a character."""

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = encoding(rank_file, pattern)
        for rows in batches:
            part = _Slice()
            for row in rows:
                own = row.values.to_numpy().tolist() if row.is_valid else []
                part.add(data=codec.decode_bytes(own))
                if part.full:
                    yield part.blobs()
                    part = _Slice()
            yield part.blobs()

    return decoded(ids)


def round_trip(text: Column, rank_file: str, pattern: str) -> Column:
    """Struct of ``ids`` and ``bytes``: the token ids, and what these ids decode to.

    Both at once, so the ids do not travel to Python a second time.
    """

    @F.arrow_udf("struct<ids array<int>, bytes binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = encoding(rank_file, pattern)
        for texts in batches:
            part = _Slice()
            for text in texts:
                ids = encode_text(text.as_py() or "", rank_file, pattern)
                part.add(ids, codec.decode_bytes(ids))
                if part.full:
                    yield _coded(part)
                    part = _Slice()
            yield _coded(part)

    return both(text)


def _coded(part: _Slice) -> pa.Array:
    return pa.StructArray.from_arrays([part.lists(), part.blobs()], ["ids", "bytes"])
