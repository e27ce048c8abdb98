"""Token ids of a whole corpus by a public byte-level BPE, with content-defined chunk reuse.

Texts are cut where a rolling hash of the last code points says so, so equal passages of different documents are cut
alike. Each chunk is encoded once in a task and kept; further documents take its tokens from there. A cut may fall inside a word, so the
joins are repaired: what lies between a cut and the next safe place is encoded again with the chunk on its left, whose end moves there. At a
safe place the pre-tokenizer's pattern starts a new piece whatever surrounds it, so both sides agree with the whole text from there on;
where the next chunk has no safe place the two are encoded as one. The result equals that of the whole text.

Memory is bounded: the store of chunks is emptied when it holds more than ``STORE_CHARS`` characters.
"""

from __future__ import annotations

import base64
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
TOKENIZER = "byte_bpe_50k"
WINDOW = 16  # a power of two
CUT_BITS = 8
STORE_CHARS = 24_000_000
# The pre-tokenizer pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LETTER, NUMBER, OTHER, SPACE, UNSURE = 0, 1, 2, 3, 4


@lru_cache(maxsize=2)
def encoding(path: str):
    """The encoder of one vocabulary file (token ranks), once per process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of each code point as the pattern sees it; what versions of Unicode may disagree on is UNSURE."""
    out = np.full(0x110000, UNSURE, dtype=np.uint8)
    kind = {"L": LETTER, "N": NUMBER, "P": OTHER, "S": OTHER, "M": OTHER}
    for cp in range(0x30000):
        c = unicodedata.category(chr(cp))
        if c[0] in kind:
            out[cp] = kind[c[0]]
    out[[32, 9, 10, 13]] = SPACE
    return out


def safe_places(cp: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """True at i if a piece of the pattern starts at i in any context that holds cp[i-1 : i+2].

    Between different classes of non-space a piece ends, unless an apostrophe may bind the letter (contractions); before one plain
    blank between two non-spaces a piece starts.
    """
    n = len(cp)
    safe = np.zeros(n + 1, dtype=bool)
    if n < 3:
        return safe[:n]
    before, here, after = cls[:-2], cls[1:-1], cls[2:]
    text = (before < SPACE) & (here < SPACE) & (before != here) & (cp[:-2] != 39)
    blank = (before < SPACE) & (cp[1:-1] == 32) & (after < SPACE)
    safe[1 : n - 1] = text | blank
    return safe[:n]


def cut_places(cp: np.ndarray, bits: int = CUT_BITS) -> np.ndarray:
    """True at i if a chunk starts at i: the rolling hash of the WINDOW code points before i has its low bits clear."""
    cut = np.zeros(len(cp), dtype=bool)
    if len(cp) <= WINDOW:
        return cut
    h = (cp.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(7)
    h ^= h >> np.uint32(11)
    wide = 1
    while wide < WINDOW:  # the hash of a window from those of its halves
        h = h[:-wide] + h[wide:] * np.uint32(pow(31, wide, 1 << 32))
        wide *= 2
    h ^= h >> np.uint32(15)
    cut[WINDOW:] = (h[:-1] & np.uint32((1 << bits) - 1)) == 0
    return cut


class ChunkEncoder:
    """Encodes texts through a store of chunks."""

    def __init__(self, path: str, bits: int = CUT_BITS):
        self.enc = encoding(path)
        self.cls = char_classes()
        self.bits = bits
        self.store: dict[str, np.ndarray] = {}
        self.held = 0
        self.used = self.encoded = 0

    def chunk(self, text: str) -> np.ndarray:
        self.used += 1
        found = self.store.get(text)
        if found is None:
            found = self.enc.encode_to_numpy(text, disallowed_special=())
            self.encoded += 1
            if self.held > STORE_CHARS:
                self.store.clear()
                self.held = 0
            self.store[text] = found
            self.held += len(text)
        return found

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each text."""
        whole = "".join(texts)
        cp = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        start = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        cut = np.flatnonzero(cut_places(cp, self.bits))
        text = np.searchsorted(start, cut, side="right") - 1
        cut, text = cut[cut - start[text] >= WINDOW], text[cut - start[text] >= WINDOW]  # a window lies in one text
        safe = np.flatnonzero(safe_places(cp, self.cls[np.minimum(cp, 0x10FFFF)]))
        at = np.searchsorted(safe, cut)
        cut, text, at = cut[at < len(safe)], text[at < len(safe)], at[at < len(safe)]
        repaired = safe[at]
        repaired = np.unique(repaired[repaired < start[text + 1]])
        edges = np.unique(np.concatenate([start, repaired])).tolist()
        flat = [self.chunk(whole[i:j]) for i, j in zip(edges[:-1], edges[1:], strict=True)]
        size = np.concatenate([[0], np.cumsum([len(x) for x in flat], dtype=np.int64)])
        count = np.diff(size[np.searchsorted(edges, start)])
        return (np.concatenate(flat).astype(np.int32) if flat else np.zeros(0, dtype=np.int32)), count


def token_path(folder: str = TOKENIZER_DIR, name: str = TOKENIZER) -> str:
    return os.path.join(folder, f"{name}.tiktoken")


def token_ids(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZER_DIR, name: str = TOKENIZER, also: tuple[str, ...] = ()) -> DataFrame:
    """``key`` and ``ids`` of every row, without special tokens; their strings in a text are ordinary text.

    Null and empty texts have the empty list. Rows with a null or repeated key all come out. Texts of any length are encoded
    whole. An empty input gives no rows. Only ``key`` and the columns of ``also`` are kept beside ``ids``.
    """
    path = token_path(folder, name)
    rows = df.select(key, *also, F.coalesce(F.col(text), F.lit("")).alias("__text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, count = encoder.encode_batch(part.column(part.num_columns - 1).to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(part.num_columns - 1)), lists], [*part.schema.names[:-1], "ids"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(encode, ", ".join(f"`{c}` {kinds[c]}" for c in (key, *also)) + ", ids array<int>")


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZER_DIR, name: str = TOKENIZER, also: tuple[str, ...] = ()) -> DataFrame:
    """``key`` and ``tokens``, the number of ids of each row; the ids stay in the Python task."""
    path = token_path(folder, name)
    rows = df.select(key, *also, F.coalesce(F.col(text), F.lit("")).alias("__text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(path)
        for batch in batches:
            n = np.concatenate([encoder.encode_batch(batch.slice(at, 500).column(batch.num_columns - 1).to_pylist())[1] for at in range(0, batch.num_rows, 500)] or [np.zeros(0, dtype=np.int64)])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(n)], [*batch.schema.names[:-1], "tokens"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(count, ", ".join(f"`{c}` {kinds[c]}" for c in (key, *also)) + ", tokens bigint")
