"""Byte-level BPE encoding and decoding as a monoid tree reduction.

The encodings of byte strings form a monoid: ``join(encode(x), encode(y)) ==
encode(x + y)``. A pre-token is encoded by halving it recursively and joining the
halves. A join re-encodes a window of tokens around the seam and widens it until
the seam's two neighbours stand still. The proof of that rests on a property of
rank-ordered merging: a token sequence is the encoding of its bytes exactly if
every two adjacent tokens are the encoding of theirs. So once the window's first and
last token agree with the token before and after it, nothing outside can change.
Decoding maps ids to bytes at the leaves and concatenates up the tree.

Defined results: a null or empty text has no tokens and decodes to nothing; a
repeated row is encoded again; invalid UTF-8 is read with U+FFFD; an empty table
gives an empty table. Columns beside the text column are passed through.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skein.llm.batches import list_array, small_batches, text_slices, texts_of

LEAF_BYTES = 8  # pieces up to this length are merged directly
SCAN_BYTES = 64
_NO_RANK = 1 << 60
LEAF_IDS = 512  # ids joined at a leaf of the decoding tree
CACHE_ENTRIES = 500_000  # bound of each memo table in a worker


class Bpe:
    """Encoder and decoder for one rank file (token bytes in base64, rank)."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self._short: dict[bytes, tuple[int, ...]] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._fits: dict[tuple[int, int], bool] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Lowest rank first, leftmost first: the encoding by definition."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        n = len(piece)
        if n <= SCAN_BYTES:  # few parts: scanning them is faster than a heap
            parts = [piece[i:i + 1] for i in range(n)]
            rank = [ranks.get(piece[i:i + 2], _NO_RANK) for i in range(n - 1)]
            while rank and (low := min(rank)) != _NO_RANK:
                i = rank.index(low)
                parts[i:i + 2] = [pair := parts[i] + parts[i + 1]]
                del rank[i]
                if i:
                    rank[i - 1] = ranks.get(parts[i - 1] + pair, _NO_RANK)
                if i < len(rank):
                    rank[i] = ranks.get(pair + parts[i + 1], _NO_RANK)
            return tuple(map(ranks.__getitem__, parts))
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        part: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
        heap = [(ranks[p], i, p) for i in range(n - 1) if (p := piece[i:i + 2]) in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = nxt[i] if part[i] is not None else n
            if j >= n or part[i] + part[j] != pair:
                continue
            part[i], part[j], nxt[i] = pair, None, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
                if (p := pair + part[nxt[j]]) in ranks:
                    heapq.heappush(heap, (ranks[p], i, p))
            if (h := prv[i]) >= 0 and (p := part[h] + pair) in ranks:
                heapq.heappush(heap, (ranks[p], h, p))
        return tuple(ranks[p] for p in part if p is not None)

    def short(self, piece: bytes) -> tuple[int, ...]:
        """``merge``, remembered for the short pieces at leaves and seams."""
        if len(piece) > 2 * LEAF_BYTES:
            return self.merge(piece)
        got = self._short.get(piece)
        if got is None:
            if len(self._short) >= CACHE_ENTRIES:
                self._short.clear()
            got = self._short[piece] = self.merge(piece)
        return got

    def fits(self, x: int, y: int) -> bool:
        """Whether x, y are the encoding of their bytes."""
        known = self._fits.get((x, y))
        if known is None:
            if len(self._fits) >= CACHE_ENTRIES:
                self._fits.clear()
            known = self._fits[x, y] = self.merge(self.tokens[x] + self.tokens[y]) == (x, y)
        return known

    def join(self, a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of a's bytes followed by b's bytes."""
        if not a or not b:
            return a or b
        if self.fits(a[-1], b[0]):
            return a + b
        i = j = 1
        while True:
            w = self.short(b"".join(map(self.tokens.__getitem__, a[-i:] + b[:j])))
            left = i == len(a) or self.fits(a[-i - 1], w[0])
            right = j == len(b) or self.fits(w[-1], b[j])
            if left and right:
                return a[:-i] + w + b[j:]
            i = i if left else min(2 * i, len(a))
            j = j if right else min(2 * j, len(b))

    def encode_bytes(self, piece: bytes) -> tuple[int, ...]:
        """One pre-token by recursive halving."""
        if len(piece) <= LEAF_BYTES:
            return self.short(piece)
        mid = len(piece) // 2
        return self.join(self.encode_bytes(piece[:mid]), self.encode_bytes(piece[mid:]))

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        got = self._pieces.get(piece)
        if got is None:
            got = self.encode_bytes(piece.encode("utf-8"))
            if len(piece) <= 64:  # long ones are rare and would fill the table
                if len(self._pieces) >= CACHE_ENTRIES:
                    self._pieces.clear()
                self._pieces[piece] = got
        return got

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, each match of the pattern separately."""
        return np.fromiter(chain.from_iterable(map(self.encode_piece, self.pattern.findall(text))), np.int32)

    def decode(self, ids) -> bytes:
        """Bytes of ids: leaves by table, then concatenation up the tree."""
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.tokens.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


@lru_cache(maxsize=4)
def load(ranks_path: str, pattern: str) -> Bpe:
    """One encoder per worker process and rank file."""
    return Bpe(ranks_path, pattern)


def encode_documents(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids",
                     decoded: str | None = None) -> DataFrame:
    """``df`` without its text column, with the ids (array<int>) of each whole text; with ``decoded``
    also the bytes that the ids decode to. A map over rows: no shuffle."""
    keep = [f for f in df.schema.fields if f.name not in (text, ids, decoded)]
    out = T.StructType([*keep, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)]
                       + ([T.StructField(decoded, T.BinaryType(), False)] if decoded else []))
    names = [f.name for f in keep]

    def run(batches):
        bpe = load(ranks_path, pattern)
        for batch in batches:
            for rows, data, offs in text_slices(batch, text):
                found = [bpe.encode(t) for t in texts_of(data, offs)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
                flat = np.concatenate(found) if found else np.zeros(0, np.int32)
                cols = [rows.column(rows.schema.get_field_index(n)) for n in names]
                cols.append(list_array(flat, ends, pa.int32()))
                if decoded:
                    cols.append(pa.array([bpe.decode(x.tolist()) for x in found], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[*names, ids, *([decoded] if decoded else [])])

    return small_batches(df).select(*names, text).mapInArrow(run, out)


def decode_documents(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` without its ids column, with the text (binary) they decode to; null ids give nothing."""
    keep = [f for f in df.schema.fields if f.name not in (text, ids)]
    names = [f.name for f in keep]

    def run(batches):
        bpe = load(ranks_path, pattern)
        for batch in batches:
            back = [bpe.decode(x or []) for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(back, pa.binary())], names=[*names, text])

    return small_batches(df).select(*names, ids).mapInArrow(run, T.StructType([*keep, T.StructField(text, T.BinaryType(), False)]))
