"""Token counts by rank-synchronous array merging.

The new pre-tokens of a batch lie as symbol ids in one ragged numpy array. In
every round each sequence finds its lowest-ranked adjacent pair and all sequences
apply theirs at once (all non-overlapping occurrences, left to right); a sequence
without a known pair is done and its surviving symbols are its token count.

Defined results: a null or empty text has 0 bytes and 0 tokens; a special string
inside a text is one token, as the tokenizer file's library counts it; repeated
rows are counted again; an empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skein.llm.batches import small_batches, text_slices, texts_of

CACHE_ENTRIES = 600_000  # bound of the memo table in a worker
LONG_PIECE = 64  # longer pre-tokens are not remembered
_NONE = np.iinfo(np.int64).max

# Letters and numbers of Unicode versions after 16.0, which the tokenizer
# library's tables do not know (first, last code point); the regex module knows them.
NEWER_THAN_UNICODE_16 = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
# Fixed value: the byte-level pre-tokenizer's pattern.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _patterns() -> tuple[regex.Pattern, regex.Pattern]:
    """(for texts of code points below 256, for all texts)."""
    newer = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in NEWER_THAN_UNICODE_16)
    plain = PRE_TOKEN.replace("{L}", r"\p{L}").replace("{N}", r"\p{N}")
    full = (PRE_TOKEN.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]")
            .replace("{L}", rf"[\p{{L}}--[{newer}]]").replace("{N}", rf"[\p{{N}}--[{newer}]]"))
    return regex.compile(plain), regex.compile(full, regex.V1)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others for code points from 256 on, in byte order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return [chr(b if b in set(own) else 256 + rest.index(b)) for b in range(256)]


class PieceCounter:
    """Counts symbols of byte-level pre-tokens by the merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.size = max(vocab.values()) + 1
        self.symbols = np.array([vocab[c] for c in byte_symbols()], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.latin, self.full = _patterns()
        self._known: dict[str, int] = {}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Index of each pair in the sorted merge table, or -1."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    def count(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Surviving symbols of each byte sequence of the ragged array."""
        out = lengths.astype(np.int64).copy()
        seq = np.repeat(np.arange(len(lengths)), lengths)
        ids = self.symbols[data]
        pair = np.full(len(ids), -1, np.int64)  # merge that position i and i + 1 allow
        if len(ids) > 1:
            pair[:-1] = np.where(seq[:-1] == seq[1:], self.rank(ids[:-1], ids[1:]), -1)
        while len(ids):
            rank = np.where(pair >= 0, self.ranks[pair], _NONE)
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            low = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(ids)])
            low_at = np.repeat(low, sizes)
            live = low_at != _NONE
            if not live.all():  # finished sequences leave
                done = low == _NONE
                out[seq[starts[done]]] = sizes[done]
                ids, seq, pair, rank, low_at = ids[live], seq[live], pair[live], rank[live], low_at[live]
                if not len(ids):
                    break
            hit = rank == low_at
            # of overlapping occurrences (a a a) every second one counts, from the left
            at = np.flatnonzero(hit)
            first = np.r_[True, np.diff(at) > 1]
            run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            ids[at] = self.made[pair[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            to = np.cumsum(keep) - 1
            ids, seq, pair = ids[keep], seq[keep], pair[keep]
            changed = to[at]
            changed = np.unique(np.concatenate([changed, changed[changed > 0] - 1]))
            pair[changed] = -1
            inner = changed[changed < len(ids) - 1]
            inner = inner[seq[inner] == seq[inner + 1]]
            pair[inner] = self.rank(ids[inner], ids[inner + 1])
        return out

    def split(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, special tokens) of a text."""
        try:
            text.encode("latin-1")
            pattern = self.latin
        except UnicodeEncodeError:
            pattern = self.full
        if self.special is None or not self.special.search(text):
            return pattern.findall(text), 0
        parts = self.special.split(text)
        return [p for part in parts for p in pattern.findall(part)], len(parts) - 1

    def count_texts(self, texts: list[str]) -> list[int]:
        split = [self.split(t) for t in texts]
        known = self._known
        if len(known) >= CACHE_ENTRIES:
            known.clear()
        new = list({p for pieces, _ in split for p in set(pieces) if p not in known})
        raw = [p.encode("utf-8") for p in new]
        counts = self.count(np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw], np.int64)) if new else []
        fresh = dict(zip(new, (int(c) for c in counts)))
        known.update(fresh)
        out = [sum(map(known.__getitem__, pieces)) + special for pieces, special in split]
        for p in new:
            if len(p) > LONG_PIECE:
                del known[p]
        return out


@lru_cache(maxsize=4)
def load(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(df: DataFrame, tokenizer_path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` without its text column, with n_bytes (UTF-8) and the token count of each whole
    text. A map over rows: no shuffle."""
    keep = [f for f in df.schema.fields if f.name not in (text, out, "n_bytes")]
    names = [f.name for f in keep]
    schema = T.StructType([*keep, T.StructField("n_bytes", T.LongType(), False), T.StructField(out, T.LongType(), False)])

    def run(batches):
        counter = load(tokenizer_path)
        for batch in batches:
            for rows, data, offs in text_slices(batch, text):
                n = counter.count_texts(texts_of(data, offs))
                cols = [rows.column(rows.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(np.diff(offs), pa.int64()), pa.array(n, pa.int64())], names=[*names, "n_bytes", out])

    return small_batches(df).select(*names, text).mapInArrow(run, schema)
