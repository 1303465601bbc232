"""Ops 2 and 4 against the tokenizer libraries, character by character where it matters."""

import base64
import hashlib
import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import public_tokenizers as P
from skein.llm import bpe, token_counts
from skein.llm.queries import QUERIES

RANKS = P.path("byte_bpe_50k.tiktoken")
COUNTS = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def mine():
    return bpe.load(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(COUNTS)


def hard_texts():
    rng = random.Random(4)
    texts = ["", " ", "a" * 5000, "ab" * 999, " " * 700 + "x", "the" * 300, "中文" * 200, "it's we'll I'D 3rd", "é́ \x85\x1c\u2003x\u00a0", "<|endoftext|>",
             "a<|endoftext|><|endoftext|> b <|endoftext", "\U0001f600" * 50, "=" * 3001, "0123456789" * 40]
    texts += ["".join(rng.choice("ab") for _ in range(n)) for n in (1, 2, 7, 50, 400, 3000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x250), rng.randrange(0xD800), 0x20])) for _ in range(150)) for _ in range(150)]
    return texts


def test_encoder_equals_library(mine, library):
    for t in hard_texts():
        ids = mine.encode(t).tolist()
        assert ids == library.encode_ordinary(t)
        assert mine.decode(ids) == t.encode()


def test_every_token_encodes_to_itself(mine):
    """The premise of the seam proof: a token's bytes merge into that token."""
    def by_merging(piece):
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            low = min(range(len(parts) - 1), key=lambda i: mine.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[low] + parts[low + 1] not in mine.ranks:
                break
            parts[low:low + 2] = [parts[low] + parts[low + 1]]
        return parts

    for token in random.Random(1).sample(sorted(mine.ranks), 5000):
        assert by_merging(token) == [token]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80), st.text(max_size=80))
def test_join_is_encoding_of_the_whole(a, b):
    m = bpe.load(RANKS, P.PATTERN)
    assert m.join(m.encode_bytes(a.encode()), m.encode_bytes(b.encode())) == m.merge((a + b).encode())


def test_seam_grows_as_far_as_needed(mine):
    for n in range(1, 200, 7):
        for piece in (b"a" * n, b"ab" * n, b" the" * n, b"zzzy" * n):
            assert mine.encode_bytes(piece) == mine.merge(piece)


def test_counts_equal_library(tokenizer):
    texts = hard_texts() + ["\u0558a \u0c5c1 \U0003d000 x", "꟎ꟁ 𐵀"]
    want = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.load(COUNTS).count_texts(texts) == want


def test_classes_of_all_code_points(tokenizer):
    """Every code point is split as by the library, next to letters, digits, signs and spaces."""
    counter = token_counts.load(COUNTS)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000 or (0x3400 <= c < 0xA000 and c % 16) or (0xAC00 <= c < 0xD700 and c % 16) or (0x20000 <= c < 0x2A000 and c % 64) or (
                0xE0200 <= c and c % 256):
            continue
        t = f"a{chr(c)}a 1{chr(c)}1 .{chr(c)}.  {chr(c)}"
        got = [p for p in counter.split(t)[0]]
        assert got == [t[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(t)], hex(c)


def test_rows_and_columns(spark):
    rows = [(1, "one two", "k"), (1, "one two", "k"), (None, None, None), (3, "", "z"), (4, "x" * 100_000, "long")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string").repartition(3)
    got = bpe.encode_documents(df, RANKS, P.PATTERN, decoded="decoded")
    assert got.columns == ["doc_id", "n_bytes", "ids", "decoded"]
    for r in got.collect():
        text = next(t or "" for i, t, _ in rows if i == r.doc_id)
        assert bytes(r.decoded) == text.encode() and (len(r.ids) > 0) == bool(text)
    back = bpe.decode_documents(got.select("doc_id", "ids"), RANKS, P.PATTERN).collect()
    assert sorted(len(r.text) for r in back) == [0, 0, 7, 7, 100_000]
    counted = token_counts.count_tokens(df, COUNTS).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in counted)[:4] == [(0, 0), (0, 0), (7, 2), (7, 2)]
    assert token_counts.count_tokens(df.limit(0), COUNTS).count() == 0 == bpe.encode_documents(df.limit(0), RANKS, P.PATTERN).count()


def test_queries_on_whole_table(spark, sf_dir, library, tokenizer):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op2_bpe"](spark, sf_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode_ordinary(rows[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest()
    for r in QUERIES["op4_token_counts"](spark, sf_dir).collect():
        t = rows[r.doc_id]
        n = len(tokenizer.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 1024)
