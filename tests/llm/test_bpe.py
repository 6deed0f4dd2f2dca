import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bandscope.llm import bpe, queries
from bandscope.llm.packing import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(PATH)
# U+0558, U+088F: letters since lately; U+001C, U+0085: white space for some only.
ODD = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "中", "😀", "1", "22", "'s", "'ll", "!", "<|endoftext|>", "՘", "࢏",
       "the", " the", "aaaaaaaa", "    ", "=====", "\x00", "\x1c", "\x85", "　", "́", "٣"]


def ids(text):
    return np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist()


def plain_merges(v, piece):
    """Merge the earliest pair, the leftmost of equal ones, until none is left."""
    rank = {(int(a), int(b)): k for k, (a, b) in enumerate(zip(v.left, v.right)) if k >= 256}
    tokens = list(piece)
    while True:
        best = min(((rank.get(pair, 1 << 40), k) for k, pair in enumerate(zip(tokens, tokens[1:]))), default=(1 << 40, 0))
        if best[0] == 1 << 40:
            return tokens
        tokens[best[1] : best[1] + 2] = [best[0]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=25).map("".join))
def test_odd_texts_as_the_library(text):
    assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids
    assert ENCODER.decode(ENCODER.encode([text])[0]) == text


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library(text):
    assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=40))
def test_any_bytes_as_plain_merges(piece):
    v = ENCODER.vocabulary
    assert np.frombuffer(v.encode([piece])[0], "<u4").tolist() == v.ids[plain_merges(v, piece)].tolist()


def test_many_pretokens_side_by_side_and_the_last_few():
    rng = random.Random(5)
    pieces = [bytes(rng.choice(b"abcet ") for _ in range(rng.randint(1, 30))) for _ in range(300)]
    together = ENCODER.vocabulary.encode(pieces)
    assert together == [ENCODER.vocabulary.encode([p])[0] for p in pieces]


def test_every_token_encodes_to_itself():
    v = ENCODER.vocabulary
    assert [len(x) for x in v.encode(v.tokens)] == [4] * len(v.tokens)


@pytest.mark.parametrize("text", ["a" * 30000, "ab" * 20000, " " * 5000, "=-" * 4000, "xyzq" * 9000, "é　" * 500])
def test_long_pretokens(text):
    assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 500)
    own = bpe.Encoder(PATH)
    texts = [f"word{k} and <|endoftext|> others" for k in range(20)]
    for text in texts:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert len(own.known) < 20


def test_broken_utf8_and_unknown_ids():
    half = ENCODER.vocabulary.encode(["é".encode()[:1]])[0]
    assert ENCODER.decode(half) == "�"
    assert ENCODER.decode(np.array([4_000_000_000], "<u4").tobytes()) == ""


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(tokenizer_path("word_bpe_49k.json"))


def test_table(spark):
    rows = [(1, "one two", "x"), (None, None, "y"), (1, "one two", "x"), (2, "", None), (3, "naïve\n\n text <|endoftext|>!", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode(docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids"]
    want = [(i, LIBRARY.encode(t or "", add_special_tokens=False).ids) for i, t, _ in rows]
    assert sorted((str(r.doc_id), r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in got.collect()) == sorted(
        (str(i), len(t), t) for i, t in want
    )
    assert sorted(str(tuple(r)) for r in bpe.decode(got, PATH).collect()) == sorted(str((i, t or "")) for i, t, _ in rows)
    assert bpe.encode(docs.limit(0), PATH).collect() == [] and bpe.decode(got.limit(0), PATH).collect() == []
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), PATH).first().text is None


def test_query_as_the_library(spark, sf):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op12_bpe_round_trip"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        want = LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids
        text = LIBRARY.decode(want, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
