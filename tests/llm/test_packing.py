import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bandscope.llm import packing, words as W

PATH = packing.tokenizer_path()
ODD = [
    "", "it's we'll don't 's", "a<|endoftext|>b <|ENDOFTEXT|>. c", "İstanbul Σίσυφος ΌΔΟΣ É. é, ×. ÷, ñ; Ñ!", "a b　c\u0085d", "é. ́x x́",
    "\x00\x01 z", "日本語。テスト 12345 ½ ²", "ﬁ 👩‍👩‍👧 ​x", "!!!??? ...a.b …, a… b,c. d.,", " lead  and trail \n\t", "a" * 3000, "ab, " * 2000, ".", "a.", ". a",
]


LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_chunks_give_the_ids_of_whole_texts():
    texts = ODD + [" ".join(ODD)]
    found, first = packing.ChunkCache(PATH).ids(W.column(pa.array(texts)))
    for k, text in enumerate(texts):
        assert found[first[k] : first[k + 1]].tolist() == ids_of(text), text[:40]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB .,'é×1<|>\n!", max_size=25), min_size=1, max_size=5))
def test_chunks_of_random_text(texts):
    found, first = packing.cache(PATH).ids(W.column(pa.array(texts)))
    assert [found[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [ids_of(t) for t in texts]


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(packing.ChunkCache, "ENTRIES", 8)
    cache = packing.ChunkCache(PATH)
    for k in range(6):
        text = " ".join(f"{c}{c}x" for c in "abcdefgh"[k : k + 3] * 2) + (" many more words than the cache has room for at once" if k == 3 else "")
        assert cache.ids(W.column(pa.array([text])))[0].tolist() == ids_of(text)


def fewest(lengths, capacity):
    """Fewest sequences by search over subsets."""
    n = len(lengths)
    fits = [sum(lengths[i] for i in range(n) if m >> i & 1) <= capacity for m in range(1 << n)]
    best = [0] + [n] * ((1 << n) - 1)
    for m in range(1, 1 << n):
        low, rest = m & -m, m & (m - 1)
        sub = rest
        while True:
            if fits[sub | low]:
                best[m] = min(best[m], best[rest & ~sub] + 1)
            if not sub:
                break
            sub = (sub - 1) & rest
    return best[-1]


@pytest.mark.parametrize("seed", range(40))
def test_reduction_loses_nothing(seed):
    """Sequences fixed by dominance, with the best packing of the rest, are as few as any packing has."""
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 37])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
    runs = packing.Runs(np.bincount(lengths, minlength=capacity + 1))
    packing.reduce_dominated(runs, capacity)
    rest = [x for x in range(capacity + 1) for _ in range(int(runs.left[x]))]
    assert runs.sequences + (fewest(rest, capacity) if rest else 0) == fewest(lengths, capacity)


def test_dominating_sets_against_all_sets():
    """Every set with the piece can be matched into the chosen one, checked on small cases."""
    rng = random.Random(4)
    for _ in range(300):
        capacity = rng.choice([12, 20])
        j, others = rng.randint(1, capacity), [rng.randint(1, capacity) for _ in range(rng.randint(0, 6))]
        found = packing.dominating_set(np.bincount(others, minlength=capacity + 1), j, capacity)
        if found is None:
            continue
        assert sum(found) <= capacity and found[0] == j
        for k in range(len(others) + 1):
            for some in combinations(others, k):
                if some and sum(some) <= capacity - j:
                    # Each piece of the chosen set can stand in for a group of the other set's pieces.
                    assert covers(list(found[1:]), list(some)), (j, others, found, some)


def covers(big, small):
    if not small:
        return True
    first, rest = max(small), sorted(small)[:-1]
    return any(first <= room and covers(big[:k] + [room - first] + big[k + 1 :], rest) for k, room in enumerate(big))


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = 256
    lengths = np.clip(rng.lognormal(3.5 + seed / 3, 1, 5000).astype(int), 1, capacity)
    counts = np.bincount(lengths, minlength=capacity + 1)
    placed, sequences = packing.plan(counts, capacity)
    spans = defaultdict(list)
    seen = np.zeros_like(counts)
    for length, rank, n, first, offset in placed:
        assert rank == seen[length]
        seen[length] += n
        for s in range(first, first + n):
            spans[s].append((offset, length))
    assert (seen == counts).all() and len(spans) == sequences
    for own in spans.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert sequences <= -(-int(lengths.sum()) // capacity) * 1.02 + 1 or seed >= 4


def check_packed(rows, texts, capacity):
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in texts.items():
        ids = np.array([*ids_of(text or ""), 0], "<u4")
        cut = [ids[i : i + capacity] for i in range(0, len(ids), capacity)]
        got = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in pieces[doc])
        assert got == [(k, k * capacity, len(c), zlib.crc32(c)) for k, c in enumerate(cut)]
    return len(places)


def test_documents_round_trip(spark, prose):
    texts = dict(enumerate([*prose, *ODD, None]))
    rows = packing.pack_documents(spark.createDataFrame([(k, t, 1, 2) for k, t in texts.items()], "doc_id long, text string, length int, piece int"), PATH, 512).collect()
    used = check_packed(rows, texts, 512)
    assert used <= -(-sum(r.length for r in rows) // 512) * 1.05 + 1


def test_many_alike_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(i % 50, "same text here") for i in range(600)] + [(None, "x")], "doc_id long, text string")
    rows = packing.pack_documents(docs, PATH, 64, group=10).collect()
    assert len(rows) == 601 and len({(r.sequence_id, r.offset) for r in rows}) == 601
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for own in filled.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 64
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def test_clashing_columns_of_pieces(spark):
    cut = spark.createDataFrame([(k, 0, 0, 5 + k, 1, 7, 8, 9) for k in range(4)], "doc_id long, piece int, start long, length long, ids_crc32 long, _salt int, offset int, _n int")
    got = packing.pack(cut)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "_salt", "_n", "sequence_id", "offset"]
    rows = got.collect()
    assert {(r["_salt"], r["_n"]) for r in rows} == {(7, 9)} and sorted(r["offset"] for r in rows)[0] == 0
    assert len({(r.sequence_id, r["offset"]) for r in rows}) == 4
