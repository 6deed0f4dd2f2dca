import hashlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import words_of

from bandscope.llm import decontam, words as W


def brute(docs, items, window):
    """n_words, hit positions, item ids and the longest match with each, for each document."""
    out = []
    for _, text in docs:
        words, hit, best = words_of(text), set(), {}
        for name, item in items:
            own = words_of(item)
            n = min(window, len(own))
            for j in range(len(own) - n + 1) if n else ():
                for i in range(len(words) - n + 1):
                    if words[i : i + n] == own[j : j + n]:
                        size = n
                        while i + size < len(words) and j + size < len(own) and words[i + size] == own[j + size]:
                            size += 1
                        hit.update(range(i, i + n))
                        key = name or ""
                        best[key] = max(best.get(key, 0), size)
        out.append((len(words), hit, best))
    return out


def run(spark, docs, items, window, **how):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id string, text string")
    return decontam.find_matches(frame, tests, window, **how)


@pytest.mark.parametrize("window, block", [(1, 8 << 20), (3, 8 << 20), (10, 8 << 20), (10, 40)])
def test_matches_agree_with_brute_force(spark, rng, window, block):
    vocabulary = [f"w{i}" for i in range(5)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 80)))) for i in range(25)]
    items = [(f"i{k}", " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 14)))) for k in range(6)]
    items += [("long", " ".join(docs[3][1].split()[2:40]) + " tail"), ("upper", " ".join(docs[4][1].split()[:12]).upper())]
    found = {r.doc_id: r for r in run(spark, docs, items, window, block=block).collect()}
    for (doc, _), (n, hit, best) in zip(docs, brute(docs, items, window)):
        r = found[doc]
        assert r.n_words == n
        assert {p for h in r.hits for p in range(h.start, h.end)} == hit
        assert {m.item_id: m.n_words for m in r.matches} == best
        for m in r.matches:
            item = words_of(dict(items)[m.item_id])
            assert words_of(docs[doc][1])[m.doc_word : m.doc_word + m.n_words] == item[m.item_word : m.item_word + m.n_words]


def test_one_block_of_items_at_a_time(spark, monkeypatch):
    passages = [" ".join(f"p{k}w{i}" for i in range(10)) for k in range(3)]
    docs = [(k, f"x {p} y") for k, p in enumerate(passages)] + [(9, " ".join(passages))]
    items = [(f"i{k}", p) for k, p in enumerate(passages)]
    events, blocks, write = [], decontam.blocks, decontam.scratch_path

    def read(*args):
        for rows in blocks(*args):
            events.append(rows[0][0])
            yield rows

    monkeypatch.setattr(decontam, "blocks", read)
    monkeypatch.setattr(decontam, "scratch_path", lambda *a: events.append("write") or write(*a))
    found = run(spark, docs, items, 10, block=1)
    assert events == ["i0", "i1", "write", "i2", "write"]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: [m.item_id for m in r.matches] for r in found.collect()} == {0: ["i0"], 1: ["i1"], 2: ["i2"], 9: ["i0", "i1", "i2"]}


def test_digest_and_removal(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = [(1, f"x {passage.upper()}, y"), (2, "one two three four five six seven eight nine"), (3, None), (4, ""), (4, f"{passage} {passage}")]
    items = [("7", passage), ("12", passage + " eleven"), ("s", "y"), ("e", ""), ("n", None), (None, "zzz"), ("7", passage)]
    rows = {(r.doc_id, r.n_words): r for r in decontam.digest(run(spark, docs, items, 10)).collect()}
    a = rows[1, 12]
    assert (a.n_hit, a.n_items, a.contaminated) == (11, 3, True)
    assert a.items_sha256 == hashlib.sha256(b"12,7,s").hexdigest()
    assert (rows[2, 9].n_hit, rows[2, 9].contaminated, rows[2, 9].items_sha256) == (0, False, hashlib.sha256(b"").hexdigest())
    assert rows[3, 0].n_items == 0 and rows[4, 0].n_hit == 0 and rows[4, 20].n_hit == 20
    frame = spark.createDataFrame([(d, t, 5, "h") for d, t in docs], "doc_id long, text string, n_words int, hits string")
    tests = spark.createDataFrame(items, "item_id string, text string")
    kept = decontam.decontaminate(frame, tests)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert {r.hits for r in kept.collect()} == {"h"}


def test_empty_tables(spark):
    docs, items = [(1, "a b c")], [("1", "a")]
    assert run(spark, [], items, 10).count() == 0
    only = run(spark, docs, [], 10).first()
    assert only.hits == [] and only.matches == []


def test_suffixes_are_in_order(rng):
    ids = [rng.randrange(3) for _ in range(300)]
    order = decontam.suffix_array(np.array(ids), 3, 10)
    cut = [tuple(ids[i : i + 10]) for i in order]
    assert cut == sorted(cut) and sorted(order.tolist()) == list(range(300))


def test_matches_do_not_cross_documents():
    items = decontam.prepare([("1", "a b c")], 3)
    _, _, hashes, first = W.words(W.column(pa.array(["x a", "b c", "a b", "c a b c"])))
    q, place, length = decontam.shard_matches(hashes, first, items, 3)
    assert place.tolist() == [7] and length.tolist() == [3]
