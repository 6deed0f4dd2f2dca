import hashlib
import re

import pytest

from bandscope.llm import fim, queries

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain_version(doc_id, text):
    """n, form, code points of prefix and middle, output."""
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


ROWS = [
    *((k, f"Doc {k}: naïve\n<P and 中文 {'word ' * (k % 9)}<") for k in range(60)),
    *((100 + k, f"holds <{m}> itself") for k, m in enumerate("PSM")),
    (200, None),
    (201, ""),
    (202, "x"),
    (203, "a" * 300_000 + " " + "é" * 100_000),
    (204, "1 2 " * 40_000),
    (7, "Doc 7 twice"),
    (7, "Doc 7 twice"),
    (None, "no id"),
    (None, None),
]


@pytest.mark.parametrize("task_bytes", [1 << 26, 1 << 17])
def test_digests(spark, task_bytes):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    got = fim.digests(fim.pieces(docs, task_bytes=task_bytes)).collect()
    want = []
    for doc_id, text in ROWS:
        *facts, output = plain_version(doc_id, text)
        want.append((doc_id, *facts, sha(output), sha(text or "")))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_texts_and_back(spark):
    docs = spark.createDataFrame([(*r, 1, 2) for r in ROWS], "doc_id long, text string, h int, at int")
    out = fim.transform(docs)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "text"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(str((i, *plain_version(i, t))) for i, t in ROWS)
    assert sorted(map(str, map(tuple, fim.restored(out).collect()))) == sorted(str((i, t or "")) for i, t in ROWS)


def test_rates_and_other_ids(spark):
    docs = spark.createDataFrame([(f"id{k}", "some words here") for k in range(50)], "doc_id string, text string")
    forms = lambda **o: {r.form for r in fim.transform(docs, **o).collect()}
    assert forms(reordered=0) == {"plain"}
    assert forms(reordered=100, suffix_first=100) == {"spm"}
    assert forms(reordered=100, suffix_first=0) == {"psm"}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.digests(fim.pieces(docs)).collect() == [] and fim.transform(docs).collect() == []


def test_pieces_are_small_and_one_shuffle_moves_them(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    cut = fim.pieces(docs, task_bytes=1 << 17)
    assert max(len(r.piece or b"") for r in cut.collect()) <= fim.PIECE_BYTES
    plan = fim.digests(cut)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 2


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op13_fill_in_middle"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        *facts, output = plain_version(r.doc_id, texts[r.doc_id])
        assert tuple(r) == (r.doc_id, *facts, sha(output), sha(texts[r.doc_id] or ""))
