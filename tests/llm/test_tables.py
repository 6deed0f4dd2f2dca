"""Fixity, URL filter and token rollup."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tokenizers import Tokenizer

from bandscope.llm import fixity, packing, rollup, urls
from bandscope.session import scratch_path
from bandscope.sources import files
from bandscope.sources.versions import VersionedFolder


# -- fixity

RECORDS = "record_id string, offset long, length long, digest string"


def replica(n, change=None, drop=(), size=100):
    rows = []
    for i in range(n):
        if i not in drop:
            body = f"body {i}" + (change or {}).get(i, "")
            rows.append((str(i), i * size, len(body), hashlib.sha256(body.encode()).hexdigest()))
    return rows


@pytest.mark.parametrize("size, fanout", [(100, 2), (1000, 3), (10**6, 16)])
def test_corruption_is_found_at_any_shape_of_tree(spark, size, fanout):
    ours = replica(500) + [("extra", 77, 1, "x")]
    theirs = replica(500, {3: "!", 250: "?", 499: "."}, drop=(0, 251)) + [("new", 90_000, 4, "y")]
    found = fixity.audit(spark.createDataFrame(ours, RECORDS), spark.createDataFrame(theirs, RECORDS), size, fanout).collect()
    assert {(r.record_id, r.status) for r in found} == {
        ("3", "changed"), ("250", "changed"), ("499", "changed"), ("0", "missing"), ("251", "missing"), ("extra", "missing"), ("new", "surplus"),
    }


def test_equal_empty_and_odd_replicas(spark):
    frame = lambda rows: spark.createDataFrame(rows, RECORDS)
    same = replica(40) + [("40", None, 3, "x")]
    assert fixity.audit(frame(same), frame(list(reversed(same)))).count() == 0
    assert fixity.audit(frame([]), frame([])).count() == 0
    only = fixity.audit(frame(replica(3)), frame([])).collect()
    assert sorted((r.record_id, r.status) for r in only) == [(str(i), "missing") for i in range(3)]
    nulls = [(None, 0, None, None), ("a", 9, 1, None)]
    assert fixity.audit(frame(nulls), frame(nulls)).count() == 0
    changed = fixity.audit(frame(nulls), frame([(None, 0, 5, None), ("a", 9, 1, None)])).collect()
    assert [(r.offset, r.status) for r in changed] == [(0, "changed")]


def test_ids_and_nulls_are_in_the_hashes(spark):
    """Replicas that differ in one record's id alone, or in which of two fields is null."""
    frame = lambda rows: spark.createDataFrame(rows, RECORDS)
    ours = replica(40)
    theirs = [("x" if r[0] == "7" else r[0], *r[1:]) for r in ours]
    found = fixity.audit(frame(ours), frame(theirs), 1000, 4).collect()
    assert sorted((r.record_id, r.status) for r in found) == [("7", "missing"), ("x", "surplus")]
    a, b = [("r", 0, None, "5")], [("r", 0, 5, None)]
    assert [(r.record_id, r.status) for r in fixity.audit(frame(a), frame(b)).collect()] == [("r", "changed")]
    a, b = [("r:1", 0, 2, "x")], [("r", 0, 1, "2:x")]
    assert fixity.audit(frame(a), frame(b)).count() == 2


def test_only_differing_branches_are_descended(spark):
    a, b = (spark.createDataFrame(replica(n, c), RECORDS) for n, c in ((256, None), (256, {5: "!"})))
    one, two = fixity.tree(a, 3, 100, 16), fixity.tree(b, 3, 100, 16)
    bad = None
    for level in (2, 1, 0):
        bad = fixity.differing(one[level], two[level], bad, 16)
        assert [r.node for r in bad.collect()] == [5 // 16**level]


def test_records_are_laid_out_without_gaps(spark):
    rows = [(i, (i * 7) % 13 + 1) for i in range(1000)] + [(None, 5), (3, 4)]
    laid = fixity.laid_out(spark.createDataFrame(rows, "page_id long, length long").repartition(7), ("page_id", "length"), 90).collect()
    at = 0
    for r in sorted(laid, key=lambda r: r.offset):
        assert r.offset == at
        at += r.length
    ids = [r.page_id for r in sorted(laid, key=lambda r: r.offset)]
    assert ids == [None, *sorted([*range(1000), 3])]
    record = spark.createDataFrame([(None, None), ("u", "é")], "u string, h string").select(fixity.warc_record(F.col("u"), F.col("h")).alias("r")).collect()
    assert record[0].r.endswith("Content-Length: 0\r\n\r\n\r\n\r\n") and "Content-Length: 2\r\n\r\né\r\n\r\n" in record[1].r


# -- URLs


def test_rules_and_odd_urls(spark):
    cases = {
        "http://a.net/x": ("a.net", "/x", "net/", "block"),
        "http://net/x": ("net", "/x", "net/", "block"),
        "http://planet/x": ("planet", "/x", None, "allow"),
        "http://A.Example.NET/en/1?q": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "http://myexample.net/en/1": ("myexample.net", "/en/1", "net/", "block"),
        "https://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
        "https://example.com/DE/": ("example.com", "/DE/", None, "allow"),
        "ftp://x.org/fr/a#b": ("x.org", "/fr/a", "org/fr/", "allow"),
        "http://a.net": ("a.net", "", None, "allow"),
        "http://a.net?x=/": ("a.net", "", None, "allow"),
        "a.net/x": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "x://": ("", "", None, "allow"),
        "http://b.net/p://c.org/fr/": ("b.net", "/p://c.org/fr/", "net/", "block"),
        None: ("", "", None, "allow"),
    }
    frame = spark.createDataFrame([(u, 1, "old", "old") for u in cases], "url string, page_id int, host string, rule string")
    none = spark.createDataFrame([], "key string")
    got = urls.judge_urls(frame, none)
    assert {r.url: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == cases
    assert urls.judge_urls(frame.limit(0), none).count() == 0


def test_canonical_urls(spark):
    same = ["http://www.A.com/x/", "https://a.com/x?utm_source=f#top", "http://a.com/x/index.html", "http://a.com/x?ref=1&utm_id=2"]
    other = ["http://a.com/X", "http://a.com/x?id=2", "http://b.com/x"]
    rows = spark.createDataFrame([(u,) for u in [*same, *other, "nothing", None]], "u string").select(urls.canonical(F.col("u")).alias("c")).collect()
    found = [r.c for r in rows]
    assert set(found[:4]) == {"a.com/x"} and len(set(found[4:7])) == 3 and found[7:] == [None, None]


def test_list_has_no_false_answer(spark, monkeypatch):
    """Even where the filter lets nearly everything pass."""
    listed = spark.range(0, 3000, 2).selectExpr("concat('u', id) as key").unionByName(spark.createDataFrame([(None,), ("u4",)], "key string"))
    rows = spark.range(3000).selectExpr("concat('u', id) as k", "id as block", "1 as listed").unionByName(spark.createDataFrame([(None, 0, 1)], "k string, block long, listed int"))
    for bits in (16, 1):
        monkeypatch.setattr(urls, "BITS_PER_URL", bits)
        got = urls.in_list(rows.drop("listed"), "k", listed).collect()
        assert len(got) == 3001
        assert all(r.listed == (r.k is not None and int(r.k[1:]) % 2 == 0) for r in got)


def test_filter_passes_all_listed_and_few_others(spark):
    keys = spark.range(4000).selectExpr("concat('u', id) as key")
    blocks = 4000 * urls.BITS_PER_URL // urls.BLOCK
    table = urls.bloom(keys, blocks)
    probe = spark.range(8000).selectExpr("concat('u', id) as key", "id")
    wanted = {f"m{i}": m for i, m in enumerate(urls.masks(F.col("key")))}
    hit = F.lit(True)
    for i in range(4):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    rows = probe.withColumns(wanted).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))).join(table, "block", "left")
    passed = {r.id for r in rows.filter(hit).select("id").collect()}
    assert set(range(4000)) <= passed and len(passed) < 4000 + 100


def test_clashing_columns_come_back(spark):
    names = ["canon", "on_list", "_canon", "_on_list", "hit", "block", "probe"]
    rows = spark.createDataFrame([(1, "http://a.org/x", *range(7)), (2, None, *range(7))], ["page_id", "url", *names])
    listed = spark.createDataFrame([("a.org/x",)], "key string")
    got = urls.judge_urls(rows, listed).orderBy("page_id")
    assert got.columns == ["page_id", "url", *names, "host", "path", "rule", "verdict"]
    assert [tuple(r)[2:9] + (r.verdict,) for r in got.collect()] == [(*range(7), "block"), (*range(7), "allow")]


def test_large_filters_are_broadcast_in_parts(spark):
    listed = spark.range(3000).select(F.concat(F.lit("h/"), "id").alias("key"))
    rows = spark.range(2000, 5000).select(F.concat(F.lit("h/"), "id").alias("k"), F.lit("x").alias("hit"), "id")
    rows = rows.unionByName(rows.filter("id = 2000")).unionByName(rows.limit(3).withColumn("k", F.lit(None).cast("string")))
    got = urls.in_list(rows, "k", listed, limit=2500).collect()
    assert len(got) == 3004 and {r.hit for r in got} == {"x"}
    assert all(r.listed == (r.k is not None and int(r.k[2:]) < 3000) for r in got)


def test_only_possible_hits_meet_the_list(spark, conf):
    """With no broadcast of the list, the rows that the filter stops are in no shuffle."""
    listed = spark.range(300).select(F.concat(F.lit("h/"), "id").alias("key"))
    rows = spark.range(100_000).select(F.concat(F.lit("h/"), "id").alias("k"))
    found = urls.in_list(rows, "k", listed, limit=3200)
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    found.write.format("noop").mode("overwrite").save()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") >= 2 and "Union" in plan
    shuffled = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    # One for the possible hits, one for the list (its two names).
    assert len(shuffled) <= 2
    assert found.filter("listed").count() == 300


# -- rollup

ROWS = "doc_id long, source string, lang string, tokenizer string, n_tokens long"


def test_commits_add_up_and_count_once(spark):
    state = scratch_path(spark, "rollup")
    assert rollup.totals(spark, state).count() == 0
    rows = spark.createDataFrame([(1, "a", "en", "t", 5), (2, "a", "en", "t", 7), (3, None, "en", "t", None), (3, None, "en", "t", 2)], ROWS)
    assert rollup.commit(state, "one", rollup.inserts(rows)) and not rollup.commit(state, "one", rollup.inserts(rows))
    change = rollup.deletes(rows.filter("doc_id = 1")).unionByName(rollup.revisions(rows.filter("doc_id = 2"), F.lit(10)))
    assert rollup.commit(state, "two", change) and not rollup.commit(state, "two", change)
    assert rollup.commit(state, "empty", rollup.inserts(rows.limit(0)))
    got = {(r.source, r.n_docs, r.n_tokens) for r in rollup.totals(spark, state).collect()}
    assert got == {("a", 1, 10), (None, 2, 2)}
    rollup.commit(state, "three", rollup.deletes(rows.filter("doc_id = 3")))
    assert [r.source for r in rollup.totals(spark, state).collect()] == ["a"]


def test_a_failed_batch_leaves_nothing(spark):
    state = scratch_path(spark, "rollup")
    bad = spark.createDataFrame([("update", "a", "en", "t", 1, 0)], rollup.CHANGES)
    with pytest.raises(Exception, match="unknown op update"):
        rollup.commit(state, "one", bad)
    assert rollup.totals(spark, state).count() == 0
    assert rollup.commit(state, "one", bad.withColumn("op", F.lit("insert")))
    assert rollup.totals(spark, state).first().n_tokens == 1


def test_counts_by_version(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "en"), (2, None, None, None)], "doc_id long, text string, source string, lang string")
    ways = {"v1": F.size(F.split("text", " ")), "v2": F.length("text")}
    got = {(r.doc_id, r.tokenizer, r.n_tokens) for r in rollup.counted(docs, ways).collect()}
    assert {g for g in got if g[0] == 1} == {(1, "v1", 2), (1, "v2", 3)} and (2, "v2", 0) in got


def test_counts_by_tokenizers(spark):
    texts = ["One text, of words.", None, "", "naïve  <|endoftext|> \n x", "One text, of words."]
    docs = spark.createDataFrame([(i % 4, t, "s", None, 1) for i, t in enumerate(texts)], "doc_id int, text string, source string, lang string, tokenizer int")
    path = packing.tokenizer_path()
    library = Tokenizer.from_file(path)
    got = rollup.counted_by(docs, {"v1": path, "v2": path})
    want = [(i % 4, "s", None, v, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts) for v in ("v1", "v2")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert rollup.counted_by(docs.limit(0), {"v1": path}).count() == 0


def test_a_rename_that_fails_is_told_and_loses_nothing(spark, monkeypatch):
    state = scratch_path(spark, "rollup")
    rows = rollup.inserts(spark.createDataFrame([(1, "a", "en", "t", 5)], ROWS))
    rollup.commit(state, "one", rows)

    def fail(*_):
        raise OSError("injected")

    monkeypatch.setattr(files, "move", fail)
    with pytest.raises(OSError, match="injected"):
        rollup.commit(state, "two", rows)
    monkeypatch.undo()
    assert rollup.totals(spark, state).first().n_tokens == 5
    assert rollup.commit(state, "two", rows) and rollup.totals(spark, state).first().n_tokens == 10


def test_reads_stay_bounded_over_many_commits(spark):
    state = scratch_path(spark, "rollup")
    rows = spark.createDataFrame([(1, "a", "en", "t", 5), (2, None, None, "t", 1)], ROWS)
    for k in range(11):
        assert rollup.commit(state, f"b{k}", rollup.inserts(rows), folders=3)
        assert len(VersionedFolder(spark, state).version().data) <= 3
    assert not rollup.commit(state, "b0", rollup.inserts(rows), folders=3)
    assert {(r.source, r.n_docs, r.n_tokens) for r in rollup.totals(spark, state).collect()} == {("a", 11, 55), (None, 11, 11)}
    assert {(r.source, r.n_tokens) for r in rollup.totals(spark, state, version=4).collect()} == {("a", 20), (None, 4)}
