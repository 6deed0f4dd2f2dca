import pytest
from pyspark.sql import functions as F

from bandscope.operators import cohort, keys, ledger
from bandscope.plans import orders
from bandscope.session import scratch_path
from bandscope.sources import files
from bandscope.sources.versions import Conflict, VersionedFolder
from bandscope.spec import BandSpec, mean, rate

BANDS = BandSpec({"High": ("A",), "Low": ("F",)}, default="Low")
FACTORS = [mean("score", "score"), rate("tall", "size > 10")]
SCHEMA = "band string, score double, size int"
ROWS = [("High", 1.1, 5), ("High", None, 50), ("Low", 0.3, None), ("Low", 2.25, 11), (None, 4.0, 12)]


def marts(spark, *parts):
    return [spark.createDataFrame(p, SCHEMA) for p in parts]


def report(spark, root, **options):
    return [tuple(r) for r in ledger.scorecard_from_state(ledger.scorecard_state(spark, root, **options), FACTORS, BANDS).collect()]


def full(mart):
    return [tuple(r) for r in cohort.factor_scorecard(mart, FACTORS, BANDS).collect()]


def test_batches_add_up_to_the_whole(spark):
    root = scratch_path(spark, "state")
    for n, part in enumerate(marts(spark, ROWS[:2], ROWS[2:4], ROWS[4:])):
        assert ledger.commit_batch(root, f"b{n}", ledger.partial_scorecard(part, FACTORS))
    assert report(spark, root) == full(*marts(spark, ROWS))
    assert report(spark, root, version=1) == full(*marts(spark, ROWS[:2]))


def test_a_batch_counts_once(spark):
    root = scratch_path(spark, "state")
    (part,) = (ledger.partial_scorecard(m, FACTORS) for m in marts(spark, ROWS))
    assert [ledger.commit_batch(root, "same", part) for _ in range(3)] == [True, False, False]
    assert report(spark, root) == full(*marts(spark, ROWS))


def test_revisions_take_back_exactly(spark):
    """0.1 and its like do not add up in doubles; decimals do."""
    root = scratch_path(spark, "state")
    many = [("High", 0.1 * k, k) for k in range(1, 40)]
    (mart,) = marts(spark, many)
    ledger.commit_batch(root, "load", ledger.partial_scorecard(mart, FACTORS))
    ledger.commit_batch(root, "undo", ledger.partial_scorecard(mart, FACTORS, F.lit(-1)))
    assert ledger.scorecard_state(spark, root).collect() == [] and report(spark, root) == []
    moved = mart.withColumn("band", F.lit("Low"))
    ledger.commit_batch(root, "moved", ledger.partial_scorecard(moved, FACTORS))
    assert report(spark, root) == full(moved)


def test_state_stays_small(spark):
    root = scratch_path(spark, "state")
    folder = VersionedFolder(spark, root)
    parts = [ledger.partial_scorecard(m, FACTORS) for m in marts(spark, ROWS)]
    for n in range(9):
        ledger.commit_batch(root, f"b{n}", parts[0], folders=3)
        assert len(folder.version().data) <= 3
    assert report(spark, root) == full(*marts(spark, ROWS * 9))
    folder.vacuum(keep=1)
    assert len([n for n in files.listing(spark, root) if n.startswith("data-")]) <= 3
    assert report(spark, root) == full(*marts(spark, ROWS * 9))


def test_the_report_reads_no_fact(spark, sf_small):
    root = scratch_path(spark, "state")
    ledger.commit_batch(root, "all", ledger.partial_scorecard(orders.order_mart(spark, sf_small), orders.FACTORS))
    card = ledger.scorecard_from_state(ledger.scorecard_state(spark, root), orders.FACTORS, orders.BANDS)
    scanned = card.inputFiles()
    assert scanned and all(root in f for f in scanned)
    plan = card._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan and "Join" not in plan


def test_two_writers(spark, monkeypatch):
    """The second one fails, changes nothing, and can be made again."""
    root = scratch_path(spark, "state")
    (part,) = (ledger.partial_scorecard(m, FACTORS) for m in marts(spark, ROWS))
    ledger.commit_batch(root, "a", part)
    real = VersionedFolder.write

    def slow(self, df, arrange=None):
        monkeypatch.undo()
        ledger.commit_batch(root, "b", part)
        return real(self, df, arrange)

    monkeypatch.setattr(VersionedFolder, "write", slow)
    with pytest.raises(Conflict):
        ledger.commit_batch(root, "c", part)
    assert report(spark, root) == full(*marts(spark, ROWS * 2))
    assert ledger.commit_batch(root, "c", part)
    assert report(spark, root) == full(*marts(spark, ROWS * 3))


def grow(spark, root, batch, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = ledger.grow_category_dim(root, batch, df, "c", "name", "id", **options)
    assert got.dtypes == [("name", "string"), ("id", "bigint")]
    return {r.name: r.id for r in got.collect()}


def test_ids_never_move(spark):
    root = scratch_path(spark, "ids")
    assert grow(spark, root, "1", ["m", "c", None, "c"]) == {"c": 1, "m": 2}
    assert grow(spark, root, "2", ["a", "m", "z"]) == {"c": 1, "m": 2, "a": 3, "z": 4}
    assert grow(spark, root, "2", ["other"]) == {"c": 1, "m": 2, "a": 3, "z": 4}
    assert grow(spark, root, "3", ["z", None]) == {"c": 1, "m": 2, "a": 3, "z": 4}
    assert grow(spark, root, "4", ["b"]) == {"c": 1, "m": 2, "a": 3, "z": 4, "b": 5}


def test_ids_through_compaction_and_empty_loads(spark):
    root = scratch_path(spark, "ids")
    assert grow(spark, root, "none", []) == {}
    for n, name in enumerate("qwertyuiop"):
        got = grow(spark, root, name, [name], folders=3)
        assert got[name] == n + 1 and len(got) == n + 1
    assert len(ledger.version_of(spark, root).data) <= 3


def test_a_load_that_fails_gives_no_ids(spark, monkeypatch):
    root = scratch_path(spark, "ids")
    grow(spark, root, "1", ["b"])
    monkeypatch.setattr(files, "move", lambda *_: (_ for _ in ()).throw(OSError("injected")))
    with pytest.raises(OSError):
        grow(spark, root, "2", ["a"])
    monkeypatch.undo()
    assert grow(spark, root, "3", ["c"]) == {"b": 1, "c": 2}


def test_dense_ids_start_few_jobs(spark, sf_small):
    customer = orders.table(spark, sf_small, "customer")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("few", "few")
    keys.category_dim(customer, "c_mktsegment", "segment", "segment_id").collect()
    assert len(tracker.getJobIdsForGroup("few")) <= 5
    spark.sparkContext.setJobGroup("rest", "rest")


@pytest.mark.parametrize("size", [1_000_000, 7])
def test_dense_ids_of_no_keys_and_of_many(spark, size):
    none = spark.createDataFrame([], "k long")
    assert keys.dense_ids(none, "k", "id", size).collect() == []
    many = spark.range(100, 0, -1).selectExpr("id AS k")
    assert sorted(tuple(r) for r in keys.dense_ids(many, "k", "id", size).collect()) == [(k, k) for k in range(1, 101)]
