"""Reports and ids that are kept up to date from what is new, never from the whole past.

Both kinds live in versioned folders (`sources.versions`): a batch is committed whole or not at all, and a batch id
that was committed before changes nothing, so a run that died can simply be made again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bandscope.functions.bands import band_rank
from bandscope.operators.keys import dense_ids
from bandscope.session import broadcast_if_small, stored
from bandscope.sources.versions import Version, VersionedFolder
from bandscope.spec import BandSpec, Factor

# Sums are exact decimals, so that what a revision takes back is what was added, in any order.
SUM = "decimal(38,8)"
# Data folders a state may have before the next commit makes one of them.
FOLDERS = 16


def batch_key(batch: str) -> str:
    return hashlib.sha256(batch.encode()).hexdigest()[:16]


def committed(folder: VersionedFolder, batch: str) -> bool:
    now = folder.version()
    return now is not None and batch_key(batch) in now.facts["batches"]


# -- scorecard


def partial_scorecard(mart: DataFrame, factors: Sequence[Factor], sign: Column | None = None, band_col: str = "band") -> DataFrame:
    """One row for each band and factor with what adds up: total rows, matching rows, number and sum of measures.

    ``sign`` is 1 for rows that come and -1 for rows that go; without it all rows come. One aggregation, whose
    result has bands x factors rows, whatever the batch. Measures are rounded to 8 digits after the point.
    """
    sign = F.lit(1) if sign is None else sign
    columns = [F.sum(sign).cast("bigint").alias("total")]
    lines = []
    for k, f in enumerate(factors):
        if f.kind == "rate":
            columns.append(F.sum(F.when(F.expr(f.expr), sign).otherwise(0)).cast("bigint").alias(f"n{k}"))
            columns.append(F.lit(0).cast(SUM).alias(f"s{k}"))
        else:
            value = F.expr(f.expr).cast(SUM)
            columns.append(F.sum(F.when(value.isNotNull(), sign).otherwise(0)).cast("bigint").alias(f"n{k}"))
            columns.append(F.coalesce(F.sum(value * sign), F.lit(0)).cast(SUM).alias(f"s{k}"))
        lines.append(f"'{f.name}', '{f.kind}', n{k}, s{k}")
    stacked = f"stack({len(lines)}, {', '.join(lines)}) AS (factor, kind, n, amount)"
    return mart.groupBy(F.col(band_col).alias("band")).agg(*columns).selectExpr("band", stacked, "total")


def merged(parts: DataFrame) -> DataFrame:
    """Partial scorecards added up; bands that came to nothing are left out."""
    added = [F.sum("n").alias("n"), F.sum("amount").cast(SUM).alias("amount"), F.sum("total").alias("total")]
    return parts.groupBy("band", "factor", "kind").agg(*added).filter("n <> 0 OR amount <> 0 OR total <> 0")


def commit_batch(root: str, batch: str, part: DataFrame, folders: int = FOLDERS) -> bool:
    """Add a partial scorecard to the state in the versioned folder `root`; False if the batch is in it already.

    Nothing but the part is computed. When the state has come to ``folders`` data folders, they and the part
    become one, so a reader opens ``folders`` at most. If another writer commits meanwhile this fails with
    Conflict and can be made again.
    """
    folder = VersionedFolder(part.sparkSession, root)
    now = folder.version()
    batches = now.facts["batches"] if now else []
    if batch_key(batch) in batches:
        return False
    facts = {"batches": [*batches, batch_key(batch)]}
    if now and len(now.data) >= folders:
        state = folder.rows_of(now.data, now.schema)
        one = merged(state.unionByName(part)).coalesce(1)
        folder.commit([folder.write(one)], state.schema, now, facts)
    else:
        folder.commit([*(now.data if now else ()), folder.write(part.coalesce(1))], part.schema, now, facts)
    return True


def scorecard_state(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The state, one row for each band and factor: band, factor, kind, n, amount, total."""
    return merged(VersionedFolder(spark, root).read(version))


def scorecard_from_state(state: DataFrame, factors: Sequence[Factor], bands: BandSpec) -> DataFrame:
    """The scorecard in the form of `factor_scorecard`, from a state alone: no fact is read."""
    order = F.create_map(*(x for k, f in enumerate(factors) for x in (F.lit(f.name), F.lit(k))))
    rate = F.col("kind") == "rate"
    value = F.when(rate, F.round(F.col("n") / F.col("total") * 100, 2)).otherwise(
        F.round(F.try_divide(F.col("amount").cast("double"), F.col("n")), 2)
    )
    return (
        state.filter(F.col("factor").isin([f.name for f in factors]))
        .orderBy(order[F.col("factor")], band_rank("band", bands), "band")
        .select("band", "factor", "kind", F.when(rate, F.col("n")).alias("matching"), "total", value.alias("value"))
    )


# -- ids


def grow_category_dim(
    root: str, batch: str, df: DataFrame, column: str, name: str, id_name: str, folders: int = FOLDERS
) -> DataFrame:
    """The category dimension kept in the versioned folder `root`, grown by the values of a load that it lacks.

    Ids are given once: a value that is there keeps its id, and new ones get the next ids, in their order. Only the
    load's own values and the ledger are read. NULL is no category. A batch id that was committed before adds
    nothing; the dimension comes back as it is. A second writer at the same time fails with Conflict.
    """
    spark = df.sparkSession
    folder = VersionedFolder(spark, root)
    now = folder.version()
    if committed(folder, batch):
        return folder.read()
    values = df.select(F.col(column).alias(name)).where(F.col(name).isNotNull()).distinct()
    facts = dict(now.facts) if now else {"batches": [], "top": 0}
    if now:
        known = folder.rows_of(now.data, now.schema)
        values = values.join(broadcast_if_small(known.select(name)), name, "left_anti")
    fresh = dense_ids(values, name, id_name).withColumn(id_name, (F.col(id_name) + facts["top"]).cast("bigint"))
    fresh = stored(fresh, "new-ids")
    added = fresh.count()
    facts |= {"batches": [*facts["batches"], batch_key(batch)], "top": facts["top"] + added}
    data = now.data if now else ()
    if not now or added:
        compact = len(data) >= folders
        rows = known.unionByName(fresh) if compact else fresh
        data = (*(() if compact else data), folder.write(rows))
    folder.commit(data, fresh.schema, now, facts)
    return folder.read()


def version_of(spark: SparkSession, root: str) -> Version | None:
    return VersionedFolder(spark, root).version()
