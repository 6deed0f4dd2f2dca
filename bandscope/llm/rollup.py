"""Token counts by source, language and tokenizer version, kept by signed changes.

A batch of changes is summed to one signed row for each (source, lang, tokenizer). The rows of the batches
lie in a versioned folder (`sources.versions`): a batch is committed by one record put in place, so it counts whole or not
at all; the record names the batches it holds, so one that is in it is not counted again. When the state has come to
`FOLDERS` batches, the next commit adds them up to one set of totals, so however many batches were
committed, the totals are read from a few small tables. Only the changes of a batch are read to commit it,
never the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bandscope.llm import packing
from bandscope.llm import words as W
from bandscope.sources.versions import VersionedFolder

# Batches whose rows lie apart before a commit makes one table of them.
FOLDERS = 16
KEYS = ("source", "lang", "tokenizer")
CHANGES = "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long"
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def counted(docs: DataFrame, tokenizers: dict[str, Column]) -> DataFrame:
    """One row for each document and tokenizer version, with its n_tokens. Null texts have no tokens.

    Versions are given as expressions; `counted_by` takes tokenizer files. Repeated rows are counted as often.
    """
    made = F.array(*(F.struct(F.lit(name).alias("tokenizer"), F.coalesce(n, F.lit(0)).cast("long").alias("n_tokens")) for name, n in tokenizers.items()))
    return docs.select("doc_id", "source", "lang", F.explode(made).alias("_t")).select("doc_id", "source", "lang", "_t.*")


def counted_by(docs: DataFrame, tokenizers: dict[str, str]) -> DataFrame:
    """One row for each document and tokenizer version, with its n_tokens; tokenizers are files of the kind `packing` reads.

    docs has doc_id, source, lang, text and maybe more, which is left out. Each whole text is read once and
    counted by every version. Null and empty texts have no tokens; repeated rows are counted as often.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                col = W.column(part.column("text"))
                for version, path in tokenizers.items():
                    _, first = packing.cache(path).ids(col)
                    own = [part.column(c) for c in ("doc_id", "source", "lang")]
                    yield pa.RecordBatch.from_arrays(
                        [*own, pa.array([version] * part.num_rows, pa.string()), pa.array(np.diff(first), pa.int64())],
                        ["doc_id", *KEYS, "n_tokens"],
                    )

    rows = docs.select("doc_id", F.col("source").cast("string"), F.col("lang").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(W.tidy(count), f"doc_id {kind}, source string, lang string, tokenizer string, n_tokens long")


def inserts(rows: DataFrame) -> DataFrame:
    """Changes that add each row (source, lang, tokenizer, n_tokens). A repeated row is added as often, here and below."""
    return rows.select(F.lit("insert").alias("op"), *KEYS, "n_tokens", F.lit(0).cast("long").alias("old_tokens"))


def deletes(rows: DataFrame) -> DataFrame:
    """Changes that take each row away with the count it was added with."""
    return rows.select(F.lit("delete").alias("op"), *KEYS, "n_tokens", F.lit(0).cast("long").alias("old_tokens"))


def revisions(rows: DataFrame, new: Column) -> DataFrame:
    """Changes that replace each row's count by `new`; the number of documents stays."""
    return rows.select(F.lit("revise").alias("op"), *KEYS, new.cast("long").alias("n_tokens"), F.col("n_tokens").alias("old_tokens"))


def signed(changes: DataFrame) -> DataFrame:
    """One row for each key: documents and tokens more or less. Null keys are keys of their own; null counts are 0.

    An op other than insert, delete and revise fails.
    """
    n, old = (F.coalesce(F.col(c), F.lit(0)) for c in ("n_tokens", "old_tokens"))
    unknown = F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null"))))
    docs = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).when(F.col("op") == "revise", 0).otherwise(unknown.cast("int"))
    tokens = F.when(F.col("op") == "insert", n).when(F.col("op") == "delete", -n).otherwise(n - old)
    return changes.groupBy(*KEYS).agg(F.sum(docs).cast("long").alias("n_docs"), F.sum(tokens).cast("long").alias("n_tokens"))


def added_up(rows: DataFrame) -> DataFrame:
    summed = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return summed.filter("n_docs <> 0 OR n_tokens <> 0")


def commit(state: str, batch_id: str, changes: DataFrame, folders: int = FOLDERS) -> bool:
    """Add a batch to the rollup in the folder `state`; False if a batch of this id was there already.

    A failure at any point, also of a file step, raises and leaves the rollup as it was; the same call can be made again.
    If another writer commits meanwhile it fails with Conflict, and can be made again too. An empty batch
    is committed like any other.
    """
    folder = VersionedFolder(changes.sparkSession, state)
    now = folder.version()
    key = hashlib.sha256(batch_id.encode()).hexdigest()[:16]
    known = now.facts["batches"] if now else []
    if key in known:
        return False
    rows, data = signed(changes), now.data if now else ()
    if len(data) >= folders:
        rows, data = added_up(folder.rows_of(data, now.schema).unionByName(rows)), ()
    name = folder.write(rows)
    schema = changes.sparkSession.createDataFrame([], TOTALS).schema
    folder.commit([*data, name], schema, now, {"batches": [*known, key]})
    return True


def totals(spark: SparkSession, state: str, version: int | None = None) -> DataFrame:
    """Documents and tokens by source, lang and tokenizer over all committed batches; keys that came to nothing are left out.

    With `version` the totals as they were after so many commits.
    """
    folder = VersionedFolder(spark, state)
    if folder.version() is None:
        return spark.createDataFrame([], TOTALS)
    return added_up(folder.read(version))
