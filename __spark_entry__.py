
from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bandscope.plans import orders
from bandscope.session import named_scratch, use_scratch

try:
    from bandscope.llm import queries as llm
except ImportError as missing:
    if not (missing.name or "").startswith(("bandscope.llm", "corpus_pipeline")):
        raise
    llm = None


def entry(spark: SparkSession) -> DataFrame:
    """All seven factors per band, from one scan of each table."""
    return queries()["factor_scorecard"](spark, "/root/testdata/sf0.001")


def name_scratch(spark: SparkSession) -> None:
    """A scratch folder for a local session that names none. On a cluster the session must name a shared one."""
    if spark.sparkContext.master.startswith("local") and not named_scratch(spark):
        folder = tempfile.mkdtemp(prefix="scratch-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        use_scratch(spark, f"file://{folder}")


def with_scratch(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        name_scratch(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = orders.registry() | (llm.registry() if llm else {})
    return {name: with_scratch(query) for name, query in found.items()}


BAND = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'High'
               WHEN o_orderpriority = '5-LOW' THEN 'Low' ELSE 'Medium' END"""

BEHAVIOUR = """
behaviour AS (
    SELECT l_orderkey, sum(l_quantity) AS qty, max(l_discount) AS disc,
           CASE WHEN bool_or(l_returnflag = 'R') THEN 'Yes' ELSE 'No' END AS has_return,
           CASE WHEN bool_or(l_linestatus = 'O') THEN 'No' ELSE 'Yes' END AS all_filled
    FROM lineitem GROUP BY l_orderkey
)"""

MART = f"""
{BEHAVIOUR},
mart AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
           c_mktsegment, qty, disc, has_return, all_filled, {BAND} AS band
    FROM orders
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN behaviour ON l_orderkey = o_orderkey
)"""

PREDICATES = {
    "high_discount": "disc >= 0.1",
    "segment_in": "c_mktsegment IN ('AUTOMOBILE', 'BUILDING')",
    "status_f": "o_orderstatus = 'F'",
    "has_return": "has_return = 'Yes'",
    "not_all_filled": "all_filled = 'No'",
}


def rate_columns(name: str) -> str:
    matching = f"count(*) FILTER (WHERE {PREDICATES[name]})"
    return f"{matching} AS n_{name}, round({matching} / count(*) * 100, 2) AS pct_{name}"


def mean_column(name: str, column: str) -> str:
    return f"round(avg({column}), 2) AS mean_{name}"


def by_band(columns: str) -> str:
    return f"WITH {MART} SELECT band, count(*) AS total, {columns} FROM mart GROUP BY band"


def scorecard_sql() -> str:
    lines = [
        f"SELECT band, '{name}' AS factor, 'mean' AS kind, CAST(NULL AS BIGINT) AS matching,"
        f" count(*) AS total, round(avg({column}), 2) AS value FROM mart GROUP BY band"
        for name, column in (("qty", "qty"), ("price", "o_totalprice"))
    ]
    for name, predicate in PREDICATES.items():
        matching = f"count(*) FILTER (WHERE {predicate})"
        lines.append(
            f"SELECT band, '{name}', 'rate', {matching}, count(*),"
            f" round({matching} / count(*) * 100, 2) FROM mart GROUP BY band"
        )
    return " UNION ALL ".join(lines)


def key_report_sql(name: str, dim: str, key: str, fact: str, fact_key: str) -> str:
    return f"""
        SELECT '{name}' AS dimension,
               (SELECT count(*) FROM (SELECT {key} FROM {dim} WHERE {key} IS NOT NULL
                                      GROUP BY {key} HAVING count(*) > 1)) AS repeated_keys,
               (SELECT count({key}) - count(DISTINCT {key}) FROM {dim}) AS surplus_rows,
               (SELECT count(*) FROM {dim} WHERE {key} IS NULL) AS null_keys,
               (SELECT count(*) FROM {fact} f WHERE NOT EXISTS
                   (SELECT 1 FROM {dim} d WHERE d.{key} = f.{fact_key})) AS orphan_fact_rows"""


def histogram_sql(source: str, column: str) -> str:
    """Bins by comparing with the edges, in a join of the values and the bins."""
    return f"""
        SELECT '{column}' AS column_name, b.bin, any_value(b.lo) AS lo, any_value(b.hi) AS hi,
               count(v.x) AS n
        FROM (SELECT i AS bin, low + i * ((high - low) / 20) AS lo,
                     CASE WHEN i = 19 THEN high ELSE low + (i + 1) * ((high - low) / 20) END AS hi
              FROM (SELECT min({column}) AS low, max({column}) AS high FROM {source}),
                   range(20) AS r(i)) b
        LEFT JOIN (SELECT {column} AS x FROM {source}) v
          ON v.x >= b.lo AND (v.x < b.hi OR (b.bin = 19 AND v.x <= b.hi))
        GROUP BY b.bin"""


def box_sql(source: str, by: str, column: str) -> str:
    return f"""
        SELECT q."{by}", any_value(n) AS n, round(any_value(q1), 6) AS q1,
               round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
               round(any_value(fence_low), 6) AS fence_low,
               round(any_value(fence_high), 6) AS fence_high,
               round(least(min(s.x) FILTER (WHERE s.x >= fence_low), any_value(q1)), 6)
                   AS whisker_low,
               round(greatest(max(s.x) FILTER (WHERE s.x <= fence_high), any_value(q3)), 6)
                   AS whisker_high,
               count(*) FILTER (WHERE s.x < fence_low OR s.x > fence_high) AS outliers
        FROM (SELECT *, q1 - 1.5 * (q3 - q1) AS fence_low, q3 + 1.5 * (q3 - q1) AS fence_high
              FROM (SELECT {by}, count({column}) AS n,
                           quantile_cont({column}::DOUBLE, 0.25) AS q1,
                           quantile_cont({column}::DOUBLE, 0.5) AS median,
                           quantile_cont({column}::DOUBLE, 0.75) AS q3
                    FROM {source} WHERE {column} IS NOT NULL GROUP BY {by})) q
        JOIN (SELECT {by} AS g, {column}::DOUBLE AS x FROM {source} WHERE {column} IS NOT NULL) s
          ON s.g = q."{by}"
        GROUP BY q."{by}" """


TYPED = """typed AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_orderkey * 5000000000 AS VARCHAR) AS wide_key,
           CAST(o_totalprice AS VARCHAR) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS "day",
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS moment,
           CASE WHEN o_orderstatus = 'F' THEN 'true' WHEN o_orderstatus IS NOT NULL THEN 'false' END AS finished,
           o_orderpriority, CASE WHEN o_orderkey % 1000 = 7 THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR) END AS nearly_key,
           CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_totalprice AS VARCHAR) END AS some_price,
           CAST(NULL AS VARCHAR) AS nothing
    FROM orders)"""
TYPED_COLUMNS = [
    "o_orderkey", "wide_key", "o_totalprice", "day", "moment", "finished", "o_orderpriority", "nearly_key", "some_price", "nothing",
]


def inferred_sql(column: str) -> str:
    """The narrowest type that every value can be cast to; dates are told from moments by their length."""
    whole = f"""regexp_full_match("{column}", '[-+0-9]+')"""
    number = f"""regexp_full_match("{column}", '[-+0-9.eE]+')"""
    all_of = lambda test: f"""bool_and({test}) FILTER (WHERE "{column}" IS NOT NULL)"""
    return f"""
        SELECT '{column}' AS column_name, count(*) AS "rows", count(*) - count("{column}") AS nulls, count("{column}") AS n_fit,
               CASE WHEN count("{column}") = 0 THEN 'string'
                    WHEN {all_of(f"""lower("{column}") IN ('true', 'false')""")} THEN 'boolean'
                    WHEN {all_of(f'{whole} AND TRY_CAST("{column}" AS INTEGER) IS NOT NULL')} THEN 'int'
                    WHEN {all_of(f'{whole} AND TRY_CAST("{column}" AS BIGINT) IS NOT NULL')} THEN 'bigint'
                    WHEN {all_of(f'{number} AND TRY_CAST("{column}" AS DOUBLE) IS NOT NULL')} THEN 'double'
                    WHEN {all_of(f'length("{column}") = 10 AND TRY_CAST("{column}" AS DATE) IS NOT NULL')} THEN 'date'
                    WHEN {all_of(f'TRY_CAST("{column}" AS TIMESTAMP) IS NOT NULL')} THEN 'timestamp_ntz'
                    ELSE 'string' END AS type
        FROM typed"""


def oracle_sql() -> dict[str, str]:
    return analysis_sql() | (llm.oracle_sql() if llm else {})


def analysis_sql() -> dict[str, str]:
    flat = f"""WITH {BEHAVIOUR}, flat AS (
        SELECT * FROM orders LEFT JOIN customer ON c_custkey = o_custkey
                             LEFT JOIN behaviour ON l_orderkey = o_orderkey)"""
    numbered = """SELECT segment, row_number() OVER (ORDER BY segment) AS segment_id
                  FROM (SELECT DISTINCT c_mktsegment AS segment FROM customer)"""
    pairs = """pairs AS (SELECT c_acctbal, o_totalprice FROM customer
                         JOIN orders ON o_custkey = c_custkey
                         WHERE c_acctbal IS NOT NULL AND o_totalprice IS NOT NULL)"""
    outlier_sql = f"""WITH {MART}, box AS ({box_sql("mart", "band", "qty")})
        SELECT o_orderkey, mart.band, qty FROM mart JOIN box ON box.band = mart.band
        WHERE qty < fence_low OR qty > fence_high"""
    quality = """graded AS (
        SELECT d.doc_id, lang, n_chars, quality,
               CASE quality WHEN 1 THEN 'High' WHEN 0 THEN 'Low' ELSE 'Medium' END AS band
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
    price_missing = "o_orderstatus = 'P' OR o_orderpriority = '5-LOW'"
    all_factors = ", ".join(
        [
            mean_column("qty", "qty"),
            mean_column("price", "o_totalprice"),
            *(rate_columns(name) for name in PREDICATES),
        ]
    )
    lines_key = "(SELECT concat(l_orderkey, '/', l_linenumber) AS line FROM lineitem)"
    return {
        "factor_scorecard": f"WITH {MART} {scorecard_sql()}",
        "factor_scorecard_wide": by_band(all_factors),
        "cohort_mean_qty": by_band(mean_column("qty", "qty")),
        "cohort_mean_price": by_band(mean_column("price", "o_totalprice")),
        "cohort_rate_high_discount": by_band(rate_columns("high_discount")),
        "cohort_rate_segment_in": by_band(rate_columns("segment_in")),
        "cohort_rate_status_eq": by_band(rate_columns("status_f")),
        "cohort_rate_has_return": by_band(rate_columns("has_return")),
        "cohort_rate_not_all_filled": by_band(rate_columns("not_all_filled")),
        "factor_gap": f"""WITH {MART}, card AS ({scorecard_sql()})
            SELECT lo.factor, lo.kind, lo.value AS low_value, hi.value AS high_value,
                   round(lo.value - hi.value, 2) AS gap
            FROM card lo JOIN card hi ON hi.factor = lo.factor
            WHERE lo.band = 'Low' AND hi.band = 'High'""",
        "band_with_null_default": f"""WITH {quality}
            SELECT band, count(*) AS total, count(*) FILTER (WHERE lang = 'en') AS n_english,
                   round(count(*) FILTER (WHERE lang = 'en') / count(*) * 100, 2) AS pct_english,
                   round(avg(n_chars), 2) AS mean_chars
            FROM graded GROUP BY band""",
        "measure_by_band": f"WITH {MART} SELECT band, qty FROM mart WHERE qty IS NOT NULL",
        "mart_rows": f"WITH {MART} SELECT * FROM mart",
        "published_mart": f"WITH {MART} SELECT * FROM mart",
        "published_versions": f"""WITH {MART}
            SELECT *, '1' AS version FROM mart WHERE o_orderstatus <> 'F'
            UNION ALL SELECT *, '2' FROM mart UNION ALL SELECT *, 'view' FROM mart""",
        "published_statistics": f"WITH {MART} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, 'string' AS type, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values FROM mart"
            for c in ("o_orderstatus", "o_orderpriority", "c_mktsegment", "has_return", "all_filled", "band")
        ),
        "scorecard_from_batches": f"WITH {MART} {scorecard_sql()}",
        "star_entity_dim": f"""{flat} SELECT CAST(o_orderkey AS VARCHAR) AS entity_id,
            c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM flat""",
        "star_behaviour_dim": f"""{flat} SELECT CAST(o_orderkey AS VARCHAR) AS entity_id,
            qty, disc, has_return, all_filled FROM flat""",
        "star_fact": f"""{flat} SELECT CAST(o_orderkey AS VARCHAR) AS entity_id,
            c_mktsegment AS segment, o_totalprice AS price, o_orderstatus AS status,
            o_orderpriority AS priority FROM flat""",
        "star_split": f"""{flat}, segments AS ({numbered})
            SELECT CAST(o_orderkey AS VARCHAR) AS entity_id,
                   CAST(segment_id AS VARCHAR) AS segment_id, c_mktsegment AS segment,
                   o_totalprice AS price, o_orderpriority AS priority, c_nationkey AS nation, qty,
                   {BAND} AS band
            FROM flat LEFT JOIN segments ON segment = c_mktsegment""",
        "layered_scorecard": f"WITH {MART} {scorecard_sql()}",
        "category_dim": numbered,
        "category_dim_large": """
            SELECT order_key, row_number() OVER (ORDER BY order_key) AS order_id
            FROM (SELECT DISTINCT o_orderkey AS order_key FROM orders)""",
        "category_dim_hash": """SELECT DISTINCT c_mktsegment AS segment,
            md5(c_mktsegment) AS segment_id FROM customer""",
        "category_dim_grown": """
            SELECT part_type, row_number() OVER (ORDER BY load, part_type) AS type_id
            FROM (SELECT p_type AS part_type, min(CASE WHEN p_size <= 3 THEN 1 ELSE 2 END) AS load
                  FROM part WHERE p_type IS NOT NULL GROUP BY p_type)""",
        "fact_fk_resolved": f"""WITH segments AS ({numbered})
            SELECT o_orderkey, o_totalprice, c_mktsegment AS segment, segment_id
            FROM orders LEFT JOIN customer ON c_custkey = o_custkey
                        LEFT JOIN segments ON segment = c_mktsegment""",
        "key_report": f"WITH {BEHAVIOUR} "
        + " UNION ALL ".join(
            [
                key_report_sql("customer", "customer", "c_custkey", "orders", "o_custkey"),
                key_report_sql("behaviour", "behaviour", "l_orderkey", "orders", "o_orderkey"),
                key_report_sql("lineitem", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            ]
        ),
        "key_report_by_bitmaps": f"WITH {BEHAVIOUR} "
        + " UNION ALL ".join(
            [
                key_report_sql("customer", "customer", "c_custkey", "orders", "o_custkey"),
                key_report_sql("behaviour", "behaviour", "l_orderkey", "orders", "o_orderkey"),
                key_report_sql("lineitem", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            ]
        ),
        "key_report_composite": key_report_sql("line", lines_key, "line", lines_key, "line"),
        "pairs_inner_notnull": f"WITH {pairs} SELECT * FROM pairs",
        "table_counts": """
            SELECT 'customer' AS table_name, count(*) AS total FROM customer
            UNION ALL SELECT 'lineitem', count(*) FROM lineitem
            UNION ALL SELECT 'orders', count(*) FROM orders
            UNION ALL SELECT 'segment', count(DISTINCT c_mktsegment) FROM customer""",
        "null_profile": f"""WITH {MART}
            SELECT 'mart' AS table_name, count(*) AS total,
                   count(*) - count(o_orderkey) AS o_orderkey_nulls,
                   count(*) - count(c_mktsegment) AS c_mktsegment_nulls,
                   count(*) - count(qty) AS qty_nulls,
                   count(*) - count(has_return) AS has_return_nulls FROM mart""",
        "cell_profile": f"""WITH {MART}
            SELECT 'customer' AS table_name, count(*) * 5 AS cells,
                   count(*) * 5 - count(c_custkey) - count(c_name) - count(c_nationkey)
                       - count(c_acctbal) - count(c_mktsegment) AS null_cells,
                   count(c_custkey) + count(c_name) + count(c_nationkey) + count(c_acctbal)
                       + count(c_mktsegment) AS valid_cells FROM customer
            UNION ALL
            SELECT 'mart', count(*) * 3, count(*) * 3 - count(qty) - count(disc) - count(c_mktsegment),
                   count(qty) + count(disc) + count(c_mktsegment) FROM mart""",
        "numeric_summary": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, min({c})::DOUBLE AS minimum, max({c})::DOUBLE AS maximum,"
            f" avg({c}) AS average FROM lineitem"
            for c in ("l_quantity", "l_linenumber", "l_suppkey")
        ),
        "numeric_summary_rounded": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, min({c}) AS minimum, max({c}) AS maximum,"
            f" round(avg({c}), 2) AS average FROM lineitem"
            for c in ("l_extendedprice", "l_discount")
        ),
        "value_counts": "SELECT p_size, count(*) AS total FROM part GROUP BY p_size",
        "value_counts_top": """
            SELECT l_partkey, count(*) AS total FROM lineitem GROUP BY l_partkey ORDER BY total DESC, l_partkey LIMIT 25""",
        "grouped_summary": """
            SELECT c_mktsegment, count(*) AS total, round(avg(c_acctbal), 2) AS avg_c_acctbal,
                   min(c_acctbal) AS min_c_acctbal, max(c_acctbal) AS max_c_acctbal
            FROM customer GROUP BY c_mktsegment""",
        "grouped_summary_two_avgs": f"""WITH {MART}
            SELECT o_orderpriority, count(*) AS total,
                   round(avg(o_totalprice), 2) AS avg_o_totalprice, round(avg(qty), 2) AS avg_qty
            FROM mart GROUP BY o_orderpriority""",
        "share_of_total": """
            SELECT o_orderpriority, count(*) AS total,
                   count(*) / (SELECT count(*) FROM orders) * 100 AS percentage
            FROM orders GROUP BY o_orderpriority""",
        "share_with_null": f"""WITH {quality}
            SELECT quality, count(*) AS total,
                   count(*) / (SELECT count(*) FROM graded) * 100 AS percentage
            FROM graded GROUP BY quality""",
        "preview": f"WITH {MART} SELECT * FROM mart ORDER BY o_orderkey LIMIT 10",
        "preview_five": "SELECT * FROM customer ORDER BY c_custkey LIMIT 5",
        "histogram_price": histogram_sql("orders", "o_totalprice"),
        "histogram_acctbal": histogram_sql("customer", "c_acctbal"),
        "histogram_pairs": f"WITH {pairs} {histogram_sql('pairs', 'c_acctbal')}"
        f" UNION ALL {histogram_sql('pairs', 'o_totalprice')}",
        "box_stats_qty": f"WITH {MART} {box_sql('mart', 'band', 'qty')}",
        "box_stats_price": box_sql("lineitem", "l_returnflag", "l_extendedprice"),
        "box_stats_many_groups": box_sql("lineitem", "l_suppkey", "l_quantity"),
        "box_stats_price_large": box_sql("lineitem", "l_returnflag", "l_extendedprice"),
        "box_stats_many_groups_large": box_sql("lineitem", "l_suppkey", "l_quantity"),
        "outlier_rows": outlier_sql,
        "outlier_rows_large": outlier_sql,
        "csv_roundtrip": "SELECT * FROM customer",
        "csv_all_text": """
            SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
                   CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
            FROM part""",
        "csv_multiline": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "sql_views": """
            SELECT c_mktsegment AS segment, o_orderpriority AS priority, count(*) AS n_orders,
                   max(o_totalprice) AS top_price
            FROM customer JOIN orders ON o_custkey = c_custkey
            WHERE o_totalprice IS NOT NULL GROUP BY c_mktsegment, o_orderpriority""",
        "fact_fk_null": f"""WITH {quality}
            SELECT doc_id, quality, CASE quality WHEN 0 THEN CAST(1 AS BIGINT) WHEN 1 THEN 2 END AS quality_id
            FROM graded""",
        "csv_inferred_types": f"WITH {TYPED} " + " UNION ALL ".join(map(inferred_sql, TYPED_COLUMNS)),
        "csv_inferred_rows": f"""WITH {TYPED}
            SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(wide_key AS BIGINT) AS wide_key,
                   CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST("day" AS DATE) AS "day",
                   CAST(moment AS TIMESTAMP) AS moment, CAST(finished AS BOOLEAN) AS finished, o_orderpriority,
                   nearly_key, CAST(some_price AS DOUBLE) AS some_price, nothing FROM typed""",
        "csv_malformed": f"""SELECT o_orderkey, o_orderstatus,
            CASE WHEN {price_missing} THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders""",
        "csv_reject_counts": """
            SELECT '*' AS column_name, CAST(0 AS BIGINT) AS rejected
            UNION ALL SELECT 'o_orderkey', CAST(0 AS BIGINT)
            UNION ALL SELECT 'o_orderstatus', CAST(0 AS BIGINT)
            UNION ALL SELECT 'o_totalprice', count(*) FROM orders WHERE o_orderstatus = 'P'""",
    }
