"""Queries over data-quality checks, checked loads, run health and the data dictionary."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quern.operators import quality
from quern.plans.registry import Tables, query


def _check_sql(check: str, target: str, failed: str, table: str) -> str:
    return f"SELECT '{check}' AS check_name, '{target}' AS target, count(*) AS n_rows, count(*) FILTER ({failed}) AS n_failed FROM {table}"


NULLS = " UNION ALL ".join(
    _check_sql("nulls", c, f"nullif({c}, {v}) IS NULL", "orders") for c, v in (("o_orderstatus", "'P'"), ("o_orderpriority", "'5-LOW'"))
)


def _with_gaps(t: Tables):
    """Orders in which one value of two columns is missing."""
    gap = {"o_orderstatus": "P", "o_orderpriority": "5-LOW"}
    return t.orders.select(*[F.nullif(F.col(c), F.lit(v)).alias(c) for c, v in gap.items()])


@query("check_nulls", NULLS)
def _check_nulls(t: Tables):
    return quality.check_nulls(_with_gaps(t))


DUPLICATES = """SELECT 'duplicates' AS check_name, 'text,lang' AS target, sum(n)::BIGINT AS n_rows, sum(n - 1)::BIGINT AS n_failed
  FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang)"""


@query("check_duplicates", DUPLICATES)
def _check_duplicates(t: Tables):
    return quality.check_duplicates(t.documents.select("text", "lang"))


REGEX = _check_sql("regex", "c_name", "NOT regexp_matches(c_name, '[02468]$')", "customer")


@query("check_regex", REGEX)
def _check_regex(t: Tables):
    return quality.check_regex(t.customer, "c_name", "[02468]$")


RANGE = _check_sql("range", "l_discount", "l_discount NOT BETWEEN 0.02 AND 0.08", "lineitem")


@query("check_range", RANGE)
def _check_range(t: Tables):
    return quality.check_range(t.lineitem, "l_discount", 0.02, 0.08)


FOREIGN = """SELECT 'foreign_key' AS check_name, 'l_orderkey' AS target, count(*) AS n_rows,
  count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')) AS n_failed FROM lineitem"""


@query("check_foreign_key", FOREIGN)
def _check_foreign_key(t: Tables):
    return quality.check_foreign_key(t.lineitem, "l_orderkey", t.orders.filter("o_orderstatus <> 'P'"), "o_orderkey")


DATES = _check_sql("date_format", "day", "month(o_orderdate) = 2", "orders")


@query("check_date_format", DATES)
def _check_date_format(t: Tables):
    text = F.when(F.month("o_orderdate") == 2, F.date_format("o_orderdate", "dd/MM/yyyy"))
    return quality.check_date_format(t.orders.select(F.coalesce(text, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day")), "day")


UNIQUE = """SELECT 'unique' AS check_name, 'o_custkey,o_orderdate' AS target, sum(n)::BIGINT AS n_rows,
  coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS n_failed FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate)"""


@query("check_unique", UNIQUE)
def _check_unique(t: Tables):
    return quality.check_unique(t.orders, ["o_custkey", "o_orderdate"])


@query(
    "quality_report",
    f"""SELECT table_name, check_name, target, n_rows, n_failed, round(n_failed * 100.0 / n_rows, 6) AS percent_failed, n_failed = 0 AS passed FROM (
          SELECT 'orders' AS table_name, * FROM ({NULLS}) UNION ALL SELECT 'orders', * FROM ({UNIQUE}) UNION ALL
          SELECT 'customer', * FROM ({REGEX}) UNION ALL SELECT 'lineitem', * FROM ({RANGE}) UNION ALL SELECT 'lineitem', * FROM ({FOREIGN}))""",
)
def _quality_report(t: Tables):
    found = {
        "orders": [_check_nulls(t), _check_unique(t)],
        "customer": [_check_regex(t)],
        "lineitem": [_check_range(t), _check_foreign_key(t)],
    }
    return quality.quality_report(found).withColumn("percent_failed", F.round("percent_failed", 6))


@query(
    "run_pipeline",
    """SELECT 'customers' AS name, count(*) AS n_rows, 2 AS n_checks, 0 AS n_failed_checks, 'loaded' AS state FROM customer
       UNION ALL SELECT 'orders', count(*), 2, 1, 'rejected' FROM orders""",
)
def _run_pipeline(t: Tables):
    mark = uuid.uuid4().hex[:8]
    return quality.run_pipeline(
        t.spark,
        [
            quality.Load(
                "customers", lambda: t.customer, "quern_check", f"customers_{mark}",
                [lambda d: quality.check_unique(d, ["c_custkey"]), lambda d: quality.check_nulls(d, ["c_name"])],
            ),
            quality.Load(
                "orders", lambda: t.orders, "quern_check", f"orders_{mark}",
                [lambda d: quality.check_unique(d, ["o_custkey"]), lambda d: quality.check_nulls(d, ["o_orderkey"])],
            ),
        ],
    )


@query(
    "pipeline_health",
    """SELECT event_type AS name, date_trunc('week', ts)::DATE AS period, count(*) AS n_runs, count(*) FILTER (value < 10) AS n_failures,
         round(count(*) FILTER (value >= 10) * 100.0 / count(*), 6) AS success_percent, round(avg(user_id), 6) AS mean_seconds,
         round(sum(value), 3) AS cost, count(*) FILTER (value >= 10) * 100.0 / count(*) < 90 AS alert FROM events GROUP BY 1, 2""",
)
def _pipeline_health(t: Tables):
    log = t.events.select(F.col("event_type").alias("name"), F.col("ts").alias("started"), (F.col("value") >= 10).alias("ok"), F.col("user_id").alias("seconds"), "value")
    found = quality.pipeline_health(log, cost="value")
    return found.withColumns({"success_percent": F.round("success_percent", 6), "mean_seconds": F.round("mean_seconds", 6), "cost": F.round("cost", 3)})


def _column_sql(table: str, columns: list[tuple[str, str]]) -> str:
    def end(fn: str, c: str, kind: str) -> str:
        if kind.startswith("array"):
            return "NULL::VARCHAR"
        return f"({fn}({c}) + 0.0::DOUBLE)::VARCHAR" if kind == "double" else f"{fn}({c})::VARCHAR"

    return " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, {i} AS position, '{c}' AS column_name, '{kind}' AS type, count({c}) AS non_null,
            {end('min', c, kind)} AS low, {end('max', c, kind)} AS high, count(*) AS n_rows FROM {table}"""
        for i, (c, kind) in enumerate(columns)
    )


NATION = [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")]
SUPPLIER = [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int")]


@query("data_dictionary", f"{_column_sql('nation', NATION)} UNION ALL {_column_sql('supplier', SUPPLIER)}")
def _data_dictionary(t: Tables):
    chosen = {"nation": t.nation.select(*[c for c, _ in NATION]), "supplier": t.supplier.select(*[c for c, _ in SUPPLIER])}
    return quality.data_dictionary(chosen)


@query(
    "relationships",
    """SELECT 'orders' AS child, 'o_custkey' AS child_column, 'customer' AS parent, 'c_custkey' AS parent_column,
         (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) = 0 AS included
       UNION ALL SELECT 'customer', 'c_custkey', 'orders', 'o_custkey',
         (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) = 0""",
)
def _relationships(t: Tables):
    pairs = [("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_custkey", "orders", "o_custkey")]
    return quality.relationships({"orders": t.orders, "customer": t.customer}, pairs)


# Columns of all given tables, by kind.
COLUMNS = {
    "benchmark": {"item_id": "bigint", "text": "string"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "events": {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
        "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    },
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double"},
    "region": {"r_regionkey": "int", "r_name": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
}


def _values_sql() -> str:
    kinds = {"int": "int", "bigint": "int", "string": "string"}
    return " UNION ALL ".join(
        f"SELECT '{t}' AS t, '{c}' AS c, '{kinds[k]}' AS kind, {c}::VARCHAR AS v FROM {t}"
        for t, cols in COLUMNS.items() for c, k in cols.items() if k in kinds
    )


@query(
    "find_relationships",
    f"""WITH v AS (SELECT DISTINCT t, c, kind, v FROM ({_values_sql()}) WHERE v IS NOT NULL),
         s AS (SELECT t, c, count(*) AS n FROM v GROUP BY t, c),
         r AS ({" UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS n_rows FROM {t}" for t in COLUMNS)}),
         p AS (SELECT a.t AS child, a.c AS child_column, b.t AS parent, b.c AS parent_column, count(*) AS n
               FROM v a JOIN v b ON a.kind = b.kind AND a.v = b.v AND (a.t, a.c) <> (b.t, b.c) GROUP BY a.t, a.c, b.t, b.c)
       SELECT child, child_column, parent, parent_column, p.n AS n_values, o.n = n_rows AS parent_is_key
       FROM p JOIN s ON s.t = child AND s.c = child_column AND s.n = p.n
       JOIN s o ON o.t = parent AND o.c = parent_column JOIN r ON r.t = parent""",
)
def _find_relationships(t: Tables):
    return quality.find_relationships({name: getattr(t, name) for name in COLUMNS})


@query("data_dictionary_all", " UNION ALL ".join(_column_sql(t, list(cols.items())) for t, cols in COLUMNS.items()))
def _data_dictionary_all(t: Tables):
    return quality.data_dictionary({name: getattr(t, name) for name in COLUMNS})
