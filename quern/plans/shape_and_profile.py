"""Queries over projections, filters, ranks, profiles and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import profile, shape
from quern.plans.registry import Tables, query


@query("project_rename", "SELECT s_name AS \"Supplier Name\", s_suppkey AS supplier_id FROM supplier")
def _project_rename(t: Tables):
    return shape.project_rename(t.supplier, {"s_name": "Supplier Name", "s_suppkey": "supplier_id"})


@query(
    "nan_to_null",
    """SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS balance,
              CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment FROM customer""",
)
def _nan_to_null(t: Tables):
    rows = t.customer.select(
        "c_custkey",
        F.when(F.col("c_nationkey") == 3, float("nan")).otherwise(F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") == "BUILDING", "NaN").otherwise(F.col("c_mktsegment")).alias("segment"),
    )
    return shape.nan_to_null(rows)


@query(
    "coerce",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN trunc(value)::INTEGER END AS whole,
              CASE WHEN event_type <> 'error' THEN value END AS number,
              CASE WHEN event_type <> 'view' THEN ts::DATE END AS day FROM events""",
)
def _coerce(t: Tables):
    text = F.when(F.col("event_type") == "error", "no reading").otherwise(F.col("value").cast("string"))
    day = F.when(F.col("event_type") == "view", "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    raw = t.events.select("event_id", text.alias("whole"), text.alias("number"), day.alias("day"))
    return shape.coerce(raw, {"whole": "int", "number": "double", "day": "date"})


@query("trim_columns", "SELECT p_partkey, p_name, p_brand FROM part")
def _trim_columns(t: Tables):
    padded = t.part.select("p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"), "p_brand")
    return shape.trim_columns(padded, ["p_name"])


@query("require_key", "SELECT o_orderkey AS k, o_custkey FROM orders WHERE o_orderstatus <> 'F'")
def _require_key(t: Tables):
    key = F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey"))
    return shape.require_key(t.orders.select(key.alias("k"), "o_custkey"), "k")


def _cost_centres(t: Tables):
    segment = F.col("c_mktsegment")
    unit = (
        F.when(segment == "BUILDING", "BU List").when(segment == "MACHINERY", "0").when(segment != "FURNITURE", segment)
    )
    owner = F.when(F.col("c_nationkey") == 4, "SaaS").when(F.col("c_nationkey") != 5, F.lit("team"))
    return t.customer.select("c_custkey", unit.alias("unit"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("name"), owner.alias("owner"))


@query(
    "exclude_rows",
    """SELECT c_custkey FROM customer WHERE c_mktsegment <> 'FURNITURE'
       AND c_nationkey NOT IN (1, 2, 3, 4, 5)""",
)
def _exclude_rows(t: Tables):
    kept = shape.exclude_rows(_cost_centres(t), ["unit"], {"name": ["N1", "N2", "N3"], "owner": ["SaaS"]})
    return kept.select("c_custkey")


@query(
    "exclude_rows_intended",
    """SELECT c_custkey FROM customer WHERE c_mktsegment NOT IN ('FURNITURE', 'BUILDING', 'MACHINERY')
       AND c_nationkey NOT IN (1, 2, 3, 4, 5)""",
)
def _exclude_rows_intended(t: Tables):
    rules = {"unit": ["BU List", "0"], "name": ["N1", "N2", "N3"], "owner": ["SaaS"]}
    return shape.exclude_rows(_cost_centres(t), ["unit"], rules).select("c_custkey")


@query(
    "drop_repeated_header",
    "SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS cost_type FROM customer WHERE c_nationkey <> 1",
)
def _drop_repeated_header(t: Tables):
    value = F.when(F.col("c_nationkey") == 1, "Cost Type").when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return shape.drop_repeated_header(t.customer.select(value.alias("cost_type")), "cost_type", "Cost Type")


@query(
    "require_nonempty",
    "SELECT CAST(doc_id AS VARCHAR) AS id, lang, source FROM documents WHERE lang NOT IN ('es', 'de')",
)
def _require_nonempty(t: Tables):
    lang = F.when(F.col("lang") == "es", "").when(F.col("lang") != "de", F.col("lang"))
    rows = t.documents.select(F.col("doc_id").cast("string").alias("id"), lang.alias("lang"), "source", "n_chars")
    return shape.require_nonempty(rows, ["id", "lang", "source"])


@query(
    "exclude_record",
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
       WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'F') AND l_tax > 0""",
)
def _exclude_record(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("tax")
    )
    return shape.exclude_record(rows, {"l_returnflag": "R", "l_linestatus": "F"}, "tax").drop("tax")


@query("drop_columns", "SELECT event_id, ts::DATE AS day, event_type FROM events")
def _drop_columns(t: Tables):
    return t.events.withColumn("day", F.to_date("ts")).drop("ts", "user_id", "value", "props")


@query(
    "drop_by_id",
    "SELECT event_id, value FROM events WHERE event_id NOT IN (49, 134, 244, 245) AND abs(value) <= 50",
)
def _drop_by_id(t: Tables):
    rows = t.events.select("event_id", "value")
    listed = shape.drop_by_id(rows, [49, 134, 244, 245], "event_id")
    outliers = profile.range_outliers(rows, "value", -50, 50).select("event_id")
    return shape.drop_by_id(listed, outliers, "event_id")


@query("slice_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5 OFFSET 45")
def _slice_rows(t: Tables):
    return shape.slice_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 45, 50)


@query(
    "slice_rows_deep",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 100000 OFFSET 1000",
)
def _slice_rows_deep(t: Tables):
    return shape.slice_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 1000, 101_000)


@query("add_default_column", "SELECT doc_id, quality, toxic, false AS user_provided FROM labels")
def _add_default_column(t: Tables):
    once = shape.add_default_column(t.labels, "user_provided", False)
    return shape.add_default_column(once, "user_provided", True)


@query("split_by_value", "SELECT conv_id, turn FROM conversations WHERE role = 'assistant'")
def _split_by_value(t: Tables):
    return t.conversations.filter(F.col("role") == "assistant").select("conv_id", "turn")


MISSING = """SELECT count(*) AS n, count(*) FILTER (c_nationkey = 3) AS a,
                    count(*) FILTER (c_mktsegment = 'BUILDING') AS b FROM customer"""


@query(
    "missing_data",
    f"""WITH s AS ({MISSING})
        SELECT 'c_custkey' AS column_name, 0 AS total, 0.0 AS percent, 'bigint' AS type FROM s
        UNION ALL SELECT 'balance', a, round(100.0 * a / n, 6), 'double' FROM s
        UNION ALL SELECT 'segment', b, round(100.0 * b / n, 6), 'string' FROM s""",
)
def _missing_data(t: Tables):
    rows = t.customer.select(
        "c_custkey",
        F.when(F.col("c_nationkey") != 3, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
    )
    return profile.missing_data(rows).withColumn("percent", F.round("percent", 6))


@query(
    "unique_values",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS total, count(DISTINCT {c}) AS uniques FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    ),
)
def _unique_values(t: Tables):
    return profile.unique_values(t.orders)


@query("unique_values_approximate")
def _unique_values_approximate(t: Tables):
    return profile.unique_values(t.orders, approximate=True)


def _top_of(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, sum(n)::BIGINT AS total, min_by(v, (-n, v)) AS most_frequent,
               max(n) AS frequency, round(100.0 * max(n) / sum(n), 3) AS percent
               FROM (SELECT {c}::VARCHAR AS v, count(*) AS n FROM events WHERE {c} IS NOT NULL GROUP BY 1)"""


@query("most_frequent_values", " UNION ALL ".join(_top_of(c) for c in ("user_id", "event_type", "props")))
def _most_frequent_values(t: Tables):
    return profile.most_frequent_values(t.events.select("user_id", "event_type", "props"))


def _describe_sql(c: str) -> str:
    quarters = ", ".join(f"round(quantile_cont({c}, {p}), 6) AS q{int(p * 100)}" for p in (0.25, 0.5, 0.75))
    return f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean,
               round(stddev_samp({c}), 4) AS std, min({c}) AS min, {quarters}, max({c}) AS max FROM lineitem"""


MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("describe", " UNION ALL ".join(_describe_sql(c) for c in MEASURES))
def _describe(t: Tables):
    found = profile.describe(t.lineitem, MEASURES)
    rounded = {c: F.round(c, 4) for c in ("mean", "std")} | {c: F.round(c, 6) for c in ("q25", "q50", "q75")}
    return found.withColumns(rounded)


@query(
    "schema_info",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{k}' AS type, count({c}) AS non_null, count(*) AS n_rows, 6 AS n_columns FROM part"
        for i, (c, k) in enumerate(
            [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]
        )
    ),
)
def _schema_info(t: Tables):
    return profile.schema_info(t.part)


@query(
    "top_value_share",
    """SELECT user_id, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM events), 6) AS percent
       FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 20""",
)
def _top_value_share(t: Tables):
    return profile.top_value_share(t.events, "user_id").withColumn("percent", F.round("percent", 6))


@query(
    "class_share",
    """SELECT lang, count(*) AS n, round(count(*) / (SELECT count(lang) FROM documents), 6) AS share
       FROM documents WHERE lang IS NOT NULL GROUP BY lang""",
)
def _class_share(t: Tables):
    return profile.class_share(t.documents, "lang").withColumn("share", F.round("share", 6))


@query("category_counts", "SELECT label, count(*) AS n FROM embeddings GROUP BY label")
def _category_counts(t: Tables):
    return profile.category_counts(t.embeddings, "label")


@query("drop_exact_duplicates", "SELECT DISTINCT lang, source FROM documents")
def _drop_exact_duplicates(t: Tables):
    return t.documents.select("lang", "source").dropDuplicates()


@query("distinct_values", "SELECT DISTINCT p_brand FROM part")
def _distinct_values(t: Tables):
    return t.part.select("p_brand").distinct()


@query(
    "zscore_outliers",
    """SELECT event_id, value FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
       WHERE abs(value - m) > 1.5 * s""",
)
def _zscore_outliers(t: Tables):
    return profile.zscore_outliers(t.events, "value").select("event_id", "value")


@query(
    "zscore_outliers_dates",
    """SELECT o_orderkey FROM orders,
       (SELECT avg(epoch(o_orderdate)) AS m, stddev_samp(epoch(o_orderdate)) AS s FROM orders)
       WHERE abs(epoch(o_orderdate) - m) > 1.5 * s""",
)
def _zscore_outliers_dates(t: Tables):
    return profile.zscore_outliers(t.orders, "o_orderdate").select("o_orderkey")


@query(
    "range_outliers",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_quantity > 45 THEN 'high' ELSE 'low' END AS side
       FROM lineitem WHERE l_quantity > 45 OR l_quantity < 5""",
)
def _range_outliers(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return profile.range_outliers(rows, "l_quantity", 5, 45)


@query(
    "factorize",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN -1 ELSE code END AS code FROM events
       LEFT JOIN (SELECT event_type AS k, row_number() OVER (ORDER BY min(event_id)) - 1 AS code
                  FROM events WHERE event_type <> 'error' GROUP BY event_type) ON event_type = k""",
)
def _factorize(t: Tables):
    site = F.when(F.col("event_type") != "error", F.col("event_type"))
    return shape.factorize(t.events.select("event_id", site.alias("site")), "site", "event_id").select("event_id", "code")


@query(
    "factorize_many",
    """SELECT event_id, code FROM events JOIN (SELECT user_id AS k, row_number() OVER (ORDER BY min(event_id)) - 1 AS code
       FROM events GROUP BY user_id) ON user_id = k""",
)
def _factorize_many(t: Tables):
    return shape.factorize(t.events.select("event_id", "user_id"), "user_id", "event_id").select("event_id", "code")


@query(
    "top_n_per_group",
    """SELECT c_mktsegment, c_custkey, c_acctbal, rank FROM (SELECT *, row_number() OVER
       (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) WHERE rank <= 10""",
)
def _top_n_per_group(t: Tables):
    rows = t.customer.select("c_mktsegment", "c_custkey", "c_acctbal")
    return shape.top_n_per_group(rows, ["c_mktsegment"], 10, "c_acctbal", ["c_custkey"])


@query("last_n", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey DESC LIMIT 10")
def _last_n(t: Tables):
    return shape.last_n(t.orders, ["o_orderkey"], 10, F.col("o_orderstatus") == "O").select("o_orderkey", "o_totalprice")


@query("first_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def _first_n(t: Tables):
    return shape.first_n(t.orders, ["o_orderkey"], 5).select("o_orderkey", "o_totalprice")


@query("sort_by", "SELECT c_nationkey, c_custkey FROM customer ORDER BY c_nationkey, c_custkey")
def _sort_by(t: Tables):
    return t.customer.select("c_nationkey", "c_custkey").orderBy(F.asc("c_nationkey"), F.asc("c_custkey"))


@query("limit_rows", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 600")
def _limit_rows(t: Tables):
    return t.customer.select("c_custkey", "c_name").orderBy("c_custkey").limit(600)


@query("argmax_label", "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS best FROM embeddings")
def _argmax_label(t: Tables):
    return shape.argmax_label(t.embeddings, "embedding").select("vec_id", "best")


@query(
    "append_rows",
    """SELECT doc_id, quality, toxic FROM labels WHERE quality = 1
       UNION ALL SELECT doc_id, quality, NULL FROM labels WHERE quality = 0""",
)
def _append_rows(t: Tables):
    return shape.append_rows(t.labels.filter("quality = 1"), t.labels.filter("quality = 0").select("quality", "doc_id"))


@query(
    "append_tables",
    """SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier UNION ALL SELECT p_name FROM part""",
)
def _append_tables(t: Tables):
    parts = [(t.customer, "c_name"), (t.supplier, "s_name"), (t.part, "p_name")]
    return shape.append_tables([df.select(F.col(c).alias("name")) for df, c in parts])
