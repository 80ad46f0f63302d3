"""Queries over sources and sinks. Files are written from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.common import scratch_path
from quern.plans.registry import Tables, query
from quern.sinks import tables as sinks
from quern.sources import files, images, tables, workbooks

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
EVENT = "event_id bigint, user_id bigint, event_type string"


@query("read_csv", "SELECT * FROM customer")
def _read_csv(t: Tables):
    path = scratch_path(t.spark, "csv")
    sinks.write_text_table(t.customer, path)
    return files.read_csv(t.spark, path, CUSTOMER)


@query("read_csv_inferred", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _read_csv_inferred(t: Tables):
    path = scratch_path(t.spark, "csv")
    first = F.col("p_partkey").alias(files.BYTE_ORDER_MARK + "p_partkey")
    sinks.write_text_table(t.part.select(first, *[c for c in t.part.columns if c != "p_partkey"]), path)
    return files.read_csv(t.spark, path)


@query("read_json_any", "SELECT event_id, user_id, event_type FROM events")
def _read_json_any(t: Tables):
    path = scratch_path(t.spark, "json")
    t.events.select("event_id", "user_id", "event_type").write.json(path)
    return files.read_json_any(t.spark, path, EVENT)


@query("json_documents", "SELECT event_id, user_id, event_type FROM events")
def _json_documents(t: Tables):
    record = F.to_json(F.struct("event_id", "user_id", "event_type"))
    kind = F.col("event_type")
    document = (
        F.when(kind == "click", F.concat(F.lit("[\n "), record, F.lit("\n]")))
        .when(kind == "view", F.concat(F.lit('{"data": ['), record, F.lit("]}")))
        .when(kind == "error", F.concat(F.lit('{"count": 1,\n "results": ['), record, F.lit("]}")))
        .when(kind == "signup", F.concat(F.lit('{"data": 3, "items": ['), record, F.lit("]}")))
        .otherwise(record)
    )
    return files.json_documents(t.events.select(document.alias("value")), EVENT)


@query(
    "read_images",
    """SELECT p_brand AS label, 'bmp' AS format, 4 AS width, count(*)::INTEGER AS height, 55 + 12 * count(*) AS size_bytes
       FROM part GROUP BY p_brand""",
)
def _read_images(t: Tables):
    """A picture per brand with a line of four pixels for each of its parts; then all pictures are read."""

    def little_endian(c):
        return F.concat(*[F.lpad(F.hex(F.shiftright(c, 8 * i).bitwiseAND(255)), 2, "0") for i in range(4)])

    shade = F.lpad(F.hex(F.col("p_size")), 2, "0")
    lines = F.array_join(F.sort_array(F.collect_list(F.struct("p_partkey", F.repeat(shade, 12).alias("line"))))["line"], "")
    n = F.count(F.lit(1))
    head = F.concat(
        F.lit("424D"), little_endian(n * 12 + 54), F.lit("0000000036000000" + "28000000" + "04000000"), little_endian(n),
        F.lit("01001800" + "00" * 24),
    )
    path = scratch_path(t.spark, "pictures")
    pictures = t.part.groupBy("p_brand").agg(F.unhex(F.concat(head, lines)).cast("string").alias("value"))
    # The text writer adds a line feed, which picture readers pass over.
    pictures.write.partitionBy("p_brand").text(path)
    label = F.regexp_replace(F.regexp_extract("path", "p_brand=([^/]+)/", 1), "%23", "#")
    return images.read_images(t.spark, path, None).select(label.alias("label"), "format", "width", "height", "size_bytes")


@query(
    "read_folder",
    """SELECT 'csv' AS kind, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer
       UNION ALL SELECT 'json', count(*), sum(event_id)::BIGINT FROM events""",
)
def _read_folder(t: Tables):
    path = scratch_path(t.spark, "folder")
    sinks.write_text_table(t.customer, f"{path}/lookups/customers")
    t.events.select("event_id", "user_id", "event_type").write.json(f"{path}/events")
    found = files.read_folder(t.spark, path, CUSTOMER, EVENT)
    return tables_summary(found)


def tables_summary(found):
    keys = {"csv": "c_custkey", "json": "event_id"}
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum(keys[kind]).alias("keys")).select(
            F.lit(kind).alias("kind"), "n", "keys"
        )
        for kind, df in sorted(found.items())
    ]
    return parts[0].unionByName(parts[1])


@query("read_workbooks", "SELECT c_nationkey, c_custkey, c_name, c_mktsegment FROM customer")
def _read_workbooks(t: Tables):
    people = t.customer.select("c_nationkey", "c_custkey", "c_name", "c_mktsegment")
    sheet = F.struct(
        F.col("c_nationkey").cast("string").alias("path"), F.lit("People").alias("sheet"), F.lit(0).alias("sheet_no"),
        (F.col("c_custkey") + 1).cast("int").alias("row_no"),
        F.array(*[F.col(c).cast("string") for c in people.columns], F.lit("outside the range")).alias("cells"),
    )
    notes = F.struct(F.lit("n").alias("path"), F.lit("Notes").alias("sheet"), F.lit(1).alias("sheet_no"), F.lit(1).alias("row_no"), F.array(F.lit("x")).alias("cells"))
    head = F.struct(F.lit("h").alias("path"), F.lit("People").alias("sheet"), F.lit(0).alias("sheet_no"), F.lit(0).alias("row_no"), F.array(F.lit("head")).alias("cells"))
    path = scratch_path(t.spark, "sheets")
    rows = people.select(F.explode(F.array(sheet, notes, head)).alias("r")).select("r.*").filter("sheet = 'People'")
    rows.unionByName(t.nation.select(notes.alias("r")).select("r.*")).write.json(path)
    named = workbooks.read_workbooks(t.spark, path, people.columns, columns="A:D")
    schema = T.StructType.fromDDL("c_nationkey int, c_custkey bigint, c_name string, c_mktsegment string")
    return tables.apply_schema(named, schema)


@query(
    "rows_to_frame",
    """SELECT o_orderkey::VARCHAR AS order_key, o_orderstatus AS status,
              CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS priority,
              CASE WHEN o_orderstatus = 'F' THEN 2 WHEN o_orderstatus = 'P' THEN 4 ELSE 3 END AS n_cells
       FROM orders""",
)
def _rows_to_frame(t: Tables):
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    cells = (
        F.when(status == "F", F.array(key, status))
        .when(status == "P", F.array(key, status, "o_orderpriority", F.lit("spare")))
        .otherwise(F.array(key, status, "o_orderpriority"))
    )
    return tables.rows_to_frame(t.orders.select(cells.alias("cells")), ["order_key", "status", "priority"])


@query(
    "from_rows",
    """SELECT o_orderkey, status_name FROM orders
       JOIN (VALUES ('O', 'open'), ('F', 'finished'), ('P', 'partial')) s(code, status_name)
       ON o_orderstatus = code""",
)
def _from_rows(t: Tables):
    names = tables.from_rows(t.spark, [("O", "open"), ("F", "finished"), ("P", "partial")], ["o_orderstatus", "status_name"])
    return t.orders.select("o_orderkey", "o_orderstatus").join(names, "o_orderstatus").drop("o_orderstatus")


@query(
    "apply_schema",
    """SELECT c_custkey AS id, c_name AS name, TRY_CAST(CASE WHEN c_nationkey = 7 THEN 'n/a'
              ELSE c_nationkey::VARCHAR END AS INTEGER) AS nation, c_acctbal AS balance FROM customer""",
)
def _apply_schema(t: Tables):
    text = t.customer.select(
        F.col("c_custkey").cast("string"),
        "c_name",
        F.when(F.col("c_nationkey") == 7, "n/a").otherwise(F.col("c_nationkey").cast("string")),
        F.col("c_acctbal").cast("string"),
    )
    schema = T.StructType.fromDDL("id bigint, name string, nation int, balance double")
    return tables.apply_schema(text, schema)


@query("load_table", "SELECT p_partkey, p_name, NULL::VARCHAR AS p_brand, p_size FROM part")
def _load_table(t: Tables):
    sinks.load_table(t.part.select("p_partkey", "p_name", "p_brand"), "quern_check", "parts")
    return sinks.load_table(
        t.part.select("p_partkey", "p_name", "p_size"), "quern_check", "parts", merge_schema=True
    ).select("p_partkey", "p_name", "p_brand", "p_size")


@query(
    "upsert_table",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
       UNION ALL SELECT o_orderkey, 'X', o_totalprice + 1 FROM orders WHERE o_orderstatus = 'P'
       UNION ALL SELECT -1 - o_orderkey, 'N', o_totalprice FROM orders WHERE o_orderstatus = 'F'""",
)
def _upsert_table(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = orders.filter("o_orderstatus = 'P'").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice")
    )
    added = orders.filter("o_orderstatus = 'F'").select(
        (-1 - F.col("o_orderkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice"
    )
    sinks.load_table(orders, "quern_check", "orders_store")
    return sinks.upsert_table(changed.union(added), "quern_check", "orders_store", ["o_orderkey"])


@query("save_table", "SELECT doc_id, lang, source, n_chars FROM documents")
def _save_table(t: Tables):
    rows = t.documents.select("doc_id", "lang", "source", "n_chars")
    path = scratch_path(t.spark, "saved")
    rows.write.mode("overwrite").option("path", path).saveAsTable("quern_saved_documents")
    return t.spark.table("quern_saved_documents")


@query("write_text_table", "SELECT c_custkey, c_name || ', \"' || c_mktsegment || '\"' AS note FROM customer")
def _write_text_table(t: Tables):
    path = scratch_path(t.spark, "text")
    note = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))
    sinks.write_text_table(t.customer.select("c_custkey", note.alias("note")), path, sep=";")
    return t.spark.read.schema("c_custkey bigint, note string").csv(path, header=True, sep=";", escape='"')


@query("write_per_key", "SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY event_type")
def _write_per_key(t: Tables):
    path = scratch_path(t.spark, "per-key")
    sinks.write_per_key(t.events.select("event_id", "event_type"), "event_type", path)
    back = t.spark.read.parquet(path)
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query(
    "class_folders",
    """SELECT p_partkey, p_brand AS label, (dense_rank() OVER (ORDER BY p_brand) - 1)::INTEGER AS label_index
       FROM part""",
)
def _class_folders(t: Tables):
    path = F.concat(F.lit("/train/"), "p_brand", F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".png"))
    labelled = images.class_folders(t.part.select("p_partkey", path.alias("path")))
    return labelled.select("p_partkey", "label", "label_index")
