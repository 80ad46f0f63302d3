"""Queries over chunks, vectors, prompts, table graphs, report messages and streams."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.common import materialize, scratch_path
from quern.operators import images, lineage, outbox, predict, retrieve
from quern.plans.registry import Tables, query
from quern.plans.topics_and_models import SCALED
from quern.sinks import tables as sinks
from quern.streaming import feeds

# ---- chunks


@query(
    "chunk_fixed",
    """SELECT doc_id, i AS chunk_no, substring(text, 1 + 300 * i::INTEGER, 300) AS chunk
       FROM documents, unnest(range(ceil(length(text) / 300.0)::BIGINT)) r(i)""",
)
def _chunk_fixed(t: Tables):
    return retrieve.chunk_fixed(t.texts("text"), "text")


@query("chunk_overlap")
def _chunk_overlap(t: Tables):
    return retrieve.chunk_overlap(t.texts("text"), "text")


# ---- vectors; the questions are the mean vectors of the classes

CENTRES = """SELECT label, list(m ORDER BY i) AS c FROM
  (SELECT label, i, round(avg(embedding[i + 1]::DOUBLE), 9) AS m FROM embeddings, unnest(range(64)) r(i) GROUP BY label, i) GROUP BY label"""
DISTANCE = "sqrt(list_sum(list_transform(range(1, 65), lambda i: (e.embedding[i]::DOUBLE - c[i]) ** 2)))"
NEAREST = f"""SELECT label, vec_id, d, row_number() OVER (PARTITION BY label ORDER BY d, vec_id) AS rank
  FROM (SELECT q.label, e.vec_id, {DISTANCE} AS d FROM embeddings e, ({CENTRES}) q)"""


def _centres(t: Tables):
    parts = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 9).alias("m"))
    whole = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("v"))
    return whole.select(F.col("label").alias("query_id"), F.transform("v", lambda s: s["m"]).alias("embedding"))


@query("store_vectors", "SELECT vec_id, label, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings")
def _store_vectors(t: Tables):
    stored = retrieve.store_vectors(t.embeddings, scratch_path(t.spark, "vectors"))
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return stored.select("vec_id", "label", F.round(total, 6).alias("total"))


def _nearest(t: Tables, query_limit: int):
    hits = retrieve.nearest(t.embeddings, _centres(t), 3, query_limit=query_limit)
    return hits.select("query_id", "store_id", F.round("distance", 6).alias("distance"), "rank")


NEAREST_3 = f"SELECT label AS query_id, vec_id AS store_id, round(d, 6) AS distance, rank FROM ({NEAREST}) WHERE rank <= 3"


@query("nearest", NEAREST_3)
def _nearest_broadcast(t: Tables):
    return _nearest(t, retrieve.QUERY_LIMIT)


@query("nearest_blocks", NEAREST_3)
def _nearest_blocks(t: Tables):
    return _nearest(t, 0)


@query("nearest_approx")
def _nearest_approx(t: Tables):
    return retrieve.nearest_approx(t.embeddings, t.embeddings, 3, query_id="vec_id")


@query(
    "build_prompt",
    f"""SELECT question, 'Context:' || chr(10) || string_agg(text, chr(10) ORDER BY rank) || chr(10) || chr(10) || 'Question:' || chr(10)
          || question || chr(10) || chr(10) || 'Answer using only the context above.' AS prompt
        FROM (SELECT 'What is class ' || label || '?' AS question, text, rank FROM ({NEAREST}) JOIN documents ON doc_id = vec_id WHERE rank <= 3)
        GROUP BY question""",
)
def _build_prompt(t: Tables):
    hits = retrieve.nearest(t.embeddings, _centres(t), 3).withColumnRenamed("store_id", "doc_id")
    asked = F.concat(F.lit("What is class "), F.col("query_id").cast("string"), F.lit("?"))
    texts = hits.join(t.documents.select("doc_id", "text"), "doc_id").withColumn("question", asked)
    return retrieve.build_prompt(texts, ["query_id"], "question", "text").select("question", "prompt")


# ---- neighbours


@query(
    "knn_classify",
    f"""WITH h AS (SELECT n.label AS query_id, e.label, d, min(d) OVER (PARTITION BY n.label) AS nearest
                   FROM ({NEAREST}) n JOIN embeddings e USING (vec_id) WHERE rank <= 5),
             v AS (SELECT query_id, label, sum(CASE WHEN nearest = 0 THEN (d = 0)::INTEGER ELSE 1 / d END) AS w FROM h GROUP BY query_id, label)
        SELECT query_id, label FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY w DESC, label) AS k FROM v) WHERE k = 1""",
)
def _knn_classify(t: Tables):
    return predict.knn_classify(t.embeddings, _centres(t), 5)


@query(
    "knn_choose_k",
    """WITH c AS (SELECT label, count(*) AS n, min(vec_id) AS first FROM embeddings GROUP BY label),
         s AS (SELECT label, n, coalesce(sum(n) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM c),
         a AS (SELECT label, f, count(*) AS rows_in FROM s, unnest(range(start, start + n)) u(p), range(10) r(f) WHERE p % 10 = f GROUP BY label, f),
         e AS (SELECT label, f, sum(rows_in) OVER (PARTITION BY label ORDER BY f) AS upto, rows_in FROM a),
         o AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS place FROM embeddings),
         b AS (SELECT vec_id, o.label, v, f FROM o JOIN e ON o.label = e.label AND place < upto AND place >= upto - rows_in),
         h AS (SELECT * FROM (SELECT q.vec_id, q.label AS truth, q.f, x.label, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, x.v), x.vec_id) AS rank
               FROM b q JOIN b x ON q.f <> x.f) WHERE rank <= 20),
         w AS (SELECT k, vec_id, truth, f, label, count(*) AS n FROM h, range(1, 21) r(k) WHERE rank <= k GROUP BY ALL),
         p AS (SELECT k, f, truth, label FROM (SELECT *, row_number() OVER (PARTITION BY k, vec_id ORDER BY n DESC, label) AS best FROM w) WHERE best = 1)
       SELECT k::INTEGER AS k, round(avg(acc), 6) AS accuracy FROM (SELECT k, f, avg((truth = label)::INTEGER) AS acc FROM p GROUP BY k, f) GROUP BY k""",
)
def _knn_choose_k(t: Tables):
    return predict.knn_choose_k(t.embeddings).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "class_confidence",
    """SELECT vec_id, (list_position(v, list_max(v)) - 1)::INTEGER AS class_index,
              round(100 / list_sum(list_transform(v, lambda x: exp(x - list_max(v)))), 2) AS confidence
       FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 20) AS v FROM embeddings)""",
)
def _class_confidence(t: Tables):
    scores = F.transform("embedding", lambda x: x.cast("double") * 20)
    return images.class_confidence(t.embeddings.select("vec_id", scores.alias("s")), "s").drop("s")


@query("vector_classifier")
def _vector_classifier(t: Tables):
    rows = materialize(predict.split_train_test(t.embeddings, "vec_id"), "rows")
    model = images.vector_classifier(rows.filter("part = 'train'"), "embedding", "label", 10)
    scored = model.transform(rows.select("part", "label", array_to_vector("embedding").alias("features")))
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return scored.groupBy("part").agg(F.count(F.lit(1)).alias("n"), right.alias("accuracy"))


# ---- graph of reports (parts) and the tables they read

ENTRIES = """[p_type || ' (' || p_size || ')', p_type || ' (' || p_name || ')', ' ' || p_brand || ' ',
              CASE WHEN p_size > 25 THEN upper(p_brand) || '(size)' ELSE p_brand END, p_type || ' (' || p_size || ')']"""
EDGES = f"""SELECT src, i AS pos, trim(CASE WHEN contains(e, '(') THEN split_part(e, '(', 1) ELSE e END) AS dst,
    CASE WHEN contains(e, '(') THEN rtrim(split_part(e, '(', 2), ')') ELSE '' END AS column_name
  FROM (SELECT 'R' || p_partkey AS src, i, ({ENTRIES})[i + 1] AS e FROM part, range(5) r(i) WHERE p_size > 3)"""


def _reports(t: Tables):
    size = F.col("p_size").cast("string")
    entries = F.array(
        F.concat("p_type", F.lit(" ("), size, F.lit(")")),
        F.concat("p_type", F.lit(" ("), "p_name", F.lit(")")),
        F.concat(F.lit(" "), "p_brand", F.lit(" ")),
        F.when(F.col("p_size") > 25, F.concat(F.upper("p_brand"), F.lit("(size)"))).otherwise(F.col("p_brand")),
        F.concat("p_type", F.lit(" ("), size, F.lit(")")),
    )
    none = F.array().cast("array<string>")
    name = F.concat(F.lit("R"), F.col("p_partkey").cast("string"))
    return t.part.select(name.alias("report"), F.when(F.col("p_size") > 3, entries).otherwise(none).alias("entries"))


@query("relationship_edges", f"SELECT src, dst, column_name, pos FROM ({EDGES})")
def _relationship_edges(t: Tables):
    return lineage.relationship_edges(_reports(t)).withColumnRenamed("column", "column_name")


@query("graph_nodes", f"SELECT 'R' || p_partkey AS node FROM part UNION SELECT dst FROM ({EDGES})")
def _graph_nodes(t: Tables):
    reports = _reports(t)
    return lineage.graph_nodes(reports, lineage.relationship_edges(reports))


@query(
    "edge_labels",
    f"""SELECT src, dst, coalesce(max_by(column_name, pos) FILTER (column_name <> ''), '') AS label FROM ({EDGES}) GROUP BY src, dst""",
)
def _edge_labels(t: Tables):
    return lineage.edge_labels(lineage.relationship_edges(_reports(t)))


@query(
    "edge_labels_all",
    f"""SELECT src, dst, coalesce(string_agg(column_name, ', ' ORDER BY pos) FILTER (column_name <> ''), '') AS label
        FROM (SELECT src, dst, column_name, min(pos) AS pos FROM ({EDGES}) GROUP BY ALL) GROUP BY src, dst""",
)
def _edge_labels_all(t: Tables):
    return lineage.edge_labels(lineage.relationship_edges(_reports(t)), "all")


# ---- report messages: one per order, sent by the nation of its customer


def _groups(t: Tables):
    groups = t.region.select(F.col("r_regionkey").alias("group_id"), F.col("r_name").alias("display_name"))
    members = t.nation.select(F.col("n_regionkey").alias("group_id"), F.col("n_name").alias("user"))
    return groups, members


def _requests(t: Tables):
    address = F.concat(F.lower("c_name"), F.lit("@example.com"))
    cc = F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit("audit@example.com"))).otherwise(F.array().cast("array<string>"))
    kind = F.when(F.col("c_mktsegment") == "MACHINERY", "Text").otherwise("HTML")
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("message_id"),
        F.col("n_name").alias("sender"),
        F.concat(F.lit("Report for "), "c_name").alias("subject"),
        kind.alias("content_type"),
        F.lit("Balance: see attachment").alias("body"),
        F.array(address, F.lit("team@example.com")).alias("to_list"),
        cc.alias("cc_list"),
    )


@query(
    "allowed_senders",
    """SELECT o_orderkey, CASE WHEN r_name = 'ASIA' THEN 'ready' ELSE 'rejected' END AS state FROM orders
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def _allowed_senders(t: Tables):
    groups, members = _groups(t)
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("sender"))
    messages = t.orders.select("o_orderkey", "o_custkey").join(people, F.col("o_custkey") == F.col("c_custkey"))
    return outbox.allowed_senders(messages, groups, members, "ASIA").select("o_orderkey", "state")


PAYLOAD = """'{"message":{"subject":"Report for ' || c_name || '","body":{"contentType":"' ||
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Text' ELSE 'HTML' END || '","content":"Balance: see attachment"},"toRecipients":[{"emailAddress":{"address":"' ||
    lower(c_name) || '@example.com"}},{"emailAddress":{"address":"team@example.com"}}]' ||
    CASE WHEN c_mktsegment = 'BUILDING' THEN ',"ccRecipients":[{"emailAddress":{"address":"audit@example.com"}}]' ELSE '' END"""
END = """ || '},"saveToSentItems":true}'"""


@query("build_messages", f"SELECT c_custkey AS message_id, {PAYLOAD}{END} AS payload FROM customer")
def _build_messages(t: Tables):
    return outbox.build_messages(_requests(t)).select("message_id", "payload")


def _csv_of_nations() -> str:
    return """SELECT c_nationkey, part_no, count(*) AS n_rows,
      base64(encode('c_custkey,c_name' || chr(10) || string_agg(c_custkey || ',"' || c_name || ', ""' || c_mktsegment || '""' || '"', chr(10) ORDER BY c_custkey) || chr(10))) AS content
      FROM (SELECT *, ((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 20)::INTEGER AS part_no FROM customer)
      GROUP BY c_nationkey, part_no"""


@query(
    "table_attachment",
    f"""SELECT c_nationkey, part_no, n_rows, 'balances_' || c_nationkey || CASE WHEN part_no > 0 THEN '_' || (part_no + 1) ELSE '' END || '.csv' AS name,
               'text/csv' AS media_type, content FROM ({_csv_of_nations()})""",
)
def _table_attachment(t: Tables):
    named = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("c_name")
    rows = t.customer.select("c_nationkey", "c_custkey", named)
    files = outbox.table_attachment(rows, "c_nationkey", ["c_custkey"], "balances", rows_per_file=20)
    return files.select(
        "c_nationkey", "part_no", "n_rows", F.col("attachment.name").alias("name"), F.col("attachment.contentType").alias("media_type"),
        F.regexp_replace("attachment.contentBytes", r"\s", "").alias("content"),
    )


@query("file_attachments", "SELECT c_custkey, c_name FROM customer")
def _file_attachments(t: Tables):
    path = scratch_path(t.spark, "attachments")
    sinks.write_text_table(t.customer.select("c_custkey", "c_name"), f"{path}/reports")
    t.customer.select("c_name").write.text(f"{path}/notes")
    lines = F.split(F.decode(F.unbase64("attachment.contentBytes"), "UTF-8"), "\n")
    files = outbox.file_attachments(t.spark, path).filter(F.col("attachment.contentType") == "text/csv")
    cells = files.select(F.explode(F.slice(lines, 2, F.size(lines))).alias("line")).filter("line <> ''").select(F.split("line", ",").alias("c"))
    return cells.select(F.col("c")[0].cast("bigint").alias("c_custkey"), F.col("c")[1].alias("c_name"))


@query(
    "render_body",
    """SELECT o_orderkey, '<p>' || o_orderpriority || ' &amp; {month}, ' || monthname(o_orderdate - INTERVAL 1 MONTH) ||
         ': the figures are in.</p>' || chr(10) || '<p><a href="https://example.com/' || o_orderkey || '">Open</a></p>' || chr(10) AS body FROM orders""",
)
def _render_body(t: Tables):
    link = F.concat(F.lit("https://example.com/"), F.col("o_orderkey").cast("string"))
    rows = t.orders.withColumns({"link": link, "report": F.concat("o_orderpriority", F.lit(" & {month}"))})
    return outbox.render_body(rows, "report", "o_orderdate", "link").select("o_orderkey", "body")


ATTACHED = """',"attachments":[{"@odata.type":"#microsoft.graph.fileAttachment","name":"orders_' || c_custkey || '.csv","contentType":"text/csv","contentBytes":"' ||
    base64(encode('o_orderkey,o_orderstatus' || chr(10) || rows || chr(10))) || '"}]'"""


@query(
    "outbox",
    f"""SELECT c_custkey AS message_id, 0 AS message_no, n_name AS sender, CASE WHEN r_name = 'EUROPE' THEN 'ready' ELSE 'rejected' END AS state,
               CASE WHEN r_name = 'EUROPE' THEN {PAYLOAD} || coalesce({ATTACHED}, ''){END} END AS payload
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT o_custkey, string_agg(o_orderkey || ',' || o_orderstatus, chr(10) ORDER BY o_orderkey) AS rows
                   FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
)
def _outbox(t: Tables):
    groups, members = _groups(t)
    due = t.orders.select(F.col("o_custkey").alias("message_id"), "o_orderkey", "o_orderstatus")
    files = outbox.table_attachment(due, "message_id", ["o_orderkey"], "orders")
    sent = outbox.outbox(_requests(t), groups, members, "EUROPE", files)
    # Base64 text is wrapped at 76 characters; the comparison takes the line breaks out.
    return sent.withColumn("payload", F.replace("payload", F.lit("\\r\\n"), F.lit("")))


# ---- arrival-driven jobs


@query(
    "feedback_stream",
    """SELECT p_size + 150.0 AS Height_cm, p_retailprice AS Weight_kg, 'M' AS Size, false AS UserProvided, 6 AS Size_encoded FROM part
       UNION ALL SELECT c_nationkey + 160.0, c_acctbal, 'XL', true, 8 FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
)
def _feedback_stream(t: Tables):
    root = scratch_path(t.spark, "feedback")
    said = F.when(F.col("c_mktsegment") == "BUILDING", "xl").when(F.col("c_mktsegment") == "MACHINERY", "XL").otherwise("?")
    users = t.customer.select(
        (F.col("c_nationkey") + 160.0).alias("Height_cm"), F.col("c_acctbal").alias("Weight_kg"), said.alias("Size"), "c_mktsegment"
    )
    users.write.partitionBy("c_mktsegment").option("header", True).csv(f"{root}/landing")
    base = t.part.select(
        (F.col("p_size") + 150.0).alias("Height_cm"), F.col("p_retailprice").alias("Weight_kg"), F.lit("M").alias("Size")
    )

    def refit(rows: DataFrame):
        # The model of the new table and its accuracy there.
        cols = ["Height_cm", "Weight_kg"]
        known = predict.standardise(rows.where("Height_cm IS NOT NULL AND Weight_kg IS NOT NULL"), cols)
        known = predict.label_encode(known, "Size", name="label").withColumn("label", F.col("label").cast("double"))
        known = materialize(known, "known")
        model = predict.boosted_classifier(known, SCALED, "label")
        scored = model.transform(predict.features(known, SCALED))
        return model, scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]

    rows, _ = feeds.feedback_stream(
        t.spark, f"{root}/landing/*", f"{root}/store", f"{root}/progress", base, "Height_cm double, Weight_kg double, Size string", refit
    )
    return rows


@query(
    "landing_stream",
    """SELECT o_custkey, max(o_orderdate)::DATE AS last_day, max_by(o_totalprice, (o_orderdate, o_totalprice)) AS price
       FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_custkey""",
)
def _landing_stream(t: Tables):
    root = scratch_path(t.spark, "landing")
    rows = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("last_day"), F.col("o_totalprice").alias("price"), "o_orderpriority")
    # Days are dealt over the files, which come one per batch, so that later batches bring older versions.
    rows.repartition(4, F.dayofmonth("last_day") % 4).write.parquet(f"{root}/files")
    table = "landed_" + root.rsplit("-", 1)[1]
    return feeds.landing_stream(
        t.spark, f"{root}/files", "quern_check", table, f"{root}/progress",
        "o_custkey bigint, last_day date, price double, o_orderpriority string", ["o_custkey"],
        lambda batch: batch.filter("o_orderpriority <> '5-LOW'").drop("o_orderpriority"), version="last_day", files_per_batch=1,
    )
