"""Chunks, vector search and prompts."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from quern.common import broadcast_if_small, fits

# Queries up to this count are held by every task; more are matched block by block.
QUERY_LIMIT = 4096
BLOCK_ROWS = 32_768
# Runs of columns in which the least distance is looked for.
RUNS = 64
# Texts cut into chunks at once.
CHUNKED_TEXTS = 200


def chunk_fixed(df: DataFrame, text: str, size: int = 300) -> DataFrame:
    """Consecutive slices of ``size`` characters, the last one shorter; empty text gives none.

    One regular expression walks each text once, where repeated ``substring`` calls would start
    from the beginning every time.
    """
    slices = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.posexplode(slices).alias("chunk_no", "chunk"))


def _pieces(text: str, mark: str) -> list[str]:
    """Parts of ``text``, each later one starting with the mark that opened it."""
    if not mark:
        return list(text)
    head, *rest = text.split(mark)
    return [p for p in [head, *[mark + r for r in rest]] if p]


def _packed(parts: list[str], size: int, overlap: int) -> Iterator[str]:
    """Join parts up to ``size``, carrying up to ``overlap`` characters into the next chunk."""
    window: deque[str] = deque()
    length = 0
    for part in parts:
        if window and length + len(part) > size:
            yield "".join(window).strip()
            while window and (length > overlap or length + len(part) > size):
                length -= len(window.popleft())
        window.append(part)
        length += len(part)
    yield "".join(window).strip()


def split_text(text: str, size: int, overlap: int, marks: Sequence[str] = ("\n\n", "\n", " ", "")) -> list[str]:
    """Chunks cut at the coarsest mark that keeps them within ``size``."""
    at = next((i for i, m in enumerate(marks) if m in text), len(marks) - 1)
    out: list[str] = []
    short: list[str] = []
    for part in _pieces(text, marks[at]):
        if len(part) < size:
            short.append(part)
            continue
        if short:
            out.extend(_packed(short, size, overlap))
            short = []
        if at + 1 < len(marks):
            out.extend(split_text(part, size, overlap, marks[at + 1 :]))
        else:
            out.append(part)
    if short:
        out.extend(_packed(short, size, overlap))
    return [c for c in out if c]


def chunk_overlap(df: DataFrame, text: str, size: int = 500, overlap: int = 50) -> DataFrame:
    """Chunks of at most ``size`` characters cut at paragraph, line or word ends, with overlap.

    Chunks leave a task ``CHUNKED_TEXTS`` texts at a time, so that it never holds those of a whole batch.
    """
    kept = [c for c in df.columns if c != text]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNKED_TEXTS):
                part = batch.slice(start, CHUNKED_TEXTS)
                chunks = [[] if t is None else split_text(t, size, overlap) for t in part.column(len(kept)).to_pylist()]
                rows = pa.array(np.repeat(np.arange(len(chunks)), [len(c) for c in chunks]))
                numbers = pa.array([i for c in chunks for i in range(len(c))], pa.int32())
                found = [*(part.column(i).take(rows) for i in range(len(kept))), numbers, pa.array([x for c in chunks for x in c], pa.string())]
                yield pa.RecordBatch.from_arrays(found, [*kept, "chunk_no", "chunk"])

    schema = StructType([*df.select(*kept).schema.fields, StructField("chunk_no", IntegerType()), StructField("chunk", StringType())])
    return df.select(*kept, text).mapInArrow(cut, schema)


def store_vectors(df: DataFrame, path: str) -> DataFrame:
    """Persist chunk vectors as a parquet table."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matrix(vectors) -> np.ndarray:
    return np.array(list(vectors), dtype=np.float64)


def _vectors(rows: pa.Table) -> np.ndarray:
    """Vectors as rows of a matrix; they are of one length."""
    vec = rows["vec"].combine_chunks()
    width = pc.unique(pc.list_value_length(vec)).to_pylist()
    if len(width) != 1:
        raise ValueError("vectors of several lengths")
    return vec.flatten().to_numpy().reshape(len(vec), width[0])


def _edges(rough: np.ndarray, k: int) -> np.ndarray:
    """A bound that at least ``k`` numbers of each row keep, and few others.

    It is the ``k``-th least of the least numbers of ``RUNS`` runs of columns, found in one pass; where there are few columns,
    the ``k``-th least number itself.
    """
    near, runs = min(k, rough.shape[1]) - 1, max(RUNS, 4 * k)
    width = rough.shape[1] // runs
    if width < 8:
        return np.partition(rough, near, axis=1)[:, near]
    least = np.fmin.reduce(rough[:, : runs * width].reshape(len(rough), runs, width), axis=2)
    edge = np.partition(least, near, axis=1)[:, near]
    return np.where(np.isnan(edge), np.inf, edge)


def _closest(q_ids, q, s_ids, s, k, q_fold=None, s_fold=None):
    """The ``k`` closest rows of ``s`` for each row of ``q`` as three arrays.

    Squared distances from one matrix product pick the candidates, with a margin for rounding;
    these are measured again by plain differences, so that exact hits have distance zero.
    """
    qq, ss = (q * q).sum(1), (s * s).sum(1)
    left, right, dist = [], [], []
    twice = -2.0 * s.T
    for start in range(0, len(q), 256):
        part = slice(start, start + 256)
        rough = q[part] @ twice
        rough += ss
        rough += qq[part, None]
        if q_fold is not None:
            rough[q_fold[part, None] == s_fold[None, :]] = np.inf
        edge = _edges(rough, k)
        margin = 1e-9 * (qq[part] + ss.max()) + 1e-12
        rows, cols = np.nonzero(rough <= (edge + margin)[:, None])
        finite = np.isfinite(rough[rows, cols])
        rows, cols = rows[finite], cols[finite]
        exact = np.sqrt(((q[part][rows] - s[cols]) ** 2).sum(1))
        order = np.lexsort((s_ids[cols], exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        starts = np.searchsorted(rows, np.arange(len(edge)))
        keep = np.arange(len(rows)) - starts[rows] < k
        left.append(q_ids[part][rows[keep]])
        right.append(s_ids[cols[keep]])
        dist.append(exact[keep])
    return np.concatenate(left), np.concatenate(right), np.concatenate(dist)


def _frame(found) -> pd.DataFrame:
    return pd.DataFrame({"query_id": found[0], "store_id": found[1], "distance": found[2]})


HITS = "query_id bigint, store_id bigint, distance double"


def _renamed(df: DataFrame, id_col: str, vec: str, fold: str | None) -> DataFrame:
    """Ids and vectors; a null vector, or one with a number that is null, NaN or infinite, takes no part."""
    folds = [] if fold is None else [F.col(fold).cast("int").alias("fold")]
    df = df.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("vec"), *folds
    )
    finite = F.forall("vec", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return df.filter(F.coalesce(finite, F.lit(False)))


def _by_broadcast(store: DataFrame, queries: DataFrame, k: int, folded: bool) -> DataFrame:
    """Every task holds all queries and reports its own ``k`` best; the store is not shuffled."""
    rows = queries.collect()
    if not rows:
        return store.sparkSession.createDataFrame([], HITS)
    held = store.sparkSession.sparkContext.broadcast(
        (
            np.array([r["id"] for r in rows], dtype=np.int64),
            _matrix(r["vec"] for r in rows),
            np.array([r["fold"] for r in rows]) if folded else None,
        )
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vectors, folds = held.value
        best = None
        for batch in batches:
            if not len(batch):
                continue
            s_fold = batch["fold"].to_numpy() if folded else None
            found = _closest(ids, vectors, batch["id"].to_numpy(), _matrix(batch["vec"]), k, folds, s_fold)
            frame = _frame(found)
            best = frame if best is None else pd.concat([best, frame], ignore_index=True)
            best = best.sort_values(["query_id", "distance", "store_id"])
            best = best[best.groupby("query_id").cumcount() < k]
        if best is not None:
            yield best

    return store.mapInPandas(search, HITS)


def _by_blocks(
    store: DataFrame,
    queries: DataFrame,
    k: int,
    folded: bool,
    keys: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Match blocks of queries with blocks of the store; a task sees one block of each.

    ``keys`` restrict the search to rows of equal key. The number of blocks follows from the row
    counts, so a key that holds most rows is spread over many tasks, and a task reports only its ``k``
    best per query, not the pairs. All pairs of blocks are visited, which keeps the result exact.
    """

    def blocks(df: DataFrame, name: str) -> DataFrame | int:
        n = F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int")
        if not keys:
            return df.agg(n.alias(name)).first()[name]
        # Only crowded keys need an entry: at most one per ``block_rows`` rows.
        return broadcast_if_small(df.groupBy(*keys).agg(n.alias(name)).filter(F.col(name) > 1))

    n_store, n_query = blocks(store, "_ns"), blocks(queries, "_nq")

    def numbered(df: DataFrame, own, own_name: str, other, other_name: str) -> tuple[DataFrame, object, object]:
        if not keys:
            return df, F.lit(max(own, 1)), F.lit(max(other, 1))
        df = df.join(own, list(keys), "left").join(other, list(keys), "left")
        return df, F.coalesce(own_name, F.lit(1)), F.coalesce(other_name, F.lit(1))

    def spread(df, own, own_name, own_block, other, other_name, other_block):
        df, own_n, other_n = numbered(df, own, own_name, other, other_name)
        return (
            df.withColumn(own_block, F.pmod(F.xxhash64("id"), own_n).cast("int"))
            .withColumn(other_block, F.explode(F.sequence(F.lit(0), other_n - 1)))
            .drop(own_name, other_name)
            .groupBy(*keys, "_qb", "_sb")
        )

    left = spread(queries, n_query, "_nq", "_qb", n_store, "_ns", "_sb")
    right = spread(store, n_store, "_ns", "_sb", n_query, "_nq", "_qb")

    def search(q: pa.Table, s: pa.Table) -> pa.Table:
        if not len(q) or not len(s):
            return pa.table({"query_id": pa.array([], pa.int64()), "store_id": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})
        folds = (q["fold"].to_numpy(), s["fold"].to_numpy()) if folded else (None, None)
        q_ids, s_ids = q["id"].to_numpy(), s["id"].to_numpy()
        left, right, dist = _closest(q_ids, _vectors(q), s_ids, _vectors(s), k, *folds)
        # A missing id came as NaN.
        left, right = (pa.array(x, pa.int64(), from_pandas=True) for x in (left, right))
        return pa.table({"query_id": left, "store_id": right, "distance": dist})

    return left.cogroup(right).applyInArrow(search, HITS)


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("distance", "store_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(
    store: DataFrame,
    queries: DataFrame,
    k: int = 3,
    store_id: str = "vec_id",
    query_id: str = "query_id",
    vec: str = "embedding",
    fold: str | None = None,
    query_limit: int = QUERY_LIMIT,
) -> DataFrame:
    """Exact ``k`` nearest stored vectors by Euclidean distance: ``(query_id, store_id, distance, rank)``.

    With ``fold`` a query is never matched with rows of its own fold. Stored vectors and queries that are null or
    hold a number that is not finite are left out.
    """
    s = _renamed(store, store_id, vec, fold)
    q = _renamed(queries, query_id, vec, fold)
    way = _by_broadcast if fits(q, query_limit) else _by_blocks
    return _best(way(s, q, k, fold is not None), k)


def nearest_approx(
    store: DataFrame,
    queries: DataFrame,
    k: int = 3,
    store_id: str = "vec_id",
    query_id: str = "query_id",
    vec: str = "embedding",
    bucket_length: float = 1.0,
    tables: int = 4,
    seed: int = 42,
) -> DataFrame:
    """``k`` nearest among the rows that share a hash bucket in at least one of ``tables`` tables.

    For two large sides. A crowded bucket is cut into blocks like the exact search, and no task
    lists the pairs of a bucket.
    """
    s = _renamed(store, store_id, vec, None)
    q = _renamed(queries, query_id, vec, None)
    # Fitting draws the random directions and only needs the width of a vector.
    hasher = BucketedRandomProjectionLSH(
        inputCol="_v", outputCol="_h", bucketLength=bucket_length, numHashTables=tables, seed=seed
    ).fit(s.limit(1).withColumn("_v", array_to_vector("vec")))

    def hashed(df: DataFrame) -> DataFrame:
        return (
            hasher.transform(df.withColumn("_v", array_to_vector("vec")))
            .select("id", "vec", F.posexplode("_h").alias("_t", "_hv"))
            .select("id", "vec", "_t", vector_to_array("_hv")[0].cast("bigint").alias("_b"))
        )

    hits = _by_blocks(hashed(s), hashed(q), k, False, ["_t", "_b"]).distinct()
    return _best(hits, k)


# The text of a prompt.
PROMPT = "Context:\n{context}\n\nQuestion:\n{question}\n\nAnswer using only the context above."


def build_prompt(
    hits: DataFrame, question_key: Sequence[str], question: str, text: str, rank: str = "rank"
) -> DataFrame:
    """One prompt per question from its ranked texts, joined by line breaks.

    A question has at most ``k`` hits, so a group stays small.
    """
    context = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(rank, text))), lambda s: s[text]), "\n"
    )
    head, rest = PROMPT.split("{context}")
    middle, tail = rest.split("{question}")
    return (
        hits.groupBy(*question_key, question)
        .agg(context.alias("_context"))
        .withColumn(
            "prompt",
            F.concat(F.lit(head), "_context", F.lit(middle), F.col(question), F.lit(tail)),
        )
        .drop("_context")
    )
