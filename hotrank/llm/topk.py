"""Exact top-k search by term-at-a-time accumulation over blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hotrank.llm.common import pick, read

#: Rows a block of candidates and of queries aims at; a task scores one pair of blocks.
ROWS, QUERIES = 4096, 512
#: Queries whose scores are added up at a time: few enough that these stay in a core's cache.
TILE = 16


def sound(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` (doubles) without vectors that are null or hold null, NaN or infinity.

    Repeated ids are one entry: the smallest vector stands.
    """
    rows = pick(vectors, vec_id=id_col, vector=vector_col).select(
        "vec_id", F.col("vector").cast("array<double>").alias("vector")
    )
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.where(F.col("vec_id").isNotNull() & good)
        .groupBy("vec_id").agg(F.min("vector").alias("vector"))
    )


def blocks(rows: DataFrame, size: int, kind: str, block: str, total: int) -> DataFrame:
    """``block, ids, items``: the rows as matrices of about ``size`` rows, dealt by hash of the id.

    Vectors of several lengths are filled up with zeros. ``kind`` is a numpy type.
    """
    count = max(1, -(-total // size))

    def pack(keys, table):
        ids = table.column("vec_id").to_numpy()
        lists = table.column("vector").combine_chunks()
        widths = lists.value_lengths().to_numpy()
        width = int(widths.max(initial=0))
        values = np.zeros((len(ids), width), kind)
        values[np.arange(width)[None] < widths[:, None]] = lists.flatten().to_numpy()
        order = np.argsort(ids, kind="stable")
        return pa.table({
            block: pa.array([keys[0].as_py()], pa.int32()),
            "ids": pa.array([ids[order].astype(np.int64).tobytes()], pa.binary()),
            "items": pa.array([values[order].tobytes()], pa.binary()),
        })

    dealt = F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    return rows.withColumn(block, dealt).groupBy(block).applyInArrow(
        pack, f"{block} int, ids binary, items binary"
    )


def matrix(ids: bytes, items: bytes, kind: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(items, kind).reshape(len(ids), -1)


def paired(
    candidates: DataFrame, queries: DataFrame, n_queries: int, n_rows: int, q_size: int, c_size: int
) -> DataFrame:
    """Each block of queries with each block of candidates: joined on the pair's own key."""
    q_count, c_count = max(1, -(-n_queries // q_size)), max(1, -(-n_rows // c_size))
    left = candidates.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_count - 1))))
    right = queries.select(
        "q_block", F.col("ids").alias("q_ids"), F.col("items").alias("q_items")
    ).withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(c_count - 1))))
    return left.join(right, ["q_block", "c_block"])


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids; ``ids`` ascend."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > cut)
        places = np.concatenate([above, np.flatnonzero(scores == cut)[: k - len(above)]])
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of what the blocks found."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def accumulated(postings: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Scores of each query with each candidate; ``postings``: candidates' weights, by term.

    Term at a time: a term's posting adds to the scores of all queries that ask for it. Where most
    weights are none, only places with weight are added to.
    """
    scores = np.zeros((len(queries), postings.shape[1]), postings.dtype)
    added = np.empty_like(scores)
    for weights, asked in zip(postings, queries.T):
        if not asked.any():
            continue
        at = np.flatnonzero(weights) if np.count_nonzero(weights) * 8 < len(weights) else None
        if at is None:
            np.multiply(asked[:, None], weights[None], out=added)
            np.add(scores, added, out=scores)
        elif len(at):
            scores[:, at] += asked[:, None] * weights[at]
    return scores


def best_of_tile(
    q_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each query's ``k`` highest scores but its own, ties to smaller ids."""
    n = scores.shape[1]
    if n > k + 1:
        # One more than asked for: the query's own may be among them.
        cut = np.partition(scores, n - k - 1, axis=1)[:, n - k - 1]
        rows, columns = np.nonzero(scores >= cut[:, None])
    else:
        rows, columns = np.nonzero(np.ones(scores.shape, bool))
    other = ids[columns] != q_ids[rows]
    rows, columns = rows[other], columns[other]
    # The complement falls as the score rises, and does not overflow.
    order = np.lexsort((ids[columns], ~scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    first = np.searchsorted(rows, np.arange(len(q_ids)))
    keep = np.arange(len(rows)) - first[rows] < k
    return rows[keep], columns[keep]


def _scatter(k: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, items = matrix(row["ids"], row["items"], "int64")
                q_ids, q_items = matrix(row["q_ids"], row["q_items"], "int64")
                width = min(items.shape[1], q_items.shape[1])
                peak = math.prod(
                    max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (items, q_items))
                kind = np.int32 if peak * max(width, 1) < 1 << 31 else np.int64
                postings = np.ascontiguousarray(items[:, :width].T, kind)
                asked = q_items[:, :width].astype(kind)
                found = []
                for start in range(0, len(q_ids), TILE):
                    tile = q_ids[start : start + TILE]
                    scores = accumulated(postings, asked[start : start + TILE])
                    rows, columns = best_of_tile(tile, ids, scores, k)
                    found.append((tile[rows], ids[columns], scores[rows, columns].astype(np.int64)))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in zip(*found)],
                        names=["query_id", "vec_id", "score"],
                    )

    return run


def top_products(
    vectors: DataFrame, every: int = 20, k: int = 20, scale: float = 64.0,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products, exactly.

    Components become floor(scale * x). Queries are the rows whose id ``every`` divides;
    candidates all but the query's own. A block's postings are its non-zero weights by
    component; each adds query weight times posting weight into dense arrays of scores, from
    which a partition selects the best. Blocks meet pairwise and their best are merged, so a
    task holds two blocks and ``ROWS`` x ``TILE`` scores whatever the input. Vectors null, or with null or
    non-finite components take no part; empty vectors score 0; shorter ones lack the rest.
    Ties go to the smaller id. Components past 2**63 are cut to it, and sums beyond wrap.
    """
    rows = sound(vectors, id_col, vector_col).withColumn(
        "vector", F.transform("vector", lambda x: F.floor(x * F.lit(scale)).cast("long"))
    )
    asked = rows.where(F.col("vec_id") % every == 0)
    n_rows, n_queries = rows.count(), asked.count()
    pairs = paired(
        blocks(rows, ROWS, "int64", "c_block", n_rows),
        blocks(asked, QUERIES, "int64", "q_block", n_queries),
        n_queries, n_rows, QUERIES, ROWS,
    )
    found = pairs.select("ids", "items", "q_ids", "q_items").mapInArrow(
        _scatter(k), "query_id long, vec_id long, score long"
    )
    return ranked(found, k)


def op3_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(read(spark, folder, "embeddings"))

