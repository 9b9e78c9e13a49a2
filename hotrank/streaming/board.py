"""Where windowed scores of a stream end up: a versioned board, or an outside sorted set."""

from __future__ import annotations

from collections.abc import Callable
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotrank.functions.text import member_text, ranking_key
from hotrank.operators.leaderboard import (
    BOARD_SIZE,
    by_window,
    empty_board,
    fold_windows,
    window_ends,
)
from hotrank.schemas import BOARD, BOARD_COLUMNS
from hotrank.session import adaptive, send_by_value


class BoardTable:
    """Board kept as one Parquet folder per micro-batch that changed it.

    Batch ``b`` is computed from the newest finished version below ``b`` and written to its own
    folder, so running a batch again overwrites it with the same rows, and readers never see
    half a board: a version counts once its ``_SUCCESS`` file is there. ``keep`` bounds the
    number of old versions. A new checkpoint numbers its batches from zero, so it needs a
    new folder.
    """

    def __init__(self, path: str, n: int = BOARD_SIZE, keep: int = 20):
        self.path = path.rstrip("/")
        self.n = n
        self.keep = max(2, keep)

    def _filesystem(self, spark: SparkSession):
        sc = spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(sc._jsc.hadoopConfiguration()), folder

    def _version(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def versions(self, spark: SparkSession) -> list[int]:
        """Finished versions, oldest first."""
        fs, folder = self._filesystem(spark)
        if not fs.exists(folder):
            return []
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        found = []
        for entry in fs.listStatus(folder):
            name = entry.getPath().getName()
            if name.startswith("batch_id=") and fs.exists(path(entry.getPath(), "_SUCCESS")):
                found.append(int(name.split("=")[1]))
        return sorted(found)

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """Newest board, or the one that batch ``before`` starts from."""
        usable = [v for v in self.versions(spark) if before is None or v < before]
        if not usable:
            return empty_board(spark)
        return spark.read.schema(BOARD).parquet(self._version(usable[-1]))

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            self._write_batch(batch, batch_id)

    def _write_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ends = window_ends(batch)
        if not ends:
            return
        staging = f"{self.path}/_staging"
        if len(ends) > 1:
            batch = by_window(batch, staging)
        board = fold_windows(self.read(spark, before=batch_id), batch, ends, self.n)
        board.select(*BOARD_COLUMNS).write.mode("overwrite").parquet(self._version(batch_id))
        self._delete(spark, staging)
        self._forget(spark, batch_id)

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        for old in [v for v in self.versions(spark) if v < batch_id][: -self.keep]:
            self._delete(spark, self._version(old))

    def _delete(self, spark: SparkSession, folder: str) -> None:
        fs, _ = self._filesystem(spark)
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder), True)


def redis_client(uri: str):
    """Client of a sorted-set server. The ``redis`` package is not part of this image."""
    import redis

    return redis.Redis.from_url(uri)


def write_sorted_sets(
    batch: DataFrame, uri: str, n: int = BOARD_SIZE, connect: Callable = redis_client
) -> None:
    """Writes windowed scores to outside sorted sets ``hot:{category}``, trimmed to ``n``.

    ``connect(uri)`` gives a client with ``zadd``, ``zremrangebyrank`` and ``close``;
    it is called once per task. A creation's windows are written in order; one window's rows of
    a category go out together and are trimmed once.
    """

    def write(rows):
        client = connect(uri)
        try:
            for (_, key), group in groupby(rows, lambda r: (r.window_end, r.key)):
                part = {}
                for r in group:
                    part[r.member] = r.score
                    if len(part) == 1000:
                        client.zadd(key, part)
                        part = {}
                if part:
                    client.zadd(key, part)
                # One atomic call: tasks that trim a set at once do not take members twice.
                client.zremrangebyrank(key, 0, -(n + 1))
        finally:
            client.close()

    send_by_value()
    with adaptive(batch.sparkSession):
        (
            batch.filter(F.col("category").isNotNull())
            .select(
                ranking_key(F.col("category")).alias("key"),
                member_text(F.col("creation_id")).alias("member"),
                "score",
                "window_end",
            )
            .repartition("member")
            .sortWithinPartitions("window_end", "key")
            .foreachPartition(write)
        )


def mirror_board(
    board: DataFrame, batch: DataFrame, uri: str, connect: Callable = redis_client
) -> None:
    """Makes the sorted sets of the batch's categories hold exactly what ``board`` does.

    A set is replaced in one transaction by its board, which has board-size members at most and is
    the same whenever a micro-batch is run again. So a repeated batch, task or transaction
    changes nothing, and readers never see a set half written. The sets belong to the job: what
    others put there is replaced. ``connect(uri)`` gives a client with ``pipeline`` and ``close``;
    the pipeline has ``delete``, ``zadd`` and ``execute``.
    """

    def write(rows):
        client = connect(uri)
        try:
            for key, group in groupby(rows, lambda r: r.key):
                change = client.pipeline(transaction=True)
                change.delete(key)
                change.zadd(key, {r.member: r.score for r in group})
                change.execute()
        finally:
            client.close()

    send_by_value()
    with adaptive(batch.sparkSession):
        (
            board.join(batch.select("category").distinct(), "category", "left_semi")
            .select(
                ranking_key(F.col("category")).alias("key"),
                member_text(F.col("creation_id")).alias("member"),
                "score",
            )
            .repartition("key")
            .sortWithinPartitions("key")
            .foreachPartition(write)
        )
