"""What the operators share: columns by exact name, words as bytes, batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = bytes(range(0x41, 0x5B))
#: Lower-cases A-Z and nothing else, in UTF-8.
LOWER = bytes.maketrans(UPPER, UPPER.lower())


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The columns named, under the keywords' names.

    Found by exact name, the first of equal ones, so other columns that differ by case or
    repeat a name do no harm.
    """
    plain = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    return plain.select(
        *(F.col(f"_{df.columns.index(name)}").alias(to) for to, name in columns.items())
    )


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns ``c0``, ``c1`` and so on, which no added name clashes with."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def number(df: DataFrame, name: str) -> str:
    """What ``numbered(df)`` calls the first column of that exact name."""
    return f"c{df.columns.index(name)}"


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; empty where it is null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def small(batches: Iterator[pa.RecordBatch], size: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of some ``size`` bytes, at least one row each."""
    for batch in batches:
        step = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def cuts(text: bytes, gap, size: int = 1 << 20) -> Iterator[bytes]:
    """``text`` in pieces of some ``size`` bytes, cut where the pattern ``gap`` ends."""
    start = 0
    while len(text) - start > size:
        found = gap.search(text, start + size)
        if not found:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:]


def pack(text: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(text)


def unpacked(column: pa.Array) -> list[bytes]:
    """The texts of a packed column."""
    read = zstandard.ZstdDecompressor()
    return [read.decompress(x) if x else b"" for x in column.to_pylist()]


def packed(df: DataFrame) -> DataFrame:
    """``df`` with its texts compressed one by one, for shuffles; null texts become empty ones."""
    kept = [c for c in df.columns if c != "text"]
    out = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches):
        for batch in small(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array([pack(x) for x in texts(batch.column("text"))], pa.binary())],
                names=[*kept, "text"],
            )

    return df.mapInArrow(run, f"{out}, text binary")


def per_text(
    df: DataFrame, schema: str, make: Callable[[], Callable[[bytes], tuple]]
) -> DataFrame:
    """One row per row of ``df`` (``text`` last): its other columns, then what ``make()(text)`` gives.

    ``make`` runs once per task. ``schema`` names the added columns.
    """
    kept = [c for c in df.columns if c != "text"]
    out = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in kept)
    schema = f"{out}, {schema}" if out else schema

    def run(batches):
        each, types = make(), None
        for batch in small(batches):
            rows = [each(x) for x in texts(batch.column("text"))]
            types = types or _arrow(schema, len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(types)],
                names=kept + [n for n, _ in types],
            )

    return df.mapInArrow(run, schema)


_TYPES = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "binary": pa.binary(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()),
    "array<int>": pa.list_(pa.int32()), "array<float>": pa.list_(pa.float32()),
    "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()),
}


def _arrow(schema: str, skip: int) -> list[tuple[str, pa.DataType]]:
    fields = [f.strip().rsplit(" ", 1) for f in schema.split(", ")]
    return [(name, _TYPES[kind]) for name, kind in fields[skip:]]


def fold(doc_id: str = "doc_id", folds: int = 5):
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


#: Groups above one in so many of all rows are hot; there are at most as many of them.
HOT_SHARE = 1000


def join_groups(
    rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int
) -> DataFrame:
    """``rows`` joined with the group of their ``key``, of which ``groups`` holds one row each.

    ``size`` is a column of ``groups`` that counts their rows. Hot groups, at most ``HOT_SHARE`` by
    arithmetic, are broadcast, so their rows stay where they are; all others are shuffled.
    """
    is_hot = F.col(size) * HOT_SHARE > n_rows
    hot = groups.where(is_hot)
    cold_rows = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(
        cold_rows.join(groups.where(~is_hot), key))
