"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotrank.llm.common import LOWER, fold, number, numbered, pick, read, small, texts
from hotrank.llm.hashing import mixed
from hotrank.session import as_table, fresh_folder

#: Hash buckets of subwords; each has a vector.
BUCKETS = 1 << 18
SIZE = 8
#: At most so many labelled documents of either class are learnt from, chosen by a hash of their id.
TOXIC_SAMPLE, CLEAN_SAMPLE = 2_000, 4_000
#: Differences between the classes of less than so many standard errors count as noise.
NOISE = 3.0
_BATCH, _ROUNDS, _STEP, _SCALE, _DECAY = 256, 15, 0.5, 64.0, 1e-6
#: Bytes of text hashed at a time.
_SLICE = 2 << 20
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_GRAMS = (3, 4, 5)


def _windows(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of ``size`` bytes that lie within one word and its edges, and their starts."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = np.cumsum(data == 0x20)
    # Blanks may stand first and last only, not both next to each other.
    at = np.flatnonzero(inner[size - 2 : size - 2 + n] == inner[:n])
    found = np.full(len(at), size, np.uint64)
    for i in range(size):
        found = found * np.uint64(0x100000001B3) + data[at + i]
    return (mixed(found) % np.uint64(BUCKETS)).astype(np.int64), at


def _pieces(held: list[bytes]):
    """Numbers and bytes of texts in lots of some ``_SLICE`` bytes; longer texts are cut between words."""
    of, parts, size = [], [], 0
    for i, text in enumerate(held):
        start = 0
        while start < len(text):
            end = len(text)
            if end - start > _SLICE:
                gap = _GAP.search(text, start + _SLICE)
                end = gap.end() if gap else end
            of.append(i)
            parts.append(text[start:end])
            size += end - start
            start = end
            if size >= _SLICE:
                yield of, parts
                of, parts, size = [], [], 0
    if of:
        yield of, parts


def subwords(held: list[bytes]):
    """For lots of ``held``: the number of the text and the bucket of each subword, place by place.

    Words are runs of letters, digits and bytes beyond ASCII, in lower case; their subwords are the
    runs of 3 to 5 bytes, with a blank for either end of the word. Misspelt words share most of
    theirs.
    """
    for of, parts in _pieces(held):
        data = np.frombuffer(b" ".join([b"", *parts, b""]).translate(LOWER), np.uint8)
        data = np.where(_LETTER[data], data, np.uint8(0x20))
        bounds = np.cumsum([0, *(len(x) + 1 for x in parts[:-1])])
        for size in _GRAMS:
            buckets, at = _windows(data, size)
            yield np.asarray(of)[np.searchsorted(bounds, at, "right") - 1], buckets


def averages(held: list[bytes], table: np.ndarray) -> np.ndarray:
    """Each text's mean of ``table`` over its subwords; 0 for texts without."""
    sums, counts = np.zeros(len(held)), np.zeros(len(held))
    for of, buckets in subwords(held):
        sums += np.bincount(of, table[buckets], len(held))
        counts += np.bincount(of, minlength=len(held))
    return sums / np.maximum(counts, 1)


def bags(held: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, buckets and shares of the texts' subwords, ordered by text and bucket."""
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for of, buckets in subwords(held):
        found, n = np.unique(of * BUCKETS + buckets, return_counts=True)
        keys.append(found)
        counts.append(n)
    found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(inverse, np.concatenate(counts), len(found))
    of = found // BUCKETS
    return of, found % BUCKETS, n / np.bincount(of, n, len(held))[of]


def _frequencies(batches):
    """Texts of each class that hold a bucket."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in small(batches, 4 << 20):
        toxic = np.asarray(batch.column("toxic").to_pylist(), np.int64)
        of, buckets, _ = bags(texts(batch.column("text")))
        counts += np.bincount(toxic[of] * BUCKETS + buckets, minlength=2 * BUCKETS).reshape(2, -1)
    held = np.flatnonzero(counts.sum(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(held), pa.array(counts[0, held]), pa.array(counts[1, held])],
        names=["bucket", "clean", "toxic"],
    )


def _trusted(trust: np.ndarray):
    """Each text's buckets of some trust, and their shares times that trust."""

    def run(batches):
        for batch in small(batches, 4 << 20):
            of, buckets, shares = bags(texts(batch.column("text")))
            kept = np.flatnonzero(trust[buckets])
            of, buckets = of[kept], buckets[kept]
            ends = pa.array(np.searchsorted(of, np.arange(batch.num_rows + 1)), pa.int32())
            weights = pa.array((shares[kept] * trust[buckets]).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"),
                 pa.ListArray.from_arrays(ends, pa.array(buckets.astype(np.int32))),
                 pa.ListArray.from_arrays(ends, weights)],
                names=["doc_id", "toxic", "ids", "weights"],
            )

    return run


class Part:
    """A lot of texts in the order of its gradient's sums."""

    def __init__(self, rows, held: list[tuple]):
        self.rows = rows
        self.ids = np.concatenate([held[i][0] for i in rows])
        self.weights = np.concatenate([held[i][1] for i in rows]) * np.float32(_SCALE)
        sizes = np.array([len(held[i][0]) for i in rows])
        self.row = np.repeat(np.arange(len(rows)), sizes)
        self.full = np.flatnonzero(sizes)
        self.starts = (np.cumsum(sizes) - sizes)[self.full]
        self.uniq, inverse = np.unique(self.ids, return_inverse=True)
        self.order = np.argsort(inverse, kind="stable")
        self.firsts = np.searchsorted(inverse[self.order], np.arange(len(self.uniq)))

    def vectors(self, table):
        out = np.zeros((len(self.rows), SIZE), np.float32)
        if len(self.full):
            out[self.full] = np.add.reduceat(table[self.ids] * self.weights[:, None], self.starts)
        return out

    def slopes(self, back):
        spread = back[self.row] * self.weights[:, None]
        return np.add.reduceat(spread[self.order], self.firsts)


def _softmax(z: np.ndarray) -> np.ndarray:
    odds = np.exp(z - z.max(1, keepdims=True))
    return odds / odds.sum(1, keepdims=True)


def train(held: list[tuple], toxic: np.ndarray, seed: int = 0) -> tuple[np.ndarray, float]:
    """Embeddings and softmax fitted together; gives each bucket's weight and the bias.

    The classes weigh 2 to 1 for clean, whatever their sizes. Every step is divided by the root of
    the squares of all slopes so far, so no coordinate moves by more than ``_STEP`` at once,
    whatever the scale of the features; weights decay. A fit that is not finite, or no better
    than knowing nothing, raises.
    """
    rng = np.random.default_rng(seed)
    table = np.zeros((BUCKETS, SIZE), np.float32)
    softmax = rng.normal(0, 1 / math.sqrt(SIZE), (SIZE, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    past = [np.zeros((BUCKETS, 1), np.float32), np.zeros_like(softmax), np.zeros_like(bias)]
    share = np.where(toxic == 1, 1 / max((toxic == 1).sum(), 1), 2 / max((toxic == 0).sum(), 1)) / 3
    order = rng.permutation(len(held))
    parts = [Part(order[i : i + _BATCH], held) for i in range(0, len(order), _BATCH)]

    def loss() -> float:
        total = 0.0
        for part in parts:
            odds = _softmax(part.vectors(table) @ softmax + bias)
            mine = odds[np.arange(len(part.rows)), toxic[part.rows]]
            total -= float(share[part.rows] @ np.log(mine + 1e-12))
        return total

    before = loss()
    for _ in range(_ROUNDS):
        for k in rng.permutation(len(parts)):
            part = parts[k]
            docs = part.vectors(table)
            slope = _softmax(docs @ softmax + bias)
            slope[np.arange(len(part.rows)), toxic[part.rows]] -= 1
            slope = (slope * share[part.rows][:, None] * len(parts)).astype(np.float32)
            if len(part.ids):
                moves = part.slopes(slope @ softmax.T) + _DECAY * table[part.uniq]
                past[0][part.uniq] += np.square(moves).sum(1, keepdims=True)
                table[part.uniq] -= _STEP * moves / np.sqrt(past[0][part.uniq] + 1e-10)
            for x, seen, move in ((softmax, past[1], docs.T @ slope), (bias, past[2], slope.sum(0))):
                move = move + _DECAY * x
                seen += np.square(move)
                x -= 0.1 * move / np.sqrt(seen + 1e-8)
    after = loss()
    if not math.isfinite(after) or after > before:
        raise ArithmeticError(f"toxicity does not fit: loss {before} before, {after} after")
    apart = (softmax[:, 1] - softmax[:, 0]).astype(np.float64)
    return table @ apart * _SCALE, float(bias[1] - bias[0])


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Learns from at most ``TOXIC_SAMPLE`` and ``CLEAN_SAMPLE`` labelled documents.

    ``docs``: doc_id, text; ``labels``: doc_id, toxic. Rows without label or of unknown ids are
    left out; of several labels of an id the highest counts, of several texts the first in their
    order. Without documents of both classes the model knows nothing and gives every text the
    share of toxic ones (one half without any).

    Every bucket has a vector; its share in a text is shrunk by how far the difference between
    the classes stands out from noise, so subwords of a few chance texts weigh nothing.
    """
    spark = docs.sparkSession
    known = (
        labels.where("toxic in (0, 1) and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )

    def some(toxic: int, n: int) -> DataFrame:
        return known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)

    # The size is proven by both limits; texts are reduced to one per id before the driver's work.
    sample = some(1, TOXIC_SAMPLE).unionAll(some(0, CLEAN_SAMPLE))
    chosen = as_table(
        docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text")),
        fresh_folder(spark, "toxicity"),
    )
    sizes = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    clean, bad = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not bad:
        share = (bad + 1) / (clean + bad + 2)
        return np.zeros(BUCKETS), math.log(share / (1 - share))
    held = (
        chosen.select("text", "toxic")
        .mapInArrow(_frequencies, "bucket long, clean long, toxic long")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toArrow()
    )
    counts = np.zeros((2, BUCKETS))
    counts[:, held["bucket"].to_numpy()] = held["clean"].to_numpy(), held["toxic"].to_numpy()
    both = counts.sum(0) / (clean + bad)
    error = np.sqrt(both * (1 - both) * (1 / bad + 1 / clean) + 1e-9)
    apart = np.abs(counts[1] / bad - counts[0] / clean) / error
    trust = np.maximum(0, 1 - np.square(NOISE / np.maximum(apart, 1e-9)))
    found = (
        chosen.select("doc_id", "toxic", "text")
        .mapInArrow(
            _trusted(trust), "doc_id long, toxic int, ids array<int>, weights array<float>")
        .toArrow()
        .sort_by("doc_id")
    )
    weights, bias = train(
        list(zip(found["ids"].to_numpy(), found["weights"].to_numpy())),
        found["toxic"].to_numpy(),
    )
    return weights * trust, bias


def probabilities(held: list[bytes], table: np.ndarray, bias: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(bias + averages(held, table), -700, 700)))


def _learnt(docs: DataFrame, labels: DataFrame):
    """Scores of texts by what was learnt from the labelled rows outside the held-out fold."""
    table, bias = fit_toxicity(docs, labels.where(fold() != 0))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    return lambda held: probabilities(held, shared.value, bias)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """Scores every whole text; one row per row of ``docs``.

    Learns from labelled rows whose crc32(id) mod 5 is not 0; only texts enter a score. A text's
    vector is the mean of its subwords' embeddings. Null and empty texts, and such without letters
    or digits, get the model's bias; a null id is never learnt from and not held out; repeated rows
    are scored alike. Very long texts are hashed piece by piece. Empty tables give no rows; other
    columns are not looked at. Broadcasts: the sample's ids and one weight per bucket
    (``BUCKETS``). The driver fits at most ``TOXIC_SAMPLE`` and ``CLEAN_SAMPLE`` sparse rows of at
    most ``BUCKETS`` entries. A model that is not finite raises.
    """
    docs = pick(docs, doc_id=id_col, text=text_col)
    score = _learnt(docs, pick(labels, doc_id=id_col, toxic=label_col))
    held_out = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")

    def run(batches):
        for batch in small(batches):
            found = score(texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found),
                 pa.array((found >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", held_out, "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents not predicted toxic, all columns as they are.

    Each row is judged by its own text, whatever its id, and stays where it is: no shuffle.
    """
    score = _learnt(
        pick(docs, doc_id="doc_id", text="text"),
        pick(read(spark, folder, "labels"), doc_id="doc_id", toxic="toxic"),
    )
    rows, text = numbered(docs), number(docs, "text")

    def run(batches):
        for batch in small(batches):
            yield batch.filter(pa.array(score(texts(batch.column(text))) < 0.5))

    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
