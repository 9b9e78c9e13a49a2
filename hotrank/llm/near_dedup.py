"""MinHash near-dedup with min-max hashing: minimum and maximum under each permutation."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotrank.llm.common import LOWER, number, numbered, packed, pick, read, small, texts, unpacked
from hotrank.llm.hashing import mixed, runs, word_hashes
from hotrank.session import as_table, fresh_folder

#: Permutations; each gives two values of a signature.
PERMUTATIONS = 64
#: Values of one band: minimum and maximum of two permutations. At a similarity of 0.8 a pair
#: misses all 32 bands about once in ten million.
ROWS = 4
#: Pairs whose signatures agree in less than this share are not compared in full. Four standard
#: deviations below a similarity of 0.8.
PLAUSIBLE = 0.66
#: Buckets of more classes than this are compared in blocks of ``_BLOCK`` classes, inside tasks.
CROWD, _BLOCK = 16, 512
_RANDOM = np.random.default_rng(64)
_FACTORS = (_RANDOM.integers(0, 1 << 63, PERMUTATIONS, np.uint64) << np.uint64(1)) | np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 64, PERMUTATIONS, np.uint64)
_SLICE = 1 << 12


def shingles(text: bytes, size: int) -> np.ndarray:
    """Distinct hashes of ``size`` consecutive words; of fewer words, of the whole sequence."""
    words = word_hashes(text.translate(LOWER))
    if 0 < len(words) < size:
        return runs(words, len(words), seed=len(words))
    return np.unique(runs(words, size))


def signature(found: np.ndarray) -> np.ndarray:
    """Minimum and maximum of each permutation, side by side."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for start in range(0, len(found), _SLICE):
        moved = found[None, start : start + _SLICE] * _FACTORS[:, None] + _SHIFTS[:, None]
        np.minimum(low, moved.min(1), out=low)
        np.maximum(high, moved.max(1), out=high)
    return np.stack([low, high], 1).ravel()


def bands(values: np.ndarray) -> np.ndarray:
    rows = values.reshape(-1, ROWS)
    key = np.arange(len(rows), dtype=np.uint64)
    for i in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key.view(np.int64)


def _sketches(size: int):
    def run(batches):
        for batch in small(batches):
            made = []
            for text in texts(batch.column("text")):
                found = shingles(text, size)
                if not len(found):
                    made.append((0, None, None, None, None))
                    continue
                key = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                values = signature(found)
                made.append((
                    len(found), *np.frombuffer(key, np.int64).tolist(), bands(values),
                    mixed(values).astype(np.uint8).tobytes(),
                ))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")]
                + [pa.array([m[i] for m in made], t) for i, t in enumerate(types)],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"],
            )

    return run


def _alike(batches):
    """Pairs whose signatures agree often enough."""
    for batch in batches:
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(
                -1, 2 * PERMUTATIONS) for c in ("sketch_x", "sketch_y")
        )
        keep = (a == b).mean(1) >= PLAUSIBLE
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).filter(pa.array(keep)) for c in ("x", "y")], names=["x", "y"])


def _confirm(size: int, percent: int):
    def run(batches):
        for batch in small(batches):
            keep = []
            for a, b in zip(unpacked(batch.column("text_x")), unpacked(batch.column("text_y"))):
                a, b = shingles(a, size), shingles(b, size)
                same = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * same >= percent * (len(a) + len(b) - same) and same > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("x", "y")],
                names=["x", "y"])

    return run


def _sets(size: int):
    def run(batches):
        for batch in small(batches):
            found = [shingles(x, size).tobytes() for x in unpacked(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.binary())], names=["class", "set"])

    return run


def _links_of_block(percent: int):
    """Links across components among the classes of one or two blocks of a bucket."""

    def compare(table):
        table = table.sort_by("class")
        classes, roots = table["class"].to_numpy(), table["root"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table["set"].to_pylist()]
        sizes = np.array([len(x) for x in sets])
        owners = np.repeat(np.arange(len(sets)), sizes)
        values, held = np.unique(np.concatenate(sets), return_inverse=True)
        same = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(held, kind="stable")
        owners, held = owners[order], held[order]
        for start in range(0, len(values), 4096):
            a, b = np.searchsorted(held, (start, start + 4096))
            part = np.zeros((len(sets), 4096), np.float32)
            part[owners[a:b], held[a:b] - start] = 1
            same += part @ part.T
        same = same.astype(np.int64)
        linked = 100 * same >= percent * (sizes[:, None] + sizes[None] - same)
        x, y = np.nonzero(np.triu(linked & (roots[:, None] != roots[None]), 1))
        return pa.table({"x": pa.array(classes[x]), "y": pa.array(classes[y])})

    return compare


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node each node of the links ``x, y`` is connected with.

    Each round a node takes the smallest root among its neighbours' and then its root's root;
    lineage is cut by a table every round.
    """
    spark = links.sparkSession
    both = as_table(
        links.select("x", "y").unionAll(links.select(F.col("y"), F.col("x"))).distinct(),
        fresh_folder(spark, "near-links"),
    )
    roots = as_table(
        both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("root"))
        .select("node", F.least("node", "root").alias("root")),
        fresh_folder(spark, "near-roots"),
    )
    while True:
        near = (
            both.join(roots, both["y"] == roots["node"])
            .groupBy(F.col("x").alias("node")).agg(F.min("root").alias("near"))
        )
        taken = roots.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = roots.select(F.col("node").alias("up"), F.col("root").alias("up_root"))
        found = as_table(
            taken.join(up, taken["root"] == up["up"]).select(
                "node", "old", F.least("root", "up_root").alias("root")),
            fresh_folder(spark, "near-roots"),
        )
        roots = found.select("node", "root")
        if found.where("old <> root").isEmpty():
            return roots


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    size: int = 5, percent: int = 80,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``; one row per row of ``docs``.

    Documents are linked when ``100 * intersection >= percent * union`` of their sets of
    ``size``-word shingles. Documents of equal sets are one class from the start. A signature
    keeps the minimum and maximum under each permutation, and bands of it deal classes to
    buckets. First every class is compared with the bucket's smallest and largest, in full with one
    of them, and with the others unless that connected them; then, among classes of a bucket not
    yet connected, with every one of similar size. Candidates pass by
    signature and are confirmed on the full sets. In crowded buckets that last step compares
    blocks of full sets inside tasks and gives links only, so that pairs within a group are
    never listed, however large the group, and no bucket is cut.

    Null, empty and blank texts have no set and link with nothing. Equal rows fall into one
    class; rows of equal id count as one document. Null ids are treated as the smallest id, and
    come back null. The number of shingles is a row's own.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), "text")

    def table(df: DataFrame, name: str) -> DataFrame:
        return as_table(df, fresh_folder(spark, f"near-{name}"))

    sketches = table(rows.mapInArrow(
        _sketches(size), "doc_id long, n_shingles long, set_a long, set_b long, "
        "bands array<long>, sketch binary"), "sketches")
    classes = table(
        sketches.where("n_shingles > 0").groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("class")), "classes")
    of_class = sketches.join(classes, ["set_a", "set_b"])
    firsts = table(
        of_class.where(F.col("doc_id") == F.col("class"))
        .select("class", "n_shingles", "bands", "sketch"), "firsts")
    entries = firsts.select("class", "n_shingles", F.explode("bands").alias("bucket"))
    buckets = table(
        entries.groupBy("bucket").agg(
            F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
        .where("n > 1").drop("n"), "buckets")
    members = table(entries.join(buckets, "bucket"), "members")
    sketch = firsts.select("class", "sketch")
    # All that any comparison below asks for, shuffled out of the corpus once.
    asked = members.select(F.col("class").alias("doc_id")).distinct()
    whole = table(packed(rows).join(asked, "doc_id").select("doc_id", "text"), "texts")

    def plausible(pairs: DataFrame, name: str) -> DataFrame:
        pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        return table(
            pairs.where("x <> y").distinct()
            .join(sketch.toDF("x", "sketch_x"), "x").join(sketch.toDF("y", "sketch_y"), "y")
            .select("x", "y", "sketch_x", "sketch_y").mapInArrow(_alike, "x long, y long"),
            f"pairs-{name}")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        return table(
            pairs.join(whole.toDF("x", "text_x"), "x").join(whole.toDF("y", "text_y"), "y")
            .select("x", "y", "text_x", "text_y").mapInArrow(
                _confirm(size, percent), "x long, y long"), f"links-{name}")

    stars = plausible(
        members.select(F.col("class").alias("x"), F.explode(F.array("low", "high")).alias("y")),
        "stars")
    # A class meets one partner in full first; the others only where that left them apart.
    first = stars.groupBy("y").agg(F.min("x").alias("x")).select("x", "y")
    links = confirmed(first, "first")
    roots = components(links)
    apart = (
        stars.join(roots.toDF("x", "root_x"), "x", "left")
        .join(roots.toDF("y", "root_y"), "y", "left")
        .where(F.coalesce("root_x", "x") != F.coalesce("root_y", "y"))
        .join(first, ["x", "y"], "left_anti").select("x", "y"))
    rest = confirmed(apart, "stars")
    if not rest.isEmpty():
        links = links.unionAll(rest)
        roots = components(links)
    placed = members.join(roots, members["class"] == roots["node"], "left").select(
        "bucket", "class", "n_shingles", F.coalesce("root", "class").alias("root"))
    torn = (
        placed.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("root").alias("a"), F.max("root").alias("b"))
        .where("a <> b").select("bucket", "n"))
    placed = table(placed.join(torn, "bucket"), "placed")
    few = placed.where(F.col("n") <= CROWD).drop("n")
    other = few.toDF("bucket", "y", "n_y", "root_y")
    similar = (F.col("n_shingles") * 100 >= F.col("n_y") * percent) & (
        F.col("n_y") * 100 >= F.col("n_shingles") * percent)
    across = few.join(other, "bucket").where(
        (F.col("class") < F.col("y")) & (F.col("root") != F.col("root_y")) & similar)
    more = confirmed(
        plausible(across.select(F.col("class").alias("x"), "y"), "across"), "across")
    crowd = placed.where(F.col("n") > CROWD)
    asked = crowd.select(F.col("class").alias("doc_id")).distinct()
    sets = table(
        whole.join(asked, "doc_id").mapInArrow(_sets(size), "class long, set binary"), "sets"
    ).dropDuplicates(["class"])
    count = F.ceil(F.col("n") / _BLOCK).cast("int")
    own = F.pmod(F.xxhash64("class"), count).cast("int")
    meets = F.explode(F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct(F.least(i, own).alias("i"), F.greatest(i, own).alias("j"))))
    crowded = table(
        crowd.select("bucket", "class", "root", meets.alias("at")).join(sets, "class")
        .select("bucket", "at.i", "at.j", "class", "root", "set")
        .groupBy("bucket", "i", "j").applyInArrow(_links_of_block(percent), "x long, y long")
        .distinct(), "links-crowd")
    more = more.unionAll(crowded)
    if not more.isEmpty():
        roots = components(links.unionAll(more))
    found = of_class.select("doc_id", "n_shingles", "class").unionAll(
        sketches.where("n_shingles = 0").select(
            "doc_id", "n_shingles", F.lit(None).cast("long").alias("class")))
    named = found.join(roots, found["class"] == roots["node"], "left").select(
        "doc_id", "n_shingles",
        F.coalesce("root", "class", "doc_id").alias("component_id"))
    null = F.lit(-(1 << 63))
    return named.select(
        F.nullif("doc_id", null).alias("doc_id"), "n_shingles",
        F.nullif("component_id", null).alias("component_id"),
        (F.col("doc_id") == F.col("component_id")).alias("kept"),
    )


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_components(read(spark, folder, "documents"), size=2)


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies, all columns as they are.

    Of rows of equal id, which count as one document, one stays.
    """
    kept = near_components(docs).where("kept").select(F.col("doc_id").alias("kept")).distinct()
    doc_id = number(docs, "doc_id")
    rows = numbered(docs).join(kept, F.col(doc_id).eqNullSafe(F.col("kept")), "left_semi")
    return rows.dropDuplicates([doc_id]).toDF(*docs.columns)
