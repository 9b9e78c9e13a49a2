"""Source divergence audit: how far each source's use of terms lies from others of its language.

Terms travel as fixed-width digests; their text is looked up late, for kept terms only.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hotrank.llm.common import LOWER, cuts, pick, read, small, texts
from hotrank.session import as_table, fresh_folder

#: Documents of a language a term must stand in to be kept.
LEAST_DOCS = 3
#: Places of a group's ranking of terms.
PLACES = 200
_UNIT = 1_000_000_000
#: Bits of the map of kept digests that is sent to the tasks, 64 to a row: 8 MB at most.
_MAP = 1 << 26
#: Counts compared in one task, and numbers in one of its matrices.
_SHARD, _CELLS = 400_000, 1 << 21
#: Distinct terms a task holds before it hands them on.
_HELD = 400_000
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_GAP = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")


def _terms(text: bytes):
    """The terms of a text, in lists of bounded size."""
    for part in cuts(text, _GAP):
        yield _TERM.findall(part.translate(LOWER))


def _digest(lang: bytes, bits: int):
    """The digest of a term of ``lang``, as a signed number."""
    start, mask = lang + b"\0", (1 << bits) - 1
    half, whole = 1 << 63, 1 << 64

    def of(term: bytes) -> int:
        x = xxhash.xxh3_64_intdigest(start + term) & mask
        return x - whole if x >= half else x

    return of


def _groups_of(batch) -> list[tuple[bytes, bytes]]:
    return list(zip(texts(batch.column("lang")), texts(batch.column("source"))))


def _counts(bits: int, wanted: np.ndarray | None = None):
    """``lang, source, key, n, docs`` of the terms of a task; with ``wanted`` (a map of digests)
    only of terms in it, and with their text."""

    def run(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def handed():
            for (lang, source), (n, docs) in held.items():
                digest = _digest(lang, bits)
                terms = list(n)
                keys = np.fromiter(map(digest, terms), np.int64, len(terms))
                columns = [pa.array(keys), pa.array(np.fromiter(n.values(), np.int64, len(n))),
                           pa.array(np.fromiter(map(docs.__getitem__, terms), np.int64, len(n)))]
                names = ["key", "n", "docs"]
                if wanted is not None:
                    columns.append(pa.array(terms, pa.binary()).cast(pa.string()))
                    names.append("term")
                rows = pa.RecordBatch.from_arrays(columns, names=names)
                if wanted is not None:
                    rows = rows.filter(pa.array(_marked(wanted, keys)))
                same = [pa.array([x.decode()] * rows.num_rows, pa.string()) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays(
                    same + rows.columns, names=["lang", "source", *names])
            held.clear()

        size = 0
        for batch in small(batches, 4 << 20):
            for group, text in zip(_groups_of(batch), texts(batch.column("text"))):
                if group not in held:
                    held[group] = Counter(), Counter()
                n, docs = held[group]
                size -= len(n)
                mine = set()
                for terms in _terms(text):
                    n.update(terms)
                    mine.update(terms)
                docs.update(mine)
                size += len(n)
            if size > _HELD:
                yield from handed()
                size = 0
        yield from handed()

    return run


def _dictionary(bits: int, wanted: np.ndarray):
    """``key, lang, term`` of the terms of a task whose digests are in the map."""

    def run(batches):
        held: dict[bytes, set] = {}

        def handed():
            for lang, terms in held.items():
                found = list(terms)
                keys = np.fromiter(map(_digest(lang, bits), found), np.int64, len(found))
                kept = pa.array(_marked(wanted, keys))
                found = pa.array(found, pa.binary()).cast(pa.string()).filter(kept)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys).filter(kept), pa.array([lang.decode()] * len(found), pa.string()),
                     found], names=["key", "lang", "term"])
            held.clear()

        for batch in small(batches, 4 << 20):
            for lang, text in zip(texts(batch.column("lang")), texts(batch.column("text"))):
                for terms in _terms(text):
                    held.setdefault(lang, set()).update(terms)
            if sum(map(len, held.values())) > _HELD:
                yield from handed()
        yield from handed()

    return run


def _bit() -> Column:
    return F.pmod("key", F.lit(_MAP))


def _marked(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.mod(keys, _MAP)
    return (bitmap[at >> 6] >> (at & 63)) & 1 == 1


def key_map(keys: DataFrame) -> np.ndarray:
    """Bits of the digests ``key``: a map of fixed size that lets few others pass."""
    words = (
        keys.select((_bit() / 64).cast("long").alias("word"), (_bit() % 64).cast("int").alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    )
    bitmap = np.zeros(_MAP >> 6, np.int64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bitmap


def _share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / total), exactly."""
    raised = (count + 1).cast("decimal(19,0)") * F.lit(_UNIT).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", raised, total.cast("decimal(20,0)"))


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); shares stay below 2^30, so squares fit."""
    return (p - q) ** 2 // q


def _pairs(table: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums over a shard's terms for all pairs of its language's sources, in dense blocks."""
    groups = groups.sort_by("grp")
    ids, rest = groups["grp"].to_numpy(), groups["p0"].to_numpy()
    sums = np.zeros((len(ids), len(ids)), np.int64)
    if table.num_rows:
        _, term = np.unique(
            np.stack([table["key"].to_numpy(), table["sub"].to_numpy()]), axis=1, return_inverse=True)
        order = np.argsort(term, kind="stable")
        term, p = term[order], table["p"].to_numpy()[order]
        column = np.searchsorted(ids, table["grp"].to_numpy()[order])
        step = max(1, _CELLS // len(ids))
        for start in range(0, int(term[-1]) + 1, step):
            a, b = np.searchsorted(term, (start, start + step))
            block = np.repeat(rest[:, None], int(term[b - 1]) - start + 1, 1)
            block[column[a:b], term[a:b] - start] = p[a:b]
            for i in range(len(ids)):
                sums[i] += divergences(block[i], block).sum(1)
    x, y = np.divmod(np.arange(len(ids) ** 2), max(len(ids), 1))
    apart = x != y
    return pa.table({"x": pa.array(ids[x[apart]]), "y": pa.array(ids[y[apart]]),
                     "value": pa.array(sums.ravel()[apart])})


def audit_sources(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    bits: int = 64,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets the sources of a language apart.

    Terms are runs of letters and of characters beyond ASCII, A-Z in lower case; a language keeps
    those in at least ``LEAST_DOCS`` of its documents. Each source's and each language's shares
    of the kept terms are compared by floor((p - q)^2 / q): part ``pair`` sums it against every
    other source of the language, part ``term`` lists the ``PLACES`` terms a source uses most
    above its language.

    Counts are combined inside tasks and shuffled by ``bits``-wide digests of language and term,
    without text. The second pass gives the smallest and the largest string of each kept digest;
    where they differ, strings that collide are counted apart. Text is joined back to the terms
    near the top of a group's ranking, ties included.

    Null text, language and source read as ''. Groups without kept terms take part with equal
    shares (pairs of value 0 where a language keeps none). Repeated rows count as documents; very long
    texts are read piece by piece; empty tables give no rows; other columns are not looked at.
    Work on pairs grows with terms times the square of a language's sources, as the result does.
    A word beyond a million bytes is taken whole.
    """
    spark = docs.sparkSession
    rows = pick(docs, text=text_col, lang=lang_col, source=source_col)

    def table(df: DataFrame, name: str) -> DataFrame:
        return as_table(df, fresh_folder(spark, f"audit-{name}"))

    empty = F.lit("")
    names = rows.select(
        F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"))
    # Groups and languages as numbers, told apart by hash; another seed where hashes collide.
    found = table(names.distinct(), "names")
    seed = 0
    while True:
        grp, lg = F.xxhash64(F.lit(seed), "lang", "source"), F.xxhash64(F.lit(seed), "lang")
        n = found.agg(
            F.count_distinct("lang", "source") - F.count_distinct(grp)
            + F.count_distinct("lang") - F.count_distinct(lg)).first()[0]
        if not n:
            break
        seed += 1
    groups = found.withColumn("grp", grp).withColumn("lg", lg)

    kind = "lang string, source string, key long, n long, docs long"
    counted = rows.mapInArrow(_counts(bits), kind).select("key", grp.alias("grp"), "n", "docs")

    def kept(df: DataFrame, *keys: str) -> DataFrame:
        """Terms in enough documents, with their count in each group; one exchange by digest."""
        by_group = df.repartition(*keys).groupBy(*keys, "grp").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        return (
            by_group.groupBy(*keys)
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"),
                 F.collect_list(F.struct("grp", "n")).alias("groups"))
            .where(F.col("docs") >= LEAST_DOCS).drop("docs")
        )

    by_key = table(kept(counted, "key"), "counts")
    bitmap = spark.sparkContext.broadcast(key_map(by_key))
    words = rows.mapInArrow(
        lambda x: _dictionary(bits, bitmap.value)(x), "key long, lang string, term string")
    whole = F.struct("lang", "term")
    strings = table(
        words.groupBy("key").agg(F.min(whole).alias("low"), F.max(whole).alias("high"))
        .join(by_key.select("key"), "key", "left_semi"), "strings")
    terms = strings.where("low = high").select("key", F.lit(0).alias("sub"), "low.term")
    collided = strings.where("low <> high").select("key")
    if not collided.isEmpty():
        apart = spark.sparkContext.broadcast(key_map(collided))
        again = rows.mapInArrow(
            lambda x: _counts(bits, apart.value)(x), f"{kind}, term string"
        ).join(collided, "key", "left_semi")
        again = table(again, "collided")
        order = Window.partitionBy("key").orderBy("lang", "term")
        named = table(
            again.select("key", "lang", "term").distinct()
            .withColumn("sub", F.row_number().over(order)), "collided-terms")
        split = kept(
            again.join(named, ["key", "lang", "term"]).select("key", "sub", grp.alias("grp"), "n", "docs"),
            "key", "sub")
        by_key = table(
            by_key.join(collided, "key", "left_anti").withColumn("sub", F.lit(0))
            .unionByName(split), "counts")
        terms = terms.unionByName(named.select("key", "sub", "term"))
    else:
        by_key = by_key.withColumn("sub", F.lit(0))

    # Totals of groups and languages.
    each = by_key.select("key", "sub", "n_lang", F.explode("groups").alias("g")).select(
        "key", "sub", "n_lang", "g.grp", "g.n")
    totals = each.groupBy("grp").agg(F.sum("n").alias("total"))
    lang_of = groups.select("grp", "lg")
    sizes = (
        by_key.select(F.get("groups", F.lit(0))["grp"].alias("grp"), "n_lang")
        .groupBy("grp").agg(F.count("*").alias("v"), F.sum("n_lang").alias("n"))
        .join(lang_of, "grp").groupBy("lg")
        .agg(F.sum("v").alias("v"), F.sum("n").alias("lang_total"))
    )
    zero = F.lit(0).cast("long")
    groups = table(
        groups.join(totals, "grp", "left").join(sizes, "lg", "left").fillna(
            0, ["total", "v", "lang_total"]), "groups")
    spread = table(
        each.join(groups.drop("lang", "source"), "grp")
        .select(
            "lg", "grp", "key", "sub",
            _share(F.col("n"), F.col("total") + F.col("v")).alias("p"),
            _share(F.col("n_lang"), F.col("lang_total") + F.col("v")).alias("q")), "shares")

    return _pair_part(spread, groups, zero).unionByName(_term_part(spread, groups, terms, table))


def _pair_part(spread: DataFrame, groups: DataFrame, zero: Column) -> DataFrame:
    shards = max(1, -(-spread.count() // _SHARD))
    p0 = F.when(F.col("v") > 0, _share(zero, F.col("total") + F.col("v"))).otherwise(1)
    everywhere = groups.select(
        "lg", "grp", p0.alias("p0"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    dealt = spread.select(
        "lg", F.pmod(F.xxhash64("key", "sub"), F.lit(shards)).cast("int").alias("shard"),
        "grp", "key", "sub", "p")
    sums = (
        dealt.groupBy("lg", "shard").cogroup(everywhere.groupBy("lg", "shard"))
        .applyInArrow(_pairs, "x long, y long, value long")
        .groupBy("x", "y").agg(F.sum("value").alias("value"))
    )
    names = groups.select("grp", "lang", "source")
    first, second = names.toDF("x", "lang", "source"), names.toDF("y", "lang_y", "item")
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return sums.join(first, "x").join(second, "y").select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value",
        F.row_number().over(place).alias("rank"))


def _term_part(spread: DataFrame, groups: DataFrame, terms: DataFrame, table) -> DataFrame:
    gap = F.col("p") - F.col("q")
    value = F.expr("((p - q) * (p - q)) div q")
    near = Window.partitionBy("grp").orderBy(F.desc("value"))
    # Ranked without text first; what ties with the last place is kept for the text to decide.
    top = (
        spread.where(gap > 0).select("grp", "key", "sub", value.alias("value"))
        .withColumn("place", F.rank().over(near)).where(F.col("place") <= PLACES)
    )
    top = table(top.drop("place"), "top")
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        top.join(terms.withColumnRenamed("term", "item"), ["key", "sub"])
        .join(groups.select("grp", "lang", "source"), "grp")
        .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= PLACES)
        .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    )


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit_sources(read(spark, folder, "documents"))
