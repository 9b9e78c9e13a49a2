"""Mixing sources to target weights by entropy balancing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hotrank.llm.common import number, numbered, pick, read
from hotrank.session import as_table, fresh_folder

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: No source or document is taken more often.
LIMIT = 3.0
#: Hash ranges a source's documents are ranked in, so that no task ranks a whole source.
RANGES = 1024
_WORD = r"[^\x20\x09-\x0D]+"
#: Newton steps at most, and the share of a target that is close enough before rounding.
_STEPS, _NEAR = 40, 1e-9


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, limit: float = LIMIT) -> DataFrame:
    """``source, source_size`` with ``target`` words of each source.

    Sources in order of code points, null last, weigh ``weights`` in turn and share the words of
    all; a target stops at ``limit`` times its source's size and the excess is shared again by
    weight. The sources whose limit binds come first in order of limit per weight, so the level
    of the others follows from running sums over the sources. Sources without words get 0. The
    running sums are over one row per source.
    """
    spark = sizes.sparkSession
    count = len(weights)
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = ((F.row_number().over(order) - 1) % count).cast("int")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), place + 1)
    top = F.col("source_size") * F.lit(limit)
    rows = sizes.select("source", "source_size", weight.alias("weight"), top.alias("top"))
    by_ratio = Window.orderBy(F.col("top") / F.col("weight"), F.col("place"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    rows = (
        rows.withColumn("place", F.row_number().over(order))
        .withColumn("bound", F.coalesce(F.sum("top").over(before), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(everything) - F.coalesce(
            F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.sum("source_size").over(everything) - F.col("bound"))
                    / F.col("left"))
    )
    # The first level that its own source's limit does not bind holds for all that follow.
    free = F.when(F.col("level") * F.col("weight") <= F.col("top"), F.col("level"))
    level = F.first(free, ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, 0)
    )
    wanted = F.least(F.col("top"), F.coalesce(level * F.col("weight"), F.col("top")))
    return as_table(
        rows.select("source", "source_size", wanted.alias("target")),
        fresh_folder(spark, "mixing-targets"),
    )


def tilts(histogram: DataFrame, goals: DataFrame, limit: float = LIMIT) -> DataFrame:
    """``source, tilt``: the dual variable of each source's token constraint.

    Among all rates of at most ``limit`` that give each source its target words, the rates
    closest to 1 in relative entropy are ``least(limit, exp(tilt * size / mean size))``. The dual
    is convex in the tilt; its slope is the words taken less the target, its curvature the sum of
    ``size * size / mean * rate`` below the limit. Each Newton step is one aggregation of the
    histogram (words per document, number of documents) with the state of one row per source;
    a step that leaves the bracket known so far halves it instead.
    """
    spark = histogram.sparkSession
    stats = histogram.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean")
    )
    same = F.col("h.source").eqNullSafe(F.col("s.source"))
    state = (
        goals.alias("s").join(stats.alias("h"), same).where("target > 0")
        .select(
            "s.source", "target", "mean",
            (F.col("target") >= limit * F.col("source_size") * (1 - 1e-12)).alias("full"),
            F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"), F.lit(False).alias("done"),
        )
    )
    state = as_table(state, fresh_folder(spark, "mixing-state"))
    x = F.col("size") / F.col("mean")
    rate = F.exp(F.least(F.col("tilt") * x, F.lit(50.0)))
    taken = F.col("n") * F.col("size") * F.least(rate, F.lit(limit))
    bend = F.when(rate < limit, F.col("n") * F.col("size") * x * rate).otherwise(0.0)
    for _ in range(_STEPS):
        sums = (
            histogram.alias("h").join(state.alias("s"), same)
            .groupBy("s.source", "target", "mean", "full", "tilt", "low", "high")
            .agg(F.sum(taken).alias("taken"), F.sum(bend).alias("bend"))
        )
        over = F.col("taken") > F.col("target")
        low = F.when(over, F.col("low")).otherwise(F.col("tilt"))
        high = F.when(over, F.col("tilt")).otherwise(F.col("high"))
        # In logarithms of the words taken, which are nearly straight in the tilt.
        step = F.col("tilt") + F.log(F.col("target") / F.col("taken")) * F.col("taken") / F.when(
            F.col("bend") > 0, F.col("bend"))
        middle = F.when(low.isNull(), high - 1 - F.abs(high)).when(
            high.isNull(), low + 1 + F.abs(low)).otherwise((low + high) / 2)
        inside = (low.isNull() | (step > low)) & (high.isNull() | (step < high))
        near = F.abs(F.col("taken") - F.col("target")) <= F.col("target") * _NEAR
        done = F.col("full") | near
        state = as_table(
            sums.select(
                "source", "target", "mean", "full",
                F.when(done, F.col("tilt")).when(inside, step).otherwise(middle).alias("tilt"),
                low.alias("low"), high.alias("high"), done.alias("done"),
            ),
            fresh_folder(spark, "mixing-state"),
        )
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("source", "mean", "full", "tilt")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    limit: float = LIMIT,
) -> DataFrame:
    """How much of each document a mix with given source weights takes; one row per row.

    Rates follow from ``tilts`` and are rounded to whole copies by a hash of the id, so reruns
    agree. What a source's copies then miss or exceed is made up along the same hash order by
    the first documents with room, within 0 and ``limit`` times their size; at the end of that
    one document is taken in part. So ``taken`` adds up to the target rounded to words.

    Null text and texts without words: size 0, taken 0. Null source: a source of its own, last.
    Null and repeated ids are rows like others; equal rows may swap what they take. Empty table:
    no rows. Texts are read once and never shuffled: only sizes are. A hot source is aggregated
    before it is shuffled and ranked in ``RANGES`` ranges of its hash order.
    """
    spark = docs.sparkSession
    sizes = pick(docs, doc_id=id_col, text=text_col, source=source_col).select(
        "doc_id", F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size")
    )
    sizes = as_table(
        sizes.withColumn("spot", F.xxhash64("doc_id", "size", F.lit(7))),
        fresh_folder(spark, "mixing-sizes"),
    )
    histogram = as_table(
        sizes.groupBy("source", "size").agg(F.count("*").alias("n")),
        fresh_folder(spark, "mixing-histogram"),
    )
    goals = targets(
        histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
        weights, limit,
    )
    dual = tilts(histogram, goals, limit)
    per_source = goals.alias("g").join(
        dual.alias("d"), F.col("g.source").eqNullSafe(F.col("d.source")), "left"
    ).select("g.source", "source_size", "target", "mean", "full", "tilt")
    per_source = as_table(per_source, fresh_folder(spark, "mixing-sources"))
    chance = F.pmod(F.col("spot"), F.lit(1 << 30)) / float(1 << 30)
    rate = F.when(F.col("full"), F.lit(limit)).otherwise(
        F.least(F.lit(limit), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"),
                                            F.lit(50.0))))
    )
    copies = F.least(F.floor(rate + chance), F.lit(int(limit)))
    rows = (
        sizes.alias("h").join(
            per_source.alias("s"), F.col("h.source").eqNullSafe(F.col("s.source"))
        )
        .select(
            "doc_id", "h.source", "size", "source_size", "target", "spot",
            F.coalesce(copies * F.col("size"), F.lit(0)).cast("long").alias("whole"),
            F.pmod(F.shiftright(F.col("spot"), 30), F.lit(RANGES)).cast("int").alias("range"),
        )
    )
    rows = as_table(rows, fresh_folder(spark, "mixing-rows"))
    # What is missing (or too much) by source, and the room of each range of its hash order.
    add = F.floor(limit * F.col("size")).cast("long") - F.col("whole")
    ranges = rows.groupBy("source", "range").agg(
        F.sum("whole").alias("whole"), F.sum(add).alias("add"), F.first("target").alias("target")
    )
    source = Window.partitionBy("source")
    ahead = source.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        ranges.withColumn(
            "miss", F.round(F.col("target")).cast("long") - F.sum("whole").over(source))
        .withColumn("before", F.coalesce(
            F.sum(F.when(F.col("miss") > 0, F.col("add")).otherwise(F.col("whole"))).over(ahead),
            F.lit(0)))
        .where("before < abs(miss)")
        .select("source", "range", "miss", "before")
    )
    joined = rows.alias("r").join(
        ranges.alias("m"),
        F.col("r.source").eqNullSafe(F.col("m.source")) & (F.col("r.range") == F.col("m.range")),
        "left",
    ).select("r.*", "miss", "before")
    room = F.when(F.col("miss") > 0, add).when(F.col("miss") < 0, F.col("whole")).otherwise(0)
    spots = Window.partitionBy("source", "range").orderBy(
        "spot", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    touched = joined.where("miss is not null").withColumn(
        "start", F.col("before") + F.coalesce(F.sum(room).over(spots), F.lit(0)))
    change = F.greatest(F.lit(0), F.least(room, F.abs(F.col("miss")) - F.col("start")))
    columns = ["doc_id", "source", "size", "source_size", "target"]
    return touched.select(
        *columns, (F.col("whole") + F.signum("miss") * change).cast("long").alias("taken")
    ).unionAll(joined.where("miss is null").select(*columns, F.col("whole").alias("taken")))


def op7_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix(read(spark, folder, "documents")).drop("source")


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents as often as the mix takes them; a part of a copy is its first words.

    Rows of equal id are all taken like the one of them that is taken most.
    """
    takes = mix(docs).where("taken > 0").groupBy("doc_id").agg(
        F.max(F.struct("taken", "size")).alias("most")).select("doc_id", "most.*")
    text, doc_id = number(docs, "text"), F.col(number(docs, "doc_id"))
    split = F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    part = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    rows = numbered(docs)
    columns = rows.columns
    rows = rows.join(takes, doc_id.eqNullSafe(F.col("doc_id"))).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size"))))
    )
    cut = F.when(part < F.col("size"), F.array_join(F.slice(split, 1, part.cast("int")), " "))
    rows = rows.withColumn(text, F.coalesce(cut, F.col(text)))
    if "n_chars" in docs.columns:
        chars = number(docs, "n_chars")
        rows = rows.withColumn(chars, F.length(text).cast(rows.schema[chars].dataType))
    return rows.select(*columns).toDF(*docs.columns)
