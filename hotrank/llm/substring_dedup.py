"""Substring dedup by de Bruijn compaction over sampled token k-mers."""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotrank.llm.common import number, numbered, pack, packed, pick, read, small, texts, unpacked
from hotrank.llm.hashing import runs, stretches, word_hashes
from hotrank.session import as_table, fresh_folder

#: Words of a node.
NODE = 8
_NO_ID = -(1 << 63)


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all ``NODE``-word runs, and of each window which of its runs hashes lowest.

    Third the places so chosen, ascending: the nodes a text is sampled at. Equal windows choose
    alike wherever they stand.
    """
    nodes = runs(words, NODE)
    width = window - NODE + 1
    if len(nodes) < width:
        return nodes, np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(nodes) - width + 1
    # What ``sliding_window_view`` gives, without its checks, which cost more than the search.
    chosen = np.ndarray((n, width), nodes.dtype, nodes, 0, nodes.strides * 2).argmin(1)
    chosen += np.arange(n)
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(chosen[1:], chosen[:-1], out=first[1:])
    return nodes, chosen, chosen[first]


def _nodes(window: int):
    """Nodes of all texts, one row per place."""

    def run(batches):
        for batch in small(batches, 8 << 20):
            found = [np.zeros(0, np.uint64)]
            for text in texts(batch.column("text")):
                nodes, _, at = anchors(word_hashes(text), window)
                found.append(nodes[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found).view(np.int64))], names=["node"])

    return run


def _graph(window: int):
    """Nodes of each text, with the edges that lead on from them."""

    def run(batches):
        for batch in small(batches, 8 << 20):
            of, parts = [], []
            for i, text in enumerate(texts(batch.column("text"))):
                words = word_hashes(text)
                nodes, _, at = anchors(words, window)
                if not len(at):
                    continue
                to = np.append(at[1:] + NODE, len(words))
                # The ways in and out of a text are edges of kinds of their own.
                kinds = np.zeros(len(at) + 1, np.int64)
                kinds[-2:] = 2, 1
                edges = stretches(words, np.append(at, 0), np.append(to, at[0] + NODE), kinds)
                way_in = np.zeros(len(at), np.uint64)
                way_in[0] = edges[-1]
                of.append(np.full(len(at), i))
                parts.append((nodes[at], at, to, edges[:-1], way_in))
            if not of:
                continue
            rows = pa.array(np.concatenate(of))
            node, at, to, edge, way_in = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(rows), batch.column("txt").take(rows),
                 pa.array(node.view(np.int64)), pa.array(at.astype(np.int32)),
                 pa.array(to.astype(np.int32)), pa.array(edge.view(np.int64)),
                 pa.array(way_in.view(np.int64), mask=way_in == 0)],
                names=["doc", "txt", "node", "at", "until", "edge", "way_in"],
            )

    return run


def resolve(key, n_words: int, edges, counts: dict[int, int], window: int):
    """What is known of a text's windows from its repeated edges alone.

    ``edges``: (start, end, count, first place), ``counts``: occurrences of repeated nodes by
    place. Gives a mask of windows that start earlier elsewhere, and the unbranched paths as
    (start, end, places of inner nodes).

    Consecutive edges whose first places are consecutive too spell out, together, a stretch
    that stands earlier at those coordinates. Where an edge, the next edge and the node between
    occur equally often, no text branches off: windows around such a node, within the path of
    unbranched nodes, stand wherever the path does, and only there.
    """
    n = n_words - window + 1
    earlier = np.zeros(n, bool)
    edges = sorted(edges)
    chain = path = None
    inner: list[int] = []

    def close_chain():
        if chain is not None:
            earlier[chain[0] : max(chain[0], chain[1] - window + 1)] = True

    def close_path():
        # A window belongs to the node it chose, so only those around inner nodes are settled.
        if inner:
            paths.append((path[0], path[1], inner))

    paths: list = []
    last = None
    for start, end, count, first in edges:
        follows = last is not None and start == last[1] - NODE and start >= last[0]
        is_earlier = first < (*key, start)
        if (
            chain is not None and follows and is_earlier and first[:2] == last[3][:2]
            and first[2] - last[3][2] == start - last[0]
        ):
            chain = (chain[0], end)
        else:
            close_chain()
            chain = (start, end) if is_earlier else None
        if path is not None and follows and count == last[2] == counts.get(start):
            inner.append(start)
            path = (path[0], end)
        else:
            close_path()
            path, inner = (start, end), []
        last = (start, end, count, first)
    close_chain()
    close_path()
    return earlier, paths


def listed(column: pa.Array):
    """Rows of each list of structs, as tuples; structs in a struct become tuples in one.

    Values leave Arrow column by column: taken one by one they would cost more than all else.
    """
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))

    def rows(fields, start, end):
        return zip(*(
            rows(f, start, end) if isinstance(f, list) else f[start:end].tolist() for f in fields))

    fields = _fields(column.flatten())
    for start, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
        yield rows(fields, start, end)


def _fields(structs: pa.StructArray) -> list:
    return [_fields(x) if pa.types.is_struct(x.type) else x.to_numpy() for x in structs.flatten()]


def _settle(window: int, digest: bool):
    def run(batches):
        for batch in small(batches, 8 << 20):
            out = []
            columns = [batch.column(c).to_pylist() for c in ("doc", "txt")]
            columns += [listed(batch.column(c)) for c in ("edges", "nodes")]
            for text, doc, txt, edges, nodes in zip(unpacked(batch.column("text")), *columns):
                words = text.split()
                n = len(words)
                counts = dict(nodes)
                if n < window or not counts:
                    out.append((doc, txt, n, 0, _kept(words, None, digest), None, None, [], [], []))
                    continue
                hashes = word_hashes(text)
                _, chosen, _ = anchors(hashes, window)
                earlier, paths = resolve((doc, txt), n, set(edges), counts, window)
                windows, settled = np.arange(len(chosen)), np.zeros(len(chosen), bool)
                for start, end, inner in paths:
                    span = slice(start, max(start, end - window + 1))
                    settled[span] |= _places(inner, n)[chosen[span]]
                open_ = _places(list(counts), n)[chosen] & ~earlier & ~settled
                left = windows[open_]
                if not len(left):
                    mask = covered(windows[earlier], n, window)
                    out.append((doc, txt, n, int(mask.sum()), _kept(words, mask, digest), None, None,
                                [], [], []))
                    continue
                a, b = (runs(hashes, window, seed)[left].view(np.int64) for seed in (3, 4))
                out.append((doc, txt, n, None, None, pack(text), np.packbits(earlier).tobytes(),
                            left, a, b))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
                     pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()),
                     pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                names=["doc", "txt", "n_words", "n_removed", "kept", "text", "earlier", "at",
                       "hash_a", "hash_b"],
            )

    return run


def _places(at: list[int], n: int) -> np.ndarray:
    mask = np.zeros(n, bool)
    mask[at] = True
    return mask


def covered(starts: np.ndarray, n_words: int, window: int) -> np.ndarray:
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return np.cumsum(steps[:-1]) > 0


def _kept(words: list[bytes], mask, digest: bool) -> str:
    text = b" ".join(words if mask is None else compress(words, ~mask))
    return hashlib.sha256(text).hexdigest() if digest else text.decode()


def _finish(window: int, digest: bool):
    def run(batches):
        for batch in small(batches, 8 << 20):
            out = []
            columns = [batch.column(c).to_pylist() for c in ("doc", "txt", "earlier", "later")]
            for text, doc, txt, bits, later in zip(unpacked(batch.column("text")), *columns):
                words = text.split()
                n = len(words) - window + 1
                earlier = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
                earlier[later or []] = True
                mask = covered(np.flatnonzero(earlier), len(words), window)
                out.append((doc, txt, len(words), int(mask.sum()), _kept(words, mask, digest)))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                names=["doc", "txt", "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20,
    digest: bool = False,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: texts without words that repeat an earlier window.

    A window is ``window`` consecutive words; a word goes when a window over it stands earlier
    (smaller id, or same document and earlier start). Windows are judged on the input.

    Nodes of the graph are 8-word runs, sampled so that every window holds the node it chose;
    edges are the stretches from node to node. Nodes that occur once rule their windows out.
    Repeated edges are joined with their count and first place. Each text then compacts its
    unbranched paths and compares coordinates along them; only windows at branchings are counted
    one by one, by 128-bit hashes. Counts and first places are aggregated before they are
    joined back, so hot passages split like any skewed join.

    Null, empty and blank texts: no words, nothing kept. Texts shorter than a window stay.
    Equal rows share their coordinates and are judged alike; different texts of one id are
    ordered and told apart by 16 bits of a hash. Null ids come first. One row per row of ``docs``, kept words
    joined by one blank; with ``digest``, their SHA-256 instead.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).select(*_key("doc_id", "text"), "text")
    return _judge(rows, window, digest).select(
        F.nullif("doc", F.lit(_NO_ID)).alias("doc_id"), "n_words", "n_removed", "kept")


def _key(doc_id: str, text: str) -> tuple:
    return (
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("doc"),
        F.pmod(F.xxhash64(text), F.lit(1 << 16)).alias("txt"),
    )


def _judge(rows: DataFrame, window: int, digest: bool) -> DataFrame:
    """``doc, txt, n_words, n_removed, kept`` of rows of ``doc, txt, text``."""
    spark = rows.sparkSession

    def table(df: DataFrame, name: str) -> DataFrame:
        return as_table(df, fresh_folder(spark, f"substring-{name}"))

    graph = rows.mapInArrow(
        _graph(window),
        "doc long, txt long, node long, at int, until int, edge long, way_in long")
    repeated = table(
        rows.select("text").mapInArrow(_nodes(window), "node long").groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "nodes")
    shared = table(graph.join(repeated, "node").drop("node"), "shared")
    edges = shared.select("doc", "txt", F.col("at").alias("a"), F.col("until").alias("b"), "edge")
    edges = edges.unionAll(shared.where("way_in is not null").select(
        "doc", "txt", F.lit(0), F.col("at") + NODE, "way_in"))
    ways = table(
        edges.groupBy("edge").agg(
            F.count("*").alias("n"), F.min(F.struct("doc", "txt", "a")).alias("f"))
        .where("n > 1"), "edges")
    by_text = table(
        edges.join(ways, "edge").groupBy("doc", "txt").agg(
            F.collect_list(F.struct("a", "b", "n", "f")).alias("edges")), "by-text")
    node_lists = shared.groupBy("doc", "txt").agg(
        F.collect_list(F.struct("at", "n")).alias("nodes"))
    key = ["doc", "txt"]
    judged = table(
        packed(rows).join(by_text, key, "left").join(node_lists, key, "left")
        .mapInArrow(
            _settle(window, digest),
            "doc long, txt long, n_words long, n_removed long, kept string, text binary, "
            "earlier binary, at array<int>, hash_a array<long>, hash_b array<long>"),
        "judged")
    left = judged.where("text is not null").select(
        *key, F.explode(F.arrays_zip("at", "hash_a", "hash_b")).alias("w")
    ).select(*key, "w.at", "w.hash_a", "w.hash_b")
    place = F.struct("doc", "txt", "at")
    pair = ["hash_a", "hash_b"]
    firsts = table(
        left.groupBy(*pair).agg(F.count("*").alias("n"), F.min(place).alias("f"))
        .where("n > 1").drop("n"), "windows")
    later = (
        left.join(firsts, pair).where(place > F.col("f"))
        .groupBy(*key).agg(F.collect_set("at").alias("later"))
    )
    columns = [*key, "n_words", "n_removed", "kept"]
    finished = judged.where("text is not null").select(*key, "text", "earlier").join(
        later, key, "left").mapInArrow(
        _finish(window, digest), "doc long, txt long, n_words long, n_removed long, kept string")
    return judged.where("text is null").select(*columns).unionAll(finished.select(*columns))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read(spark, folder, "documents"), digest=True).withColumnRenamed(
        "kept", "kept_sha256")


def without_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents with repeated passages removed, ``n_chars`` counted anew.

    Texts that lose nothing stay as they are, white space included. One row per row: equal rows
    lose the same words, and different texts of one id each their own.
    """
    doc_id, text = number(docs, "doc_id"), number(docs, "text")
    rows = numbered(docs)
    columns = rows.columns
    rows = rows.select("*", *_key(doc_id, text))
    judged = _judge(rows.select("doc", "txt", F.col(text).alias("text")), 20, False)
    kept = judged.where("n_removed > 0").select("doc", "txt", "kept").dropDuplicates(["doc", "txt"])
    rows = rows.join(kept, ["doc", "txt"], "left").withColumn(text, F.coalesce("kept", text))
    if "n_chars" in docs.columns:
        chars = number(docs, "n_chars")
        rows = rows.withColumn(chars, F.length(text).cast(rows.schema[chars].dataType))
    return rows.select(*columns).toDF(*docs.columns)
