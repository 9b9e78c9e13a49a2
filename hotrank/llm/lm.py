"""Language-model scores: marginals of subword lattices over an existing vocabulary."""

from __future__ import annotations

import math
from collections import Counter
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotrank.llm.common import LOWER, fold, pick, read, small, texts
from hotrank.session import as_table, fresh_folder

VOCABULARY = "piece_bpe_32k.model"
#: Words that make up at least this share of all words are known to every task: 1 / HEAD at most.
HEAD = 200_000
#: Distinct words a task counts before it hands them on.
_HELD = 250_000
#: Probability of the end among pieces, and of all bytes of characters outside the vocabulary.
_END, _BYTES = 0.01, 0.001


def piece_scores(path: str | None = None) -> list[tuple[str, float]]:
    """The vocabulary's pieces with the log probability that follows from their scores.

    Scores of this vocabulary are ranks below zero. Ranks are weighed by the Zipf-Mandelbrot law,
    1 / (rank + 2.7); the rest of the mass is for the end and for single bytes.
    """
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {}
    for i in range(model.get_piece_size()):
        score = model.get_score(i)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and score > -1e8:
            found[model.id_to_piece(i)] = 1 / (2.7 - score)
    total = sum(found.values())
    mass = math.log((1 - _END - _BYTES) / total)
    return [(piece, math.log(weight) + mass) for piece, weight in found.items()]


def learnt_pieces(pieces: list[tuple[str, float]], counts: dict[str, int]) -> list[tuple[str, float]]:
    """``pieces`` weighed by how often words learnt from are cut into them.

    A piece never used keeps its given share of one count, so that nothing becomes impossible.
    """
    given = sum(math.exp(log_p) for _, log_p in pieces)
    weights = [counts.get(piece, 0) + math.exp(log_p) / given for piece, log_p in pieces]
    mass = math.log((1 - _BYTES) / sum(weights))
    return [(piece, math.log(weight) + mass) for (piece, _), weight in zip(pieces, weights)]


def _model_bytes(path: str | None) -> bytes:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as file:
        return file.read()


def _cut(shared):
    """How often the words of a task, each taken once, are cut into each piece."""

    def run(batches):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        counts = np.zeros(model.get_piece_size(), np.int64)
        for batch in small(batches, 4 << 20):
            cut = model.encode(batch.column("token").to_pylist())
            counts += np.bincount(
                np.fromiter(chain.from_iterable(cut), np.int64), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.id_to_piece(int(i)) for i in used], pa.string()), pa.array(counts[used])],
            names=["piece", "uses"])

    return run


class Lattice:
    """Marginal log probability of words over all their segmentations."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, log_p in pieces:
            self.automaton.add_word(piece, (len(piece), log_p))
        self.automaton.make_automaton()
        self.byte = math.log(_BYTES / 256)

    def log_marginal(self, word: str) -> float:
        """Forward recursion in log space over the ends of pieces.

        A word starts with the blank mark, and pieces do not reach past the next one, so the
        marginal of a text is the product of its words'. Every character may also be spelt in
        bytes.
        """
        text = "▁" + word
        ends: list[list] = [[] for _ in text]
        for end, piece in self.automaton.iter(text):
            ends[end].append(piece)
        alpha = [0.0]
        for end, char in enumerate(text):
            terms = [alpha[end] + self.byte * len(char.encode())]
            for size, log_p in ends[end]:
                terms.append(alpha[end + 1 - size] + log_p)
            top = max(terms)
            alpha.append(top + math.log(sum([math.exp(t - top) for t in terms])))
        return alpha[-1]


def _count(batches):
    """Words with how often they occur in all texts and in those learnt from."""
    every: Counter = Counter()
    learnt: Counter = Counter()

    def handed():
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(every), pa.binary()).cast(pa.string()),
             pa.array(every.values(), pa.int64()),
             pa.array([learnt[w] for w in every], pa.int64())],
            names=["token", "n", "c"],
        )
        every.clear()
        learnt.clear()
        return batch

    for batch in small(batches, 4 << 20):
        for text, held_out in zip(texts(batch.column("text")), batch.column("held_out").to_pylist()):
            words = text.translate(LOWER).split()
            every.update(words)
            if not held_out:
                learnt.update(words)
        if len(every) > _HELD:
            yield handed()
    yield handed()


def _spelt(shared):
    def run(batches):
        lattice = Lattice(shared.value)
        for batch in small(batches):
            logs = [lattice.log_marginal(w) for w in batch.column("token").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(logs, pa.float64())],
                names=[*batch.schema.names, "log_l"],
            )

    return run


def _score_head(shared, end):
    """A row per document with the sums over its common words and the end, and one per other word.

    A document's own row goes under a blank and its number, which no word can be, and alone
    carries the document's columns.
    """

    def run(batches):
        common = shared.value
        for batch in small(batches, 4 << 20):
            row, token, times, known, base, model, count, owner = [], [], [], [], [], [], [], []
            for place, (number, text) in enumerate(zip(
                batch.column("row").to_pylist(), texts(batch.column("text"))
            )):
                counts = Counter(text.translate(LOWER).split())
                n, (k, b, m), others = 1, end, []
                for word, here in counts.items():
                    n += here
                    entry = common.get(word)
                    if entry is None:
                        others.append(word)
                    else:
                        k += entry[0] * here
                        b += entry[1] * here
                        m += entry[2] * here
                rest = [0] * len(others)
                row += [number] * (len(others) + 1)
                token += [b" %d" % number, *others]
                times += [0, *[counts[w] for w in others]]
                for column, own in ((known, k), (base, b), (model, m), (count, n)):
                    column.append(own)
                    column += rest
                owner.append(place)
                owner += [None] * len(others)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int64()), pa.array(token, pa.binary()).cast(pa.string()),
                 pa.array(times, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(model, pa.float64()),
                 pa.array(count, pa.int64()),
                 *[batch.column(c).take(pa.array(owner, pa.int64())) for c in ("doc_id", "held_out")]],
                names=["row", "token", "times", "known", "base", "model", "n_tokens", "doc_id", "held_out"],
            )

    return run


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    remainder: int = 1, vocabulary: str | None = None, learn: bool = False,
) -> DataFrame:
    """Base and model scores of every whole text; one row per row of ``docs``.

    Learns word counts from the rows whose crc32(id) mod 5 is not ``remainder`` (a null id is
    learnt from). ``base_score`` is the add-half word model. ``score`` is the log10 marginal of
    the text, its words joined by single blanks and followed by the end: the probability of all
    its segmentations into the pieces of an existing vocabulary, weighted by that vocabulary's
    scores. As no piece passes a blank, a text's marginal is the product of its words', and the
    forward recursion runs once per distinct word of the corpus.

    With ``learn`` the lattice is fitted to the rows learnt from. Every word of theirs is a piece as
    well, one that ends its word, so just one segmentation more; it weighs its count less a
    discount. What the discounts free is for words spelt in pieces of the vocabulary, which weigh
    as often as the words learnt from, each taken once, are cut into them. ``score`` is the
    marginal over all segmentations as before.

    Every word of the corpus is counted: inside tasks first, then by shuffle. Words of at least
    1 / ``HEAD`` of all occurrences, of which there can be ``HEAD`` at most, are broadcast; the
    others, none of which is hot, meet their counts in a join. Null and empty texts are one end.
    Repeated rows and rows of equal or null id are scored row by row. An empty table gives none.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    held_out = F.coalesce(fold() == remainder, F.lit(False)).alias("held_out")
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", held_out, "text")
    pieces = piece_scores(vocabulary)
    words = as_table(
        rows.select("held_out", "text").mapInArrow(_count, "token string, n long, c long")
        .groupBy("token").agg(F.sum("n").alias("n"), F.sum("c").alias("c")),
        fresh_folder(spark, "lm-counts"),
    )
    sums = words.agg(
        F.sum("n").alias("all"), F.sum("c").alias("learnt"),
        F.count(F.when(F.col("c") > 0, 1)).alias("distinct"),
        F.count(F.when(F.col("c") == 1, 1)).alias("once"),
        F.count(F.when(F.col("c") == 2, 1)).alias("twice"),
    ).first()
    if learn:
        # No more rows than the vocabulary has pieces.
        uses = words.where("c > 0").select("token").mapInArrow(
            _cut(context.broadcast(_model_bytes(vocabulary))), "piece string, uses long")
        counts = dict(uses.groupBy("piece").agg(F.sum("uses")).collect())
        pieces = learnt_pieces(pieces, counts)
    words = as_table(
        words.mapInArrow(
            _spelt(context.broadcast(pieces)), "token string, n long, c long, log_l double"),
        fresh_folder(spark, "lm-words"),
    )
    ends = rows.where("not held_out").count()
    n = (sums["learnt"] or 0) + ends
    distinct = sums["distinct"] + (ends > 0)
    under = math.log10(n + 0.5 * (distinct + 1))
    model, end = F.col("log_l") / math.log(10), _END
    if learn:
        # One count more for a word that is spelt, and one for an end.
        off = min(0.9, max(0.1, sums["once"] / max(1, sums["once"] + 2 * sums["twice"])))
        end = (ends + 1) / (n + 2)
        spelt = model + math.log10((off * sums["distinct"] + 1) / (n + 2))
        whole = F.log10((F.col("c") - off) / (n + 2))
        both = F.greatest(spelt, whole) + F.log10(1 + F.pow(F.lit(10.0), -F.abs(spelt - whole)))
        model = F.when(F.col("c") > 0, both).otherwise(spelt)
    words = words.select(
        "token", "n", (F.col("c") > 0).cast("long").alias("w_known"),
        (F.log10(F.col("c") + 0.5) - under).alias("w_base"), model.alias("w_model"),
    )
    is_common = F.col("n") * HEAD >= (sums["all"] or 0)
    head = {t.encode(): of for t, *of in words.where(is_common).drop("n").collect()}
    kind = rows.schema["doc_id"].dataType.simpleString()
    of_end = int(ends > 0), math.log10(ends + 0.5) - under, math.log10(end)
    parts = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        _score_head(context.broadcast(head), of_end),
        "row long, token string, times long, known long, base double, model double, "
        f"n_tokens long, doc_id {kind}, held_out boolean",
    )
    rare = words.where(~is_common).drop("n")

    def total(own, word):
        return F.sum(F.col(own) + F.col("times") * F.coalesce(F.col(word), F.lit(0)))

    return parts.join(rare, "token", "left").groupBy("row").agg(
        # A row that stands for a rare word has neither id nor fold.
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"), total("known", "w_known").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), total("base", "w_base").alias("base_score"),
        total("model", "w_model").alias("score"),
    ).drop("row")


def op6_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(read(spark, folder, "documents"), learn=True)
