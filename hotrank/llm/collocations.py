"""Phrase collocation mining: double-array tries of Apriori-safe candidates, walked by all places at once."""

from __future__ import annotations

import pickle
import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hotrank.llm.common import LOWER, cuts, pack, pick, read, small, texts
from hotrank.llm.hashing import _STEP, hash_words, mixed
from hotrank.session import as_table, fresh_folder

#: Occurrences a phrase needs, and the most words it has.
LEAST, LONGEST = 30, 4
#: A phrase goes when a longer one holds it in this share (percent) of its places.
HOLDS = 80
PLACES = 2000
#: Phrases of one trie, some tens of MB; more phrases make more tries.
TRIE = 1 << 17
#: A word's code is walked in three digits of so many bits.
_BITS, _DIGITS = 7, 3
#: Nodes with more children than this get a span of their own, others share.
_FEW = 12
#: Bytes of text walked at a time, and pairs or words a task holds before it hands them on.
_LOT, _HELD = 2 << 20, 1 << 20
#: Words a task holds while it walks them through one trie after the other.
_BLOCK = 1 << 23
#: Words numbered up to here are looked up in an array.
_DENSE = 1 << 25
#: Bytes of folded tries that are broadcast at a time; more make more rounds.
_ROUND = 48 << 20
_WORD = re.compile(rb"[^\x20\x09.,;:!?\x0A-\x0D]+")
_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def _lang_key(lang: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang)


def _langs(batch) -> list[bytes]:
    return [b"und" if x is None else x for x in batch.column("lang").cast(pa.binary()).to_pylist()]


def _words(seed: int):
    """``key, lang, word, n`` of the words of a task."""

    def run(batches):
        held: dict[bytes, Counter] = {}

        def handed():
            for lang, counts in held.items():
                words = list(counts)
                data = np.frombuffer(b"\n".join(words), np.uint8)
                hashes = hash_words(data, _KIND[data] == 0, seed)[1]
                keys = mixed(hashes + np.uint64(_lang_key(lang)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array([lang.decode()] * len(words), pa.string()),
                     pa.array(words, pa.binary()).cast(pa.string()),
                     pa.array(np.fromiter(counts.values(), np.int64, len(words)))],
                    names=["key", "lang", "word", "n"])
            held.clear()

        for batch in small(batches, 4 << 20):
            for lang, text in zip(_langs(batch), texts(batch.column("text"))):
                counts = held.setdefault(lang, Counter())
                for part in cuts(text, _END):
                    counts.update(_WORD.findall(part.translate(LOWER)))
            if sum(map(len, held.values())) > _HELD // 2:
                yield from handed()
        yield from handed()

    return run


class Trie:
    """Double array over phrases of one length: ``base[state] + digit`` is the next state where
    ``check`` there names the state. Built from rows of word keys; the n-th row's end accepts n, which
    stands as its ``base``, since no phrase goes on from the end of another."""

    def __init__(self, phrases: np.ndarray):
        self.length = phrases.shape[1]
        self.keys, codes = np.unique(phrases, return_inverse=True)
        if len(self.keys) > 1 << (_BITS * _DIGITS):
            raise ValueError("too many words for one trie")
        codes = codes.reshape(phrases.shape)
        digits = np.stack(
            [(codes >> (_BITS * (_DIGITS - 1 - i))) & ((1 << _BITS) - 1) for i in range(_DIGITS)], 2
        ).reshape(len(phrases), -1)
        span, rng = 1 << _BITS, np.random.default_rng(len(phrases))
        # Which node each phrase has come to, level by level.
        levels, node = [], np.zeros(len(phrases), np.int64)
        for level in range(digits.shape[1]):
            moves, node_next = np.unique(node * span + digits[:, level], return_inverse=True)
            levels.append(moves)
            node = node_next
        last, total = node, sum(map(len, levels))
        crowded = sum(int((np.bincount(m // span) > _FEW).sum()) for m in levels)
        size = 1 + (crowded + 1) * span + 6 * total + span
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.check[0] = 0
        free = 1
        slots = np.zeros(1, np.int64)
        for moves in levels:
            parent, digit = moves // span, moves % span
            counts = np.bincount(parent, minlength=len(slots))
            bases = np.zeros(len(slots), np.int64)
            many = np.flatnonzero(counts > _FEW)
            bases[many] = free + span * np.arange(len(many))
            free += span * len(many)
            to = bases[parent] + digit
            own = counts[parent] > _FEW
            self.check[to[own]] = slots[parent[own]]
            # The rest share the far end: bases are drawn until no two children meet.
            start = size - 6 * total - span
            open_ = np.flatnonzero(~own)
            while len(open_):
                bases_new = rng.integers(start, size - span, len(slots))
                at = bases_new[parent[open_]] + digit[open_]
                meets = self.check[at] != -1
                _, first = np.unique(at, return_index=True)
                again = np.ones(len(at), bool)
                again[first] = False
                clash = np.zeros(len(slots), bool)
                clash[parent[open_[meets | again]]] = True
                placed = ~clash[parent[open_]]
                done = open_[placed]
                bases[parent[done]] = bases_new[parent[done]]
                to[done] = at[placed]
                self.check[at[placed]] = slots[parent[done]]
                open_ = open_[~placed]
            self.base[slots] = bases
            slots = to
        self.base[slots[last]] = np.arange(len(phrases))

    def _codes(self, words: np.ndarray) -> np.ndarray:
        """Number of each word in this trie, -1 for others."""
        codes = np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)
        return np.where(self.keys[codes] == words, codes, -1)

    def walk(self, words: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places where a phrase starts, and which; ``words`` are keys, 0 between pieces.

        ``at``: the places to look at, none so late that a phrase would not fit; otherwise all.
        """
        lookup = self._codes
        if at is None:
            codes = np.append(self._codes(words), np.full(self.length, -1))
            words, at, lookup = codes, np.arange(len(words)), lambda found: found
        elif 0 < self.keys[0] and self.keys[-1] < _DENSE:
            table = np.full(int(self.keys[-1]) + 2, -1, np.int32)
            table[self.keys] = np.arange(len(self.keys), dtype=np.int32)
            lookup = lambda found: table.take(found, mode="clip")
        state = np.zeros(len(at), np.int32)
        for step in range(self.length):
            code = lookup(words[at + step])
            known = code >= 0
            at, state, code = at[known], state[known], code[known]
            for i in range(_DIGITS - 1, -1, -1):
                to = self.base[state] + ((code >> (_BITS * i)) & ((1 << _BITS) - 1))
                there = self.check[to] == state
                at, state, code = at[there], to[there], code[there]
        return at, self.base[state]


def _lots(columns, lots: int) -> np.ndarray:
    """The lot that the phrase of these words, a column for each, is dealt to."""
    found = np.zeros(len(columns[0]), np.uint64)
    for words in columns:
        found *= _STEP
        found += words.astype(np.uint64)
    return ((mixed(found) >> np.uint64(32)) % np.uint64(lots)).astype(
        np.uint16 if lots <= 1 << 16 else np.int64)


def sequences(batches, seed: int):
    """Keys of the words of all texts, lot by lot, with 0 between pieces."""
    for batch in small(batches, 4 << 20):
        lot, langs, size = [], [], 0
        for lang, text in zip(_langs(batch), texts(batch.column("text"))):
            for part in cuts(text, _END):
                lot.append(part)
                langs.append(_lang_key(lang))
                size += len(part) + 1
                if size >= _LOT:
                    yield _sequence(lot, langs, seed)
                    lot, langs, size = [], [], 0
        if lot:
            yield _sequence(lot, langs, seed)


def _sequence(lot: list[bytes], langs: list[int], seed: int) -> np.ndarray:
    data = np.frombuffer(b"\n".join(lot).translate(LOWER), np.uint8)
    kind = _KIND[data]
    starts, hashes = hash_words(data, kind == 0, seed)
    ends = np.cumsum([len(x) + 1 for x in lot])
    lang = np.array(langs, np.uint64)[np.searchsorted(ends, starts, "right")]
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    apart = np.cumsum(np.append(False, piece[1:] != piece[:-1])) if len(piece) else piece
    words = np.zeros(len(starts) + (int(apart[-1]) if len(piece) else 0), np.int64)
    words[np.arange(len(starts)) + apart] = mixed(hashes + lang).view(np.int64)
    return words


def _blocks(lots, size: int):
    """Lists of lots that hold some ``size`` words together."""
    block, held = [], 0
    for lot in lots:
        block.append(lot)
        held += len(lot)
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def _folded(trie: Trie) -> bytes:
    # Its arrays without its class, which workers may hold under another identity.
    sizes = np.array([trie.length, len(trie.keys), len(trie.base)], np.int64)
    return pack(b"".join(x.tobytes() for x in (sizes, trie.keys, trie.base, trie.check)))


def _unfolded(trie: bytes) -> Trie:
    data = zstandard.ZstdDecompressor().decompress(trie)
    if data[:1] == b"\x80":  # a pickled trie
        return pickle.loads(data)
    found = Trie.__new__(Trie)
    found.length, n_keys, size = np.frombuffer(data, np.int64, 3).tolist()
    found.keys = np.frombuffer(data, np.int64, n_keys, 24)
    found.base = np.frombuffer(data, np.int32, size, 24 + 8 * n_keys)
    found.check = np.frombuffer(data, np.int32, size, 24 + 8 * n_keys + 4 * size)
    return found


def _routed(words, at, tries, starts, length: int, which) -> None:
    """Sets in ``which`` the phrase that starts at each place of ``at``; the n-th trie, if there,
    holds the phrases dealt to lot n. One trie is unfolded at a time."""
    at, lots = at.astype(np.int32), np.zeros(len(at), np.uint16 if len(tries) <= 1 << 16 else np.int64)
    for start in range(0, len(at), 1 << 20):
        some = slice(start, start + (1 << 20))
        lots[some] = _lots([words[at[some] + i] for i in range(length)], len(tries))
    here = np.array([folded is not None for folded in tries])
    if not here.all():
        kept = here[lots]
        at, lots = at[kept], lots[kept]
    order = np.argsort(lots, kind="stable")
    at = at[order]
    del order
    ends = np.cumsum(np.bincount(lots, minlength=len(tries)))
    del lots
    for start, folded, first, end in zip(starts, tries, np.append(0, ends), ends):
        if folded is not None and first < end:
            trie = _unfolded(folded)
            places, found = trie.walk(words, at[first:end])
            which[places] = start + found
            del trie


def _found(
    block: list[np.ndarray], tries: list[bytes | None], starts: np.ndarray, length: int = 0,
) -> list[np.ndarray]:
    """Which phrase starts at each place of a block, -1 for none; one trie is unfolded at a time.

    With ``length`` the n-th trie holds the phrases of that length dealt to lot n, so each place is
    walked through one trie, however many there are. Otherwise all are walked through all.
    """
    if not length:
        which = [np.full(len(words) + 1, -1, np.int64) for words in block]
        for start, folded in zip(starts, tries):
            trie = _unfolded(folded)
            for words, of in zip(block, which):
                at, found = trie.walk(words)
                of[at] = start + found
            del trie
        return which
    # What crosses from one list of words to the next has the 0 between them.
    ends = np.cumsum([len(words) + 1 for words in block])
    words = np.zeros(ends[-1], block[0].dtype)
    for some, end in zip(block, ends):
        words[end - 1 - len(some) : end - 1] = some
    which = np.full(len(words), -1, np.int32)
    whole = words[: max(0, len(words) - length + 1)] != 0
    for i in range(1, length):
        whole &= words[i : i + len(whole)] != 0
    _routed(words, np.flatnonzero(whole), tries, starts, length, which)
    return np.split(which, ends[:-1])


def _held(tries):
    """Ids of the phrases, the tries by lot, and where the places of each lot's phrases start."""
    parts = [trie.value if trie else (np.zeros(0, np.int32), None) for trie in tries]
    ids = np.concatenate([ids for ids, _ in parts])
    return ids, [folded for _, folded in parts], np.cumsum([0, *(len(ids) for ids, _ in parts)])


def _coded(tries, seed: int):
    """``codes``: per lot the numbers of its words, 0 for words that are in no trie and between
    pieces, as compressed integers of 32 bits."""

    def run(batches):
        ids, folded, starts = _held(tries)
        codes = np.append(ids, 0).astype(np.int32)
        for block in _blocks(sequences(batches, seed), _BLOCK // 4):
            for which in _found(block, folded, starts, 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pack(codes[which].tobytes())], pa.binary())], names=["codes"])

    return run


def _uncoded(column: pa.Array):
    read = zstandard.ZstdDecompressor()
    for packed in column:
        yield np.frombuffer(read.decompress(packed.as_py()), np.int32)


def _marked(tries, length: int):
    """``codes, before, now``, ``now`` with the numbers of the phrases of ``length`` words in these
    tries where they start. ``before`` are the numbers of phrases one word shorter; only where one of
    them starts, and one at the next place, a phrase can. ``now`` is null before the first round."""

    def run(batches):
        ids, folded, starts = _held(tries)

        def lots():
            for batch in batches:
                for row in range(batch.num_rows):
                    yield [batch.column(name)[row].as_buffer() for name in ("codes", "before", "now")]

        read, lot = zstandard.ZstdDecompressor(), []

        def array(column: int):
            return np.concatenate([np.frombuffer(read.decompress(row[column]), np.int32) for row in lot])

        def marked():
            before = array(1)
            at = np.flatnonzero((before[:-1] > 0) & (before[1:] > 0))
            now = np.zeros(len(before), np.int32) if lot[0][2] is None else array(2)
            del before
            at = at[now[at] == 0]
            which = np.full(len(now), -1, np.int32)
            _routed(array(0), at, folded, starts, length, which)
            del at
            there = np.flatnonzero(which >= 0)
            now[there] = ids[which[there]]
            del which, there
            start = 0
            for codes, of, _ in lot:
                n = zstandard.frame_content_size(codes) // 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bytes(x)], pa.binary())
                     for x in (codes, of, pack(now[start : start + n].tobytes()))],
                    names=["codes", "before", "now"])
                start += n

        size = 0
        for row in lots():
            lot.append(row)
            size += zstandard.frame_content_size(row[0]) // 4
            if size >= _BLOCK:
                yield from marked()
                lot.clear()
                size = 0
        if lot:
            yield from marked()

    return run


def _walked(n_phrases: int, pairs: bool):
    """``a, b, n``: occurrences of each of the phrases whose numbers, from 1, stand where they start
    (b is null) and, with ``pairs``, of each phrase directly followed, one word on, by another:
    together they are one word longer."""

    def run(batches):
        counts = np.zeros(n_phrases + 1, np.int64)
        held, sizes, total = [], [], 0

        def merged():
            found, at = np.unique(np.concatenate(held), return_inverse=True)
            return found, np.bincount(at, np.concatenate(sizes)).astype(np.int64)

        def handed(found, n):
            yield pa.RecordBatch.from_arrays(
                [pa.array(found // len(counts)), pa.array(found % len(counts)), pa.array(n)],
                names=["a", "b", "n"])

        for which in chain.from_iterable(_uncoded(batch.column(0)) for batch in batches):
            seen, n = np.unique(which[which > 0], return_counts=True)
            counts[seen] += n
            if not pairs:
                continue
            on = np.flatnonzero((which[:-1] > 0) & (which[1:] > 0))
            found, n = np.unique(
                which[on].astype(np.int64) * len(counts) + which[on + 1], return_counts=True)
            held.append(found)
            sizes.append(n)
            total += len(found)
            if total > 2 * _HELD:
                found, n = merged()
                held, sizes, total = [found], [n], len(found)
                if total > _HELD:
                    yield from handed(found, n)
                    held, sizes, total = [], [], 0
        if held:
            yield from handed(*merged())
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(np.zeros(len(seen), np.int64), mask=np.ones(len(seen), bool)),
             pa.array(counts[seen])], names=["a", "b", "n"])

    return run


def _tries(phrases: DataFrame, n: int) -> tuple[DataFrame, list[list[int]], int]:
    """``lot, ids, trie`` of ``phrases``, built by tasks, the lots of each round, and how many there are."""
    lots = -(-n // TRIE)

    def dealt(batches):
        for batch in batches:
            if batch.num_rows:
                keys = batch.column("keys").flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_lots(list(keys.T), lots).astype(np.int32)),
                     batch.column("id"), batch.column("keys")], names=["lot", "id", "keys"])

    def built(table):
        ids = table["id"].to_numpy()
        keys = table["keys"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        return pa.table({
            "lot": table["lot"][:1], "ids": pa.array([ids.astype(np.int32).tobytes()], pa.binary()),
            "trie": pa.array([_folded(Trie(keys))], pa.binary())})

    made = as_table(
        phrases.select("id", "keys").mapInArrow(dealt, "lot int, id long, keys array<long>")
        .groupBy("lot").applyInArrow(built, "lot int, ids binary, trie binary"),
        fresh_folder(phrases.sparkSession, "phrases-tries"))
    rounds, held = [[]], 0
    for lot, size in sorted(made.select("lot", F.length("ids") + F.length("trie")).collect()):
        if rounds[-1] and held + size > _ROUND:
            rounds.append([])
            held = 0
        rounds[-1].append(lot)
        held += size
    return made, rounds, lots


def _sent(made: DataFrame, chosen: list[int], lots: int) -> list:
    """Ids and trie of each lot chosen as broadcasts, None for the others."""
    context, out = made.sparkSession.sparkContext, [None] * lots
    for row in made.where(F.col("lot").between(chosen[0], chosen[-1])).toLocalIterator():
        out[row.lot] = context.broadcast((np.frombuffer(row.ids, np.int32), bytes(row.trie)))
    return out


def _drop(tries) -> None:
    for trie in filter(None, tries):
        trie.destroy()


def _numbered(phrases: DataFrame) -> DataFrame:
    """``phrases`` with their ids, which count on within each partition, as numbers from 1."""
    part = F.shiftright("id", 33)
    sizes = {r.part: r.n for r in phrases.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    starts = np.cumsum([1, *(sizes.get(i, 0) for i in range(max(sizes, default=0)))]).tolist()
    return phrases.withColumn("id", F.element_at(
        F.array(*(F.lit(x).cast("long") for x in starts)), part.cast("int") + 1)
        + F.col("id").bitwiseAND((1 << 33) - 1))


def mine_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
    longest: int = LONGEST, places: int = PLACES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's phrases that stick together most.

    A-Z in lower case; texts are split into pieces at ``.,;:!?`` and line ends, pieces into words at
    blanks and tabs. ``a`` counts a phrase's places, ``n`` all words of the language. A phrase of
    two to ``longest`` words is cut where a / (l + r) is lowest, l and r being the counts of both
    parts. Phrases with 100 times a longer one's count at or above ``HOLDS`` times theirs, if it
    holds their words in a row, are dropped.

    Level by level: the frequent phrases of a length are put into double-array tries and
    broadcast. Tasks walk the places of their texts through the tries in bulk and count accepting
    states. Where phrases start at one place and the next, they make a candidate one word longer;
    these pairs of numbers are combined in tasks and summed, and what is frequent goes into the
    next tries. One trie holds ``TRIE`` phrases, so a broadcast's size is bounded. Phrases are dealt
    to tries by a hash of their words, so a place is walked through one trie only, and work does not
    grow with their number but for unfolding. Tries travel compressed, ``_ROUND`` bytes at a time
    (those of single words all at once), and a task unfolds one at a time for ``_BLOCK`` words; to
    count, it holds a number per frequent phrase of a length. Texts are cut into words twice: to
    count them, and to write them as the numbers of the frequent ones; each level reads these and
    what the level before found, and writes what it finds.

    Words travel as 64-bit hashes; another seed is taken should any two words share one. Null
    texts count as empty, a null language as ``und``; repeated rows count as often as they stand;
    a text is cut at ends of pieces, and a longer piece taken whole; empty tables give no rows; other columns
    are not looked at. Ties fall to more places, then to the phrase's bytes.
    """
    spark = docs.sparkSession
    rows = pick(docs, text=text_col, lang=lang_col)

    def table(df: DataFrame, name: str) -> DataFrame:
        return as_table(df, fresh_folder(spark, f"phrases-{name}"))

    seed = 0
    while True:
        whole = F.struct("lang", "word")
        words = table(
            rows.mapInArrow(_words(seed), "key long, lang string, word string, n long")
            .groupBy("key").agg(F.sum("n").alias("n"), F.min(whole).alias("w"), F.max(whole).alias("z")),
            "words")
        # 0 stands between pieces.
        if words.where("w <> z or key = 0").isEmpty():
            break
        seed += 1
    totals = words.groupBy("w.lang").agg(F.sum("n").alias("n"))
    number = F.monotonically_increasing_id().alias("id")
    phrases = _numbered(table(
        words.where(F.col("n") >= least)
        .select(number, F.array("key").alias("keys"), "w.lang", F.array("w.word").alias("words")),
        "1"))
    counted, found = [], None
    for length in range(1, longest + 1):
        n = phrases.count()
        if not n:
            break
        made, rounds, lots = _tries(phrases, n)
        if length == 1:
            tries = _sent(made, sum(rounds, []), lots)
            found = table(rows.mapInArrow(_coded(tries, seed), "codes binary"), "codes")
            found = found.withColumn("now", F.col("codes"))
            _drop(tries)
            phrases = phrases.withColumn("keys", F.array("id"))
        else:
            found = found.select("codes", F.col("now").alias("before"), F.lit(None).cast("binary").alias("now"))
            for chosen in rounds:
                tries = _sent(made, chosen, lots)
                found = table(
                    found.mapInArrow(_marked(tries, length), "codes binary, before binary, now binary"),
                    f"found-{length}")
                _drop(tries)
        walked = table(
            found.select("now").mapInArrow(_walked(n, length < longest), "a long, b long, n long")
            .groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= least),
            f"walked-{length}")
        counts = walked.where("b is null").select(F.col("a").alias("id"), F.col("n").alias("f"))
        counted.append(phrases.join(counts, "id").select(
            "lang", "words", F.concat_ws(" ", "words").alias("phrase"), "f"))
        if length == longest:
            break
        first = phrases.select("id", "keys", "lang", "words").toDF("a", "keys_a", "lang", "words_a")
        second = phrases.select(
            F.col("id").alias("b"), F.element_at("keys", -1).alias("key"),
            F.element_at("words", -1).alias("word"))
        phrases = _numbered(table(
            walked.where("b is not null").join(first, "a").join(second, "b").select(
                number, F.concat("keys_a", F.array("key")).alias("keys"), "lang",
                F.concat("words_a", F.array("word")).alias("words")),
            f"{length + 1}"))
    if not counted:
        return spark.createDataFrame(
            [], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    known = counted[0]
    for more in counted[1:]:
        known = known.unionByName(more)
    known = table(known, "known")
    return _ranked(known, totals, places)


def _ranked(known: DataFrame, totals: DataFrame, places: int) -> DataFrame:
    size = F.size("words")
    found = known.where(size > 1).withColumnRenamed("f", "a")
    part = known.select("lang", "phrase", "f")
    cut = (
        found.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
        .withColumn("left", F.concat_ws(" ", F.expr("slice(words, 1, k)")))
        .withColumn("right", F.concat_ws(" ", F.expr("slice(words, k + 1, size(words) - k)")))
        .join(part.toDF("lang", "left", "l"), ["lang", "left"])
        .join(part.toDF("lang", "right", "r"), ["lang", "right"])
        .withColumn("score", F.expr(
            "(cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + r)"))
    )
    scored = cut.groupBy("lang", "phrase", "a").agg(
        F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("at"))
    # All shorter phrases that stand in a longer one.
    inside = (
        found.where(size > 2)
        .select("lang", "a", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
        .select("lang", "a", "words", "m",
                F.explode(F.expr("sequence(1, size(words) - m + 1)")).alias("i"))
        .select("lang", F.concat_ws(" ", F.expr("slice(words, i, m)")).alias("phrase"),
                F.col("a").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    held = F.coalesce(
        F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * HOLDS,
        F.lit(False))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.join(inside, ["lang", "phrase"], "left").where(~held)
        .select("lang", "phrase", "a", "at.l", "at.r", "at.score")
        .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= places)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return mine_phrases(read(spark, folder, "documents"))
