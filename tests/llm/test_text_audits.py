"""Phrases, source divergence and exact copies against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from hotrank.llm import collocations, divergence, exact_dedup


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def corpus(spark, n=140):
    rng = random.Random(5)
    names = ["Ab", "b", "cé", "d", "E-e", "f g", "zz", "q1"]
    rows = []
    for i in range(n):
        words = [rng.choice(names[: 3 + i % 6]) for _ in range(rng.randrange(0, 30))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for w in words)
        rows.append((i, text, rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "s2", None, "s3"]), "x"))
    rows += [(n, None, "en", "quiet", "x"), (n + 1, "", "xx", "s1", "x"), (n + 2, None, "xx", None, "x")]
    rows += [(n + 3, "Ab b cé " * 400, "en", "s1", "x")] * 3 + [(None, "Ab b. no id", "en", "s1", "x")]
    return rows, spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, TEXT string")


# --- phrases ------------------------------------------------------------------------------


def phrases_by_hand(rows, least, places):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            if any(100 * b >= 80 * a and len(q) > len(p)
                   and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:places], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("trie, lot, held", [(1 << 17, 2 << 20, 1 << 20), (7, 300, 4)])
def test_phrases(spark, monkeypatch, trie, lot, held):
    monkeypatch.setattr(collocations, "TRIE", trie)
    monkeypatch.setattr(collocations, "_LOT", lot)
    monkeypatch.setattr(collocations, "_HELD", held)
    rows, df = corpus(spark)
    got = collocations.mine_phrases(df, least=4, places=40).collect()
    assert sorted(tuple(r) for r in got) == phrases_by_hand(rows, 4, 40)


def test_phrases_of_nothing(spark):
    rows, df = corpus(spark, 3)
    assert collocations.mine_phrases(df.limit(0)).count() == 0
    quiet = spark.createDataFrame([r for r in rows if not r[1]], df.schema)
    assert collocations.mine_phrases(quiet).count() == 0


def test_exact_scores_beyond_64_bits(spark):
    a = 9_000_000_000_000_000
    known = spark.createDataFrame(
        [("en", ["a"], "a", a), ("en", ["b"], "b", a + 1), ("en", ["a", "b"], "a b", a)],
        "lang string, words array<string>, phrase string, f long")
    totals = spark.createDataFrame([("en", 3 * a)], "lang string, n long")
    (row,) = collocations._ranked(known, totals, 5).collect()
    assert (row.score, row.n) == (2_000_000 * a // (2 * a + 1), 3 * a)


def test_tries_find_every_phrase():
    import numpy as np

    rng = np.random.default_rng(3)
    words = np.unique(rng.integers(-(1 << 62), 1 << 62, 3000))
    text = rng.choice(words, 20_000)
    for length in (1, 2, 3):
        held = np.unique(rng.choice(words[:400] if length > 1 else words, (5000, length)), axis=0)
        text[50 : 50 + length] = held[7]
        trie = collocations.Trie(held)
        index = {tuple(p): i for i, p in enumerate(held.tolist())}
        want = [(i, index[tuple(text[i : i + length].tolist())]) for i in range(len(text))
                if tuple(text[i : i + length].tolist()) in index]
        at, which = trie.walk(text)
        assert list(zip(at.tolist(), which.tolist())) == want and want


# --- divergence ---------------------------------------------------------------------------


def audit_by_hand(rows):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text)))
            for _, text, lang, source, *_ in rows]
    out = []
    for lang in {x[0] for x in docs}:
        mine = [x for x in docs if x[0] == lang]
        in_docs = Counter(t for _, _, terms in mine for t in set(terms))
        kept = sorted(t for t, n in in_docs.items() if n >= 3)
        total = Counter(t for _, _, terms in mine for t in terms if in_docs[t] >= 3)
        by = {s: Counter() for _, s, _ in mine}
        for _, s, terms in mine:
            by[s].update(t for t in terms if in_docs[t] >= 3)

        def share(counts):
            m = sum(counts.values()) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // m for t in kept}

        q, p = share(total), {s: share(c) for s, c in by.items()}
        f = lambda a, b: (a - b) * (a - b) // b
        for s in by:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in by if o != s)
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if by[s][t] and p[s][t] > q[t])
            for part, found in (("pair", pairs), ("term", terms[:200])):
                out += [(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("bits, held, shard", [(64, 400_000, 400_000), (2, 3, 2), (1, 400_000, 400_000)])
def test_divergence(spark, monkeypatch, bits, held, shard):
    # With few bits all terms collide, also across languages.
    monkeypatch.setattr(divergence, "_HELD", held)
    monkeypatch.setattr(divergence, "_SHARD", shard)
    rows, df = corpus(spark)
    got = divergence.audit_sources(df, bits=bits).collect()
    assert sorted(tuple(r) for r in got) == audit_by_hand(rows)


def test_divergence_of_nothing(spark):
    rows, df = corpus(spark, 3)
    assert divergence.audit_sources(df.limit(0)).count() == 0
    quiet = spark.createDataFrame([r for r in rows if not r[1]], df.schema)
    got = divergence.audit_sources(quiet).collect()
    assert sorted(tuple(r) for r in got) == audit_by_hand([r for r in rows if not r[1]])


def test_shares_are_exact(spark):
    from pyspark.sql import functions as F

    n, m = 4_000_000_000_000_000_000, 9_000_000_000_000_000_001
    row = spark.range(1).select(divergence._share(F.lit(n), F.lit(m)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 1) // m


# --- exact copies -------------------------------------------------------------------------


def copies_by_hand(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[hashlib.sha256(lower(text).encode()).hexdigest()].append(i)
    out = []
    for sha, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return Counter(out)


def test_exact_copies(spark):
    rows, df = corpus(spark)
    rows = rows + [(500, rows[7][1].upper().replace("É", "é"), "en", "s1", "x")] + [(501, None, None, None, "x")] * 2
    df = spark.createDataFrame(rows, df.schema)
    got = exact_dedup.deduplicate(df).collect()
    assert Counter(tuple(r) for r in got) == copies_by_hand(rows)
    assert exact_dedup.deduplicate(df.limit(0)).count() == 0
    stay = exact_dedup.without_copies(df)
    want = {(r[0], r[4]) for r in copies_by_hand(rows) if r[3]}
    assert stay.columns == df.columns and stay.count() == len(want)


def test_hot_groups_meet_by_broadcast(spark):
    rows = [(i, "same" if i % 3 else f"own {i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup.deduplicate(df).collect()
    assert Counter(tuple(r) for r in got) == copies_by_hand(rows)


def test_index_outlives_its_session_object(spark, tmp_path):
    path = str(tmp_path / "index")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = exact_dedup.DigestIndex(spark, path, 4)
    exact_dedup.deduplicate(frame([(1, "A b"), (2, "c"), (5, "a B")]), index)
    index.close()
    again = exact_dedup.DigestIndex(spark, path, 4)
    more = frame([(3, "a b"), (9, "new"), (8, "NEW"), (2, "c")])
    found = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.deduplicate(more, again).collect()}
    assert found == {3: (5, False), 9: (9, True), 8: (9, False), 2: (2, True)}
    # The same batch again adds nothing.
    again.add(exact_dedup.digests(more))
    assert sorted(r.keep_id for r in again.entries().collect()) == [2, 5, 9]
    plan = again.fresh(exact_dedup.digests(more))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    again.close()


def test_pairs_of_tests_are_not_empty(spark):
    rows, _ = corpus(spark)
    assert len(phrases_by_hand(rows, 4, 40)) > 50 and len(audit_by_hand(rows)) > 50


def test_tries_are_unfolded_one_at_a_time(monkeypatch):
    """A task's memory does not grow with the number of tries, and blocks change no place."""
    import pickle
    import weakref

    rng = np.random.default_rng(3)
    phrases = np.unique(rng.integers(1, 30, (300, 2)), axis=0)
    lots = [rng.integers(0, 30, n) for n in (50, 400, 1, 0, 700)]
    parts = np.array_split(phrases, 5)
    folded = [collocations.pack(pickle.dumps(collocations.Trie(part))) for part in parts]
    starts = np.cumsum([0, *map(len, parts)])
    alive, most, unfolded = weakref.WeakSet(), [0], collocations._unfolded

    def watched(trie):
        out = unfolded(trie)
        alive.add(out)
        most[0] = max(most[0], len(alive))
        return out

    monkeypatch.setattr(collocations, "_unfolded", watched)
    blocks = list(collocations._blocks(lots, 300))
    assert [len(x) for x in blocks] == [2, 3]
    number = {tuple(p): i for i, p in enumerate(phrases.tolist())}
    which = [x for block in blocks for x in collocations._found(block, folded, starts)]
    assert most[0] == 1 and len(which) == len(lots)
    for words, found in zip(lots, which):
        want = [number.get(tuple(words[i : i + 2].tolist()), -1) for i in range(len(words))]
        assert found.tolist() == [*want, -1]


def test_a_place_is_walked_through_one_trie_only(monkeypatch):
    """Work does not grow with the number of tries."""
    rng = np.random.default_rng(9)
    phrases = np.unique(rng.integers(1, 60, (900, 2)), axis=0)
    block = [rng.integers(0, 60, n).astype(np.int32) for n in (5000, 1, 0, 3000)]
    lots = collocations._lots(list(phrases.T), 40)
    lots[lots == 7] = 8
    parts = [np.flatnonzero(lots == lot) for lot in range(40)]
    folded = [collocations._folded(collocations.Trie(phrases[x])) if len(x) else None for x in parts]
    number = {tuple(p): i for i, p in enumerate(phrases[np.concatenate(parts)].tolist())
              if collocations._lots([phrases[np.concatenate(parts)[i, None], j] for j in (0, 1)], 40)[0] != 7}
    walked, walk = [], collocations.Trie.walk

    def watched(trie, words, at=None):
        walked.append(len(words) if at is None else len(at))
        return walk(trie, words, at)

    monkeypatch.setattr(collocations.Trie, "walk", watched)
    which = collocations._found(block, folded, np.cumsum([0, *map(len, parts)]), 2)
    assert sum(walked) <= sum(map(len, block)) and max(lots) == 39
    for words, found in zip(block, which):
        want = [number.get(tuple(words[i : i + 2].tolist()), -1) for i in range(len(words))]
        assert found.tolist() == [*want, -1]


def test_phrases_in_rounds_of_tries(spark, monkeypatch):
    """Broadcasts are bounded together, not only one by one, and rounds change no row."""
    monkeypatch.setattr(collocations, "TRIE", 40)
    monkeypatch.setattr(collocations, "_ROUND", 1)
    sent, send = [], collocations._sent

    def watched(made, chosen, lots):
        sent.append(len(chosen))
        return send(made, chosen, lots)

    monkeypatch.setattr(collocations, "_sent", watched)
    rows, df = corpus(spark)
    got = collocations.mine_phrases(df, least=4, places=40).collect()
    assert sorted(tuple(r) for r in got) == phrases_by_hand(rows, 4, 40)
    assert len(sent) > 4 and set(sent[1:]) == {1}
