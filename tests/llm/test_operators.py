"""Operators against brute force, on texts and vectors that are awkward on purpose."""

import hashlib
import json
import math
import random
import re
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hotrank.llm import ann, bpe, chat, licenses, lm, mixing, near_dedup, substring_dedup, topk
from hotrank.llm import toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    (1, "one two three " + PASSAGE), (2, PASSAGE + " tail"), (3, None), (4, ""), (5, " \n\t "),
    (6, "solo"), (7, "a " * 50), (8, "one two three " + PASSAGE), (9, PASSAGE.replace("w30", "x")),
    (10, "é ü <|endoftext|> \\ " + "zz" * 3000), (11, "solo"), (11, "solo"), (None, "lost id"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i == 2 else f"s{(i or 0) % 3}", len(t or ""), "x") for i, t in TEXTS]
    # An extra column whose name differs by case only.
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, TEXT string")


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_licenses(spark):
    text = (
        "CC BY cc-by 4.0, all rights\nreserved. General Public License\n"
        "SPDX-License-Identifier: (MIT or GPL-2.0-only WITH Classpath-exception-2.0) and Zlib */"
    )
    rows = spark.createDataFrame(
        [(1, text), (2, None), (3, ""), (4, "License: (MIT or")], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan_licenses(rows).collect()}
    one = found[1]
    assert (one.n_base, one.first_word, one.last_word) == (4, 0, 9)
    assert one.base_labels == "cc-by,gpl,reserved"
    assert "spdx:mit" in one.labels.split(",") and one.freedom == 1.0
    assert one.expressions == ["mit gpl-2.0-only classpath-exception-2.0 with or zlib and"]
    assert (found[2].n_words, found[2].labels, found[2].score) == (0, "", 0.0)
    assert found[4].labels == "expression-invalid"


@pytest.mark.parametrize("text, value", [
    ("mit", 1.0), ("gpl-2.0 or mit", 1.0), ("gpl-2.0 and mit or isc", 1.0),
    ("gpl-2.0 and (mit or isc)", 0.3), ("mit and proprietary or", 0.0),
])
def test_expressions(text, value):
    assert licenses.freedom(licenses.parse(text)) == value


@pytest.mark.parametrize("text, postfix, value", [
    ("MIT AND Foo-1.0", "mit foo-1.0 and", 0.0), ("Foo-1.0 OR MIT", "foo-1.0 mit or", 1.0),
    ("GPL-2.0-only AND Commons-Clause", "gpl-2.0-only commons-clause and", 0.0),
    ("Apache-2.0 WITH nonsense-exception", "apache-2.0 nonsense-exception with", 0.0),
    ("MPL-1.1 OR MIT", "mpl-1.1 mit or", 1.0), ("GPL-2.0+ with GCC-exception-3.1", "gpl-2.0+ gcc-exception-3.1 with", 0.5),
    ("MIT OR Whatever", "mit whatever or", 1.0), ("MIT and more of that", "mit", 1.0),
    ("MIT. And so on", "mit", 1.0), ("see the file", "", None), ("Foo-1.0 AND Bar-2.0", "", None),
    ("DocumentRef-a:LicenseRef-b OR ISC", "documentref-a:licenseref-b isc or", 1.0),
    ("(Foo-1.0 OR MIT) AND CC-BY-NC-2.5", "foo-1.0 mit or cc-by-nc-2.5 and", 0.1),
])
def test_unknown_operands_stay(text, postfix, value):
    found = licenses.parse(text)
    assert " ".join(token for _, token in found) == postfix
    assert not found or licenses.freedom(found) == value


def test_licenses_against_brute_force(spark):
    """Phrases among words, over awkward rows: null, empty, very long, repeated, extra columns."""
    long = "x " * 200_000 + "CC-BY all rights reserved cc by " + "y" * 300_000
    texts = [*TEXTS, (20, long), (20, long), (21, "cc cc by by, CC\nBY: general  public license"),
             (22, "all rights reserved" * 3), (23, "License: MIT AND Foo-1.0")]
    rows = [(i, t, "x") for i, t in texts]
    got = sorted(
        (r.doc_id or 0, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
        for r in licenses.scan_licenses(
            spark.createDataFrame(rows, "doc_id long, text string, TEXT string")).collect())
    want = []
    for i, t in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        at = [(k, label) for phrase, label in licenses.BASE_PHRASES for k in range(len(words))
              if words[k : k + len(phrase.split())] == phrase.split()]
        starts = [k for k, _ in at]
        want.append((i or 0, len(words), len(at), min(starts, default=None),
                     max(starts, default=None), ",".join(sorted({x for _, x in at}))))
    assert got == sorted(want, key=lambda r: r[:3])


def test_licenses_of_nothing(nothing):
    assert licenses.scan_licenses(nothing).count() == 0


def vectors(spark):
    rows = [(i, [math.sin(i * j) for j in range(1, 9)]) for i in range(120)]
    rows += [(200, None), (220, [float("nan")] * 8), (240, [0.0] * 8), (260, [1.0, None]), (280, [])]
    rows += [(300, rows[20][1]), (300, rows[20][1]), (301, rows[20][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_top_products(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 32)
    df = vectors(spark)
    held = {
        r.vec_id: [math.floor(64 * x) for x in r.embedding] for r in df.collect()
        if r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding)
    }
    want = set()
    for q in (i for i in held if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(held[q], v)), i)
                        for i, v in held.items() if i != q)
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(scores[:20], 1)}
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_products(df).collect()}
    assert got == want
    assert topk.top_products(df.limit(0)).count() == 0


def scored(ids, items, q_ids, q_items, k=20):
    """What a task finds for one pair of blocks: query, candidate, score."""
    row = {"ids": ids, "items": items, "q_ids": q_ids, "q_items": q_items}
    row = {name: [np.asarray(x, np.int64).tobytes()] for name, x in row.items()}
    found = list(topk._scatter(k)([pa.RecordBatch.from_pydict(row)]))
    return [tuple(r.values()) for batch in found for r in batch.to_pylist()]


@pytest.mark.parametrize("weight", [1, 40, 1 << 40, -(1 << 63)])
def test_products_of_blocks_are_exact(weight):
    rng = np.random.default_rng(3)
    # Dense terms, one with few postings, one nobody asks for; many equal scores.
    items = rng.integers(-2, 3, (70, 6))
    items[:, 4] = 0
    items[::30, 4] = 1
    q_items = items[::2].copy()
    q_items[:, 5] = 0
    items[:, 0] *= weight
    ids = np.arange(70) * 3
    with np.errstate(over="ignore"):
        products = q_items @ items.T
    want = [
        (q, c, -s) for q, row in zip(ids[::2].tolist(), products.tolist())
        for s, c in sorted((-s, c) for c, s in zip(ids.tolist(), row) if c != q)[:20]
    ]
    assert scored(ids, items, ids[::2], q_items) == want


def test_products_of_blocks_hold_few_scores_at_a_time():
    rng = np.random.default_rng(4)
    items = rng.integers(-40, 41, (topk.ROWS, 64))
    tracemalloc.start()
    found = scored(np.arange(topk.ROWS), items, np.arange(topk.QUERIES), items[: topk.QUERIES])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All scores of the pair of blocks alone take 8 MB in 32 bits.
    assert len(found) == 20 * topk.QUERIES and peak < 12 << 20


def test_neighbours_find_nine_of_ten(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    held = {r.vec_id: r.embedding for r in df.collect()}
    unit = {i: [x / math.sqrt(sum(y * y for y in v)) for x in v] for i, v in held.items()}
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
        exact = sum(a * b for a, b in zip(unit[r.query_id], unit[r.vec_id]))
        assert r.score == pytest.approx(exact, abs=1e-12)
    hits = 0
    for q in got:
        best = sorted(unit, key=lambda i: (-sum(a * b for a, b in zip(unit[q], unit[i])), i))
        hits += len(got[q] & set([i for i in best if i != q][:5]))
    assert hits >= 0.9 * 5 * len(got)
    assert set(got) == {i for i in held if i % 50 == 0}


def test_neighbours_of_awkward_vectors(spark):
    found = ann.nearest(vectors(spark), share=1.0).collect()
    by = {(r.query_id, r["rank"]): r.vec_id for r in found}
    assert by[(300, 1)] == 20 and by[(300, 2)] == 301
    assert not {r.query_id for r in found} & {200}
    assert ann.nearest(vectors(spark).limit(0)).count() == 0


def test_cells_come_by_distance():
    import numpy as np

    rng = np.random.default_rng(1)
    a, b = rng.random(5), rng.random(7)
    counts = np.ones((5, 7), int)
    for wanted in (1, 9, 35):
        mask = ann.traverse(a, b, counts, wanted)
        sums = np.add.outer(a, b)
        assert mask.sum() == wanted and sums[mask].max() <= np.sort(sums.ravel())[wanted - 1]


def test_toxicity(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 0), (2, 1), (8, None), (99, 1)], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_toxicity(nothing, labels.limit(0)).count() == 0


def test_toxicity_of_misspelt_words(spark):
    text = [(i, f"plain words number{i} " + ("awfulness" if i % 3 == 0 else "kindness")) for i in range(300)]
    rows = text + [(1000, "plain words awfulnes"), (1001, "plain words kindnes")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in text], "doc_id long, toxic int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.predicted for r in toxicity.score_toxicity(df, labels).collect()}
    assert found[1000] == 1 and found[1001] == 0


def test_toxicity_where_texts_share_most_words(spark):
    # Features common to all texts once made the training diverge.
    common = " ".join(f"shared{i} again" for i in range(40))
    text = [(i, f"{common} w{i % 97} " + ("vileword " if i % 10 == 0 else "good ") * 2) for i in range(1500)]
    df = spark.createDataFrame(text, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in text], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(df, labels).collect()
    assert all(r.predicted == int(r.doc_id % 10 == 0) and 0 <= r.score <= 1 for r in rows)


def test_toxicity_of_awkward_rows(spark):
    # One labelled id with many rows, null and very long texts, a clashing column.
    rows = [(7, f"row {i}", "x") for i in range(500)] + [(8, None, "x"), (9, "", "x"), (None, "lost", "x")]
    rows += [(10, "a long vileword text " * 200_000, "x"), (10, "a long vileword text " * 200_000, "x")]
    rows += [(100 + i, "vileword here" if i % 2 else f"fine day {i % 7}", "x") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, TEXT string")
    labels = spark.createDataFrame(
        [(7, 0), (7, 1), (8, 0), (None, 1)] + [(100 + i, i % 2) for i in range(200)],
        "doc_id long, toxic int")
    found = toxicity.score_toxicity(df, labels).collect()
    assert len(found) == len(rows)
    assert {r.predicted for r in found if r.doc_id == 10} == {1}
    assert len({r.score for r in found if r.doc_id in (8, 9)}) == 1


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = toxicity.op4_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.0125 * len(clean)


def test_pieces_cover_every_subword(monkeypatch):
    import numpy as np

    held = [b"", b"One two-three", "été, x".encode() * 9, b"_"]
    whole = [np.sort(np.concatenate([b[of == i] for of, b in toxicity.subwords(held)])) for i in range(4)]
    monkeypatch.setattr(toxicity, "_SLICE", 5)
    cut = list(toxicity.subwords(held))
    for i in range(4):
        assert np.array_equal(whole[i], np.sort(np.concatenate([b[of == i] for of, b in cut])))
    assert len(whole[0]) == len(whole[3]) == 0


@pytest.mark.parametrize("text", ["", "\\", "<\\/s>", "</s></s", "[INST][/INST]\\\\", "<<<SYS>>", "<", "[:]"])
@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool[:]", ""])
def test_template_round_trip(role, text):
    formatted, start, end = chat.format_turn(role, text)
    assert chat.read_turns(formatted * 2) == [(role, text)] * 2
    assert chat.unescape(formatted[start:end]) == (text if role == "assistant" else "")


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "bot", "content": None}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 3},
        {"instruction": "do", "input": "it", "output": "done"}, {"prompt": "p", "completion": "c"},
        {"what": 1},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(8, "{"), (9, None)]
    df = spark.createDataFrame(rows, "k long, record string")
    found = sorted((r.k, r.pos or 0, r.role, r.text, r.layout.split(":")[0])
                   for r in chat.canonical_turns(df, ("k",)).fillna("", ["role", "text"]).collect())
    assert found == [
        (0, 0, "user", "q", "messages"), (0, 1, "assistant", "", "messages"),
        (1, 0, "user", "q", "conversations"), (1, 1, "assistant", "a", "conversations"),
        (2, 0, "user", "do\n\nit", "instruction"), (2, 1, "assistant", "done", "instruction"),
        (3, 0, "user", "p", "prompt-completion"), (3, 1, "assistant", "c", "prompt-completion"),
        (4, 0, "", "", "unknown"), (8, 0, "", "", "broken"), (9, 0, "", "", "broken"),
    ]


def test_lattice_sums_all_segmentations():
    pieces = [("▁", -1.0), ("▁a", -2.0), ("a", -1.5), ("b", -2.5), ("ab", -3.0), ("▁ab", -4.0)]
    lattice, total = lm.Lattice(pieces), 0.0
    text, p = "▁ab", dict(pieces)
    for n in range(3):
        for cuts in combinations((1, 2), n):
            edges = [0, *cuts, 3]
            weight = 1.0
            for a, b in zip(edges, edges[1:]):
                part = text[a:b]
                one = math.exp(p[part]) if part in p else 0.0
                if len(part) == 1:
                    one += math.exp(lattice.byte * len(part.encode()))
                weight *= one
            total += weight
    assert lattice.log_marginal("ab") == pytest.approx(math.log(total))


def test_lm_scores_are_marginals_of_whole_texts(spark, monkeypatch):
    """Every segmentation of the whole text, blanks included, listed and summed."""
    pieces = [("▁", -1.0), ("▁a", -2.0), ("a", -1.5), ("b", -2.5), ("ab", -3.0), ("▁ab", -4.0)]
    monkeypatch.setattr(lm, "piece_scores", lambda path=None: pieces)
    monkeypatch.setattr(lm, "HEAD", 3)  # words are common and rare
    texts = [(1, "ab a"), (2, "ba é"), (3, None), (4, "a a a"), (4, "a a a"), (None, "B ab")]
    p, lattice = dict(pieces), lm.Lattice(pieces)

    def brute(text):
        total = 0.0
        for n in range(len(text)):
            for cuts in combinations(range(1, len(text)), n):
                edges, weight = [0, *cuts, len(text)], 1.0
                for part in (text[a:b] for a, b in zip(edges, edges[1:])):
                    weight *= (math.exp(p[part]) if part in p else 0.0) + (
                        math.exp(lattice.byte * len(part.encode())) if len(part) == 1 else 0.0)
                total += weight
        return math.log10(total) if text else 0.0

    rows = lm.score_texts(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 2, 3, 4, 4]
    by = {r.doc_id: r for r in rows}
    for i, t in texts:
        whole = "".join("▁" + w for w in WORD.findall(lower(t)))
        assert by[i].score == pytest.approx(brute(whole) + math.log10(lm._END))
        assert by[i].n_tokens == len(WORD.findall(lower(t))) + 1


def test_lm_learns_from_its_fold(spark, monkeypatch):
    """Held-out rows score about as by the base model, and every part of the sum is as described."""
    import zlib
    from collections import Counter

    monkeypatch.setattr(lm, "HEAD", 20)  # words are common and rare
    rng = random.Random(5)
    words = ["".join(rng.choices(["on", "ti", "sha", "er", "ble", "nd"], k=rng.randint(1, 4))) for _ in range(300)]
    texts = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(300)], k=60))) for i in range(200)]
    texts += [(900, "zzyzx \u7530 7" * 400), (901, None), (902, "")]
    rows = lm.score_texts(spark.createDataFrame(texts, "doc_id long, text string"), learn=True).collect()
    assert len(rows) == len(texts) and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 900]
    assert sum(r.score for r in held) > 1.1 * sum(r.base_score for r in held)
    learnt = [t or "" for i, t in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for t in learnt for w in t.split())
    n, sizes = sum(counts.values()) + len(learnt), Counter(counts.values())
    off = min(0.9, max(0.1, sizes[1] / max(1, sizes[1] + 2 * sizes[2])))
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(lm.VOCABULARY))
    uses = Counter(p for w in counts for p in model.encode(w, out_type=str))
    lattice = lm.Lattice(lm.learnt_pieces(lm.piece_scores(), uses))

    def word(w):
        spelt = math.exp(lattice.log_marginal(w)) * (off * len(counts) + 1) / (n + 2)
        return math.log10(spelt + max(0, counts[w] - off) / (n + 2))

    for r in held:
        want = sum(map(word, dict(texts)[r.doc_id].split())) + math.log10((len(learnt) + 1) / (n + 2))
        assert r.score == pytest.approx(want)


def test_lm_base_scores(docs, nothing):
    import zlib
    from collections import Counter

    counts = Counter()
    for i, t in TEXTS:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update([*WORD.findall(lower(t)), "\n"])
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*WORD.findall(lower(t)), "\n"])
        for _, t in TEXTS)
    rows = lm.score_texts(docs).collect()
    assert sorted(r.base_score for r in rows) == pytest.approx(want)
    assert {r.train_tokens for r in rows} == {n} and all(r.score < 0 for r in rows)
    assert lm.score_texts(nothing).count() == 0


def test_mixing(docs, nothing):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.taken <= 3 * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, [r.target, r.source_size, 0])[2] += r.taken
    assert all(abs(t - taken) <= 1 for t, _, taken in by.values())
    names = sorted((s for s in by if s is not None)) + [None]
    # Water filling: what a limit leaves goes to the others by weight.
    left, open_, want = sum(x[1] for x in by.values()), dict(zip(names, (5, 2, 1, 5))), {}
    while open_:
        level = left / sum(open_.values())
        full = [s for s in open_ if level * open_[s] > 3 * by[s][1]]
        for s in full or list(open_):
            want[s] = 3 * by[s][1] if full else level * open_[s]
        left -= sum(want[s] for s in full)
        open_ = {s: w for s, w in open_.items() if s in full} and {
            s: w for s, w in open_.items() if s not in full} if full else {}
    assert {s: by[s][0] for s in names} == pytest.approx(want)
    assert mixing.mix(nothing).count() == 0


def test_windows_that_collide_by_one_seed_differ_by_another():
    from hotrank.llm.hashing import mixed, runs

    words = np.arange(100, 120, dtype=np.uint64)
    step = mixed(np.array([3], np.uint64)) | np.uint64(1)
    other = words.copy()
    # One more before the last word weighs as much as the multiplier on the last.
    other[-2:-1] += np.uint64(1)
    other[-1:] -= step
    assert runs(words, 20, 3) == runs(other, 20, 3)
    assert runs(words, 20, 4) != runs(other, 20, 4)


def test_substrings(docs, nothing):
    seen, want = set(), []
    for i, t in sorted(((i, t) for i, t in dict(TEXTS).items()), key=lambda x: (x[0] is not None, x[0])):
        words = WORD.findall(t or "")
        gone = set()
        for a in range(len(words) - 19):
            key = tuple(words[a : a + 20])
            gone |= set(range(a, a + 20)) if key in seen else set()
            seen.add(key)
        want.append((i, len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone)))
    got = [tuple(r) for r in substring_dedup.remove_repeats(docs).distinct().collect()]
    order = lambda r: (r[0] is not None, r[0])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_many_repeated_edges_are_not_all_unpacked_at_once():
    n, texts = 4000, 40
    first = pa.struct([("doc", pa.int64()), ("txt", pa.int64()), ("a", pa.int32())])
    edge = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()), ("f", first)])
    edges = [{"a": i, "b": i + 9, "n": 2, "f": {"doc": 0, "txt": 0, "a": i}} for i in range(n - 8)]
    nodes = [{"at": i, "n": 2} for i in range(n - 7)]
    text = b"w " * n
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(texts + 3)), pa.array([0] * (texts + 3)),
         pa.array([substring_dedup.pack(x) for x in [b"", *[text] * texts, b"x", text]]),
         pa.array([None, *[edges] * texts, None, None], pa.list_(edge)),
         pa.array([None, *[nodes] * texts, [], []], pa.list_(
             pa.struct([("at", pa.int32()), ("n", pa.int64())])))],
        names=["doc", "txt", "text", "edges", "nodes"])
    del edges, nodes
    tracemalloc.start()
    found = [r for b in substring_dedup._settle(20, False)(iter([batch])) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r["n_words"], r["n_removed"], r["text"]) for r in found] == [
        (0, 0, None), *[(n, n, None)] * texts, (1, 0, None), (n, 0, None)]
    # Edges of all texts as Python's own took 132 MB.
    assert peak < 24 << 20


@pytest.mark.parametrize("crowd", [16, 1])
def test_near_copies(spark, docs, nothing, monkeypatch, crowd):
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    sets = {}
    for i, t in TEXTS:
        w = WORD.findall(lower(t))
        sets[i] = set(zip(w, w[1:])) if len(w) > 1 else {tuple(w)} - {()}
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in combinations(sets, 2):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low = min(root[a], root[b], key=lambda x: (x is not None, x))
                root[a] = root[b] = low
    got = near_dedup.near_components(docs, size=2).collect()
    assert len(got) == len(TEXTS)
    assert {r.doc_id: r.component_id for r in got} == root
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(sets[r.doc_id]) for r in got)
    assert near_dedup.near_components(nothing).count() == 0


def test_bpe(docs, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))
    want = []
    for _, t in TEXTS:
        ids = plain.encode(t or "", add_special_tokens=False).ids
        decoded = plain.decode(ids, skip_special_tokens=False)
        want.append((len(ids), *(hashlib.sha256(x.encode()).hexdigest()
                                 for x in (",".join(map(str, ids)), decoded))))
    got = [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_texts(docs).collect()]
    assert sorted(got) == sorted(want)
    assert bpe.encode_texts(nothing).count() == 0


def test_shared_chunks_are_encoded_once():
    import public_tokenizers

    encoder = bpe.Encoder(public_tokenizers.path(bpe.TOKENIZER))
    text = " ".join(f"word{i}" for i in range(4000)).encode()
    parts = encoder.encode([b"before " + text, b"another start " + text])
    assert encoder.reused > 0.9 * encoder.encoded
    assert [bpe.digest(p)[0] for p in parts] == [
        len(encoder.tokenizer.encode(t.decode(), add_special_tokens=False).ids)
        for t in (b"before " + text, b"another start " + text)]


def test_stages_on_awkward_rows(spark, docs, sf):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    # Extra columns named like those that stages add, and a repeated row that loses words.
    extra = ["kept", "doc", "txt", "copy", "size", "taken", "predicted", "c0", "component_id"]
    awkward = docs.unionAll(docs.where("doc_id = 8"))
    for name in extra:
        awkward = awkward.withColumn(name, awkward["lang"])
    rows = {n: [tuple(r) for r in stages[n](spark, awkward, sf).collect()] for n in list(stages)[:4]}
    lost = {r[0]: r[1] for r in rows["substring_dedup"]}
    assert len(rows["substring_dedup"]) == len(TEXTS) + 1 and lost[8] == "" and lost[1] == TEXTS[0][1]
    assert len(rows["toxicity"]) == len(TEXTS) + 1
    ids = [r[0] for r in rows["near_dedup"]]
    assert len(ids) == len(set(ids)) and {1, 3} <= set(ids) and 8 not in ids
    assert all(r[-1] == "en" for found in rows.values() for r in found)
    for row in rows["mixing"]:
        assert row[1] in [t for _, t in TEXTS] or any(t and t.split()[: len(row[1].split())] == row[1].split() for _, t in TEXTS)


def test_pipeline_columns(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "substring_dedup", "mixing", "bpe"]
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs.limit(0), sf).columns == docs.columns
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_sample_is_chosen_before_it_is_ordered(spark):
    """The lowest hashes, without a list of that length from each task for the driver."""
    rows = spark.range(0, 40_000, 1, 20).withColumnRenamed("id", "vec_id")
    place = F.xxhash64("vec_id")
    want = {r.vec_id for r in rows.orderBy(place, "vec_id").limit(500).collect()}
    low = ann.lowest(rows, 40_000, 500)
    assert {r.vec_id for r in low.collect()} == want
    plan = low._jdf.queryExecution().optimizedPlan().toString()
    bound = int(re.search(r"Filter .*xxhash64\(.*\) < (-?\d+)", plan)[1])
    assert 500 <= rows.where(place < bound).count() < 1000
    # More rows asked for than there are, and a wrong idea of how many there are.
    assert ann.lowest(rows, 40_000, 50_000).count() == 40_000
    assert {r.vec_id for r in ann.lowest(rows, 4_000_000, 500).collect()} == want


@pytest.mark.parametrize("alike", [False, True])
def test_best_of_a_block_as_by_hand(alike):
    rng = np.random.default_rng(6)
    units = rng.standard_normal((900, 12))
    if alike:
        units[100:800] = units[100]
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    ids, asked = np.arange(900) * 2, units[::9]
    cells, visits = rng.integers(0, 40, 900), rng.random((100, 40)) < 0.4
    visits[3], visits[4, 1:] = False, False
    got = list(zip(*(x.tolist() for x in ann.best_seen(
        ids[::9], asked, visits, ids, units, cells, 5))))
    want = []
    for q, query, seen in zip(ids[::9].tolist(), asked, visits):
        scores = np.einsum("ij,j->i", units, query)
        found = [(-scores[i], ids[i].item()) for i in range(900) if seen[cells[i]] and ids[i] != q]
        want += [(q, i, -s) for s, i in sorted(found)[:5]]
    assert got == want and len(got) < 500


def test_best_of_a_block_holds_few_vectors_at_a_time():
    """Also where all rows are one vector, so that none can be ruled out by rough scores."""
    units = np.full((4096, 64), 0.125)
    ids, queries = np.arange(4096), 256
    tracemalloc.start()
    found = ann.best_seen(
        ids[:queries], units[:queries], np.ones((queries, 1), bool), ids, units,
        np.zeros(4096, np.int64), 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[0]) == 5 * queries and peak < 64 << 20
