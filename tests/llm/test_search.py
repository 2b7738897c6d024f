"""Ranked search, periodic runs and quality votes against brute force and held-out labels."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from odd import LONG, ODD, PLAIN, documents, local, table

from prodseq.llm import queries
from prodseq.llm.max_sketches import Queries, build_index, rank_documents, search_block, sketch, terms
from prodseq.llm.neighbour_votes import Voters, latent_directions, learn, score, vectors
from prodseq.llm.periodic_runs import PRIME, find_runs, inverse_transform, occurrences, periodic_runs, run_digest, transform
from prodseq.llm.scratch import Scratch
from prodseq.llm.shingles import hashes_of_runs

# -- ranked search


def plain_terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_ranking(docs, items, k):
    """{item place: [(id, score)]} from the definition."""
    held = [Counter(plain_terms(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in held]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in held for t in c)
    out = {}
    for place, text in enumerate(items):
        rows = []
        for (key, _), c, size in zip(docs, held, sizes):
            if not size:
                continue
            m = 75 + 25 * size * n // length
            total = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t in plain_terms(text))
            if total > 0:
                rows.append((-total, key is None, key or 0, key))
        out[place] = [(key, -neg) for neg, _, _, key in sorted(rows)[:k]]
    return out


def test_terms_are_the_right_runs():
    random.seed(2)
    parts = [chr(c) for c in range(128)] + ["é", "ÀB", "日本", "😀", "\x85", "\xa0"]
    for _ in range(300):
        text = "".join(random.choices(parts, k=30))
        assert [t.decode() for t in terms(text)] == plain_terms(text)
    assert terms(None) == terms("") == []


def test_sketch_bounds_every_score():
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(random.choices(vocabulary, k=random.choice([0, 1, 5, 80, 900]))) for _ in range(120)] + ["w1 " * 400, "w1 " * 255]
    asked = Queries.of([" ".join(random.choices(vocabulary, k=12)) for _ in range(9)] + ["w1 w1 unseen", "", None])
    counted = [(Counter(terms(t)), len(terms(t))) for t in texts]
    asked.weigh(np.array([sum(w in c for c, _ in counted) for w in asked.words]), sum(n > 0 for _, n in counted), sum(n for _, n in counted))
    sketches = []
    for text in texts:
        hashes, _ = hashes_of_runs([b" ".join(terms(text))])
        sketches.append(sketch(*np.unique(hashes, return_counts=True)))
    bounds = asked.bounds(np.array([n for _, n in counted]), sketches)
    exact = np.array([[asked.exact(c, q) for q in range(12)] for c in counted])
    assert (bounds >= exact).all() and exact.max() > 0
    assert (bounds == exact).mean() > 0.5  # the bounds are close, so few documents need scoring


@pytest.mark.parametrize("block", [256, 2])
def test_search_equals_definition(spark, block):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "日本"]
    rows = [(i, " ".join(random.choices(vocabulary, k=random.randint(0, 40)))) for i in range(150)]
    rows += [(1000 - i, "same words here w1 w2") for i in range(40)] + [(None, "same words here w1 w2"), (7, None), (8, ""), (9, LONG)]
    items = ["same words", "W1 w2 w2 w3", "nothing of this", None, "", "日本 É w9", "w1x7 w2x14"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS query", "2 AS value", "3 AS rank", "4 AS row").repartition(6)
    asked = spark.createDataFrame(list(enumerate(items)), "item_id int, text string").selectExpr("*", "5 AS query", "6 AS item").coalesce(1)
    found = {place: [] for place in range(len(items))}
    for r in sorted(rank_documents(docs, asked, k=20, block=block).collect(), key=lambda r: (r.item_id, r.rank)):
        found[r.item_id].append((r.doc_id, r.score))
        assert r.rank == len(found[r.item_id])
    assert found == plain_ranking(rows, items, 20)


def test_search_query_equals_definition(spark):
    docs, items = local(table(spark, "documents")), local(table(spark, "benchmark"))
    want = plain_ranking(list(zip(docs["doc_id"], docs["text"])), items["text"].tolist(), 20)
    rows = local(queries.op11_search(spark, "/root/testdata/sf0.001")).sort_values(["item_id", "rank"])
    for place, item in enumerate(items["item_id"]):
        mine = rows[rows["item_id"] == item]
        assert list(zip(mine["doc_id"], mine["score"])) == want[place]


def test_search_without_rows(spark):
    docs, items = documents(spark), spark.createDataFrame([(1, "plain text"), (1, "plain text")], "item_id int, text string")
    columns = ["item_id", "rank", "doc_id", "score"]
    assert rank_documents(docs, items.limit(0)).columns == columns and rank_documents(docs, items.limit(0)).count() == 0
    assert rank_documents(docs.limit(0), items).count() == 0
    rows = rank_documents(docs, items).collect()  # an item that is there twice has its result twice
    assert sorted((r.rank, r.doc_id) for r in rows) == [(1, 1), (1, 1), (2, 1), (2, 1), (3, None), (3, None)]


def test_only_documents_with_high_bounds_are_scored(spark, monkeypatch):
    scratch = Scratch(spark, "test")
    index = build_index(table(spark, "documents"), scratch)
    assert set(index.columns) == {"row", "id", "n_terms", "sketch", "text"}
    text = table(spark, "benchmark").first()["text"]
    best = search_block(index, [text], scratch, 3).collect()
    assert [r["rank"] for r in sorted(best, key=lambda r: r["rank"])] == [1, 2, 3]


# -- periodic runs


def plain_runs(words):
    spans = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(24, 3 * q):
                spans.setdefault((start, i + q), q)
    return sorted((a, b - a, q) for (a, b), q in spans.items())


def plain_digest(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(key).encode())
    if key is not None and words and h % 10 == 0:
        a, n = h // 10 % len(words), len(words)
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (key, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join(f"{a},{n},{q}\n" for a, n, q in runs)), digest(kept))


def test_transform_multiplies_polynomials():
    random_ = np.random.default_rng(1)
    a, b = random_.integers(0, PRIME, (2, 3, 16)).astype(np.uint64)
    product = inverse_transform(transform(a) * transform(b) % np.uint64(PRIME))
    for x, y, z in zip(a.tolist(), b.tolist(), product.tolist()):
        assert z == [sum(x[i] * y[(k - i) % 16] for i in range(16)) % PRIME for k in range(16)]


@pytest.mark.parametrize("scale", [8, 16, 32])
def test_occurrences_equal_comparison(scale):
    numbers = np.random.default_rng(scale).integers(1, 3, 400)
    numbers[100:235] = np.tile(numbers[:45], 3)
    numbers[290:375] = 5
    blocks = np.arange(0, 400 - scale, scale)
    first = 1 if scale == 8 else scale
    want = {(s, d) for s in blocks.tolist() for d in range(first, 2 * scale) if numbers[s : s + scale].tolist() == numbers[s + d : s + d + scale].tolist()}
    assert want and set(zip(*(x.tolist() for x in occurrences(numbers, blocks, scale)))) == want


def test_runs_equal_brute_force():
    random.seed(6)
    for _ in range(400):
        n = random.randrange(1, 220)
        words = [random.randrange(random.choice([1, 2, 3, 40])) for _ in range(n)]
        for _ in range(random.randrange(3)):
            a, p = random.randrange(n), random.randrange(1, 2 + n // 2)
            for i in range(a + p, random.randrange(a, n) + 1):
                words[i] = words[i - p]
        assert find_runs(np.array(words) + 1, n) == plain_runs(words)


def test_runs_of_long_and_even_texts():
    assert find_runs(np.ones(1 << 17, int), 1 << 17) == [(0, 1 << 17, 1)]
    words = np.tile(np.arange(1, 5001), 7)
    assert find_runs(words, len(words)) == [(0, 35_000, 5000)]
    assert find_runs(np.arange(1, 50_000), 50_000) == [] and find_runs(np.ones(23, int), 23) == [] and find_runs(np.zeros(0, int), 0) == []


def test_runs_query_equals_brute_force(spark):
    rows = {r.doc_id: tuple(r) for r in queries.op12_runs(spark, "/root/testdata/sf0.001").collect()}
    docs = local(table(spark, "documents"))
    assert len(rows) == len(docs)
    for key, text in zip(docs["doc_id"].tolist(), docs["text"]):
        if len(text) < 8_000 or zlib.crc32(str(key).encode()) % 10 == 0:
            assert rows[key] == plain_digest(key, text)


def test_runs_of_odd_rows(spark):
    extra = [(20, "a b c " * 9, None), (20, "x" + " y\t" * 40 + "z", None), (30, " ".join(["p q"] * 40 + ["r"] * 30), None), (None, "k " * 24, None), (None, "k " * 23, None)]
    rows = [*ODD, *extra]
    docs = documents(spark, rows).selectExpr("*", "1 AS runs", "2 AS collapsed", "3 AS _words", "4 AS _plan")
    found = sorted((str(tuple(r)) for r in run_digest(docs).collect()))
    assert found == sorted(str(plain_digest(key, text)) for key, text, _ in rows)
    real = {(r.doc_id, r.collapsed) for r in periodic_runs(docs).collect()}
    assert {(20, "a b c"), (30, "p q r"), (None, "k"), (2, ""), (3, ""), (5, LONG)} <= real
    assert run_digest(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(docs, least=10)


# -- quality votes


def test_directions_are_the_strongest():
    random_ = np.random.default_rng(3)
    dense = np.zeros((60, 20))
    dense[:] = random_.standard_normal((60, 3)) @ random_.standard_normal((3, 20)) + 1e-3 * random_.standard_normal((60, 20))
    slots, lengths = np.tile(np.arange(20), 60), np.full(60, 20)
    found = latent_directions(slots, dense.ravel(), lengths, 3)[:20]
    _, _, right = np.linalg.svd(dense, full_matrices=False)
    assert np.allclose(found @ found.T, right[:3].T @ right[:3], atol=1e-4)


def test_votes_equal_plain_neighbours():
    random_ = np.random.default_rng(4)
    texts = [" ".join(random_.choice(["one", "Two", "3", "four!", "|"], size=random_.integers(1, 30))) for _ in range(70)]
    slots, values, lengths = vectors(texts)
    directions = latent_directions(slots, values, lengths, 6)
    rows = np.zeros((70, directions.shape[1]))
    at = 0
    for i, n in enumerate(lengths.tolist()):
        rows[i] = sum(values[j] * directions[slots[j]] for j in range(at, at + n))
        at += n
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    labels = random_.integers(0, 2, 50).astype(float)
    voters = Voters(directions, rows[:50], labels, 0.6, 5, 2.0)
    for text, row, vote in zip(texts, rows, voters.votes(texts)):
        near = sorted(range(50), key=lambda i: -(rows[i] @ row))[:5]
        weight = [max(0.0, rows[i] @ row) ** 2 for i in near]
        assert abs(vote - (sum(w * labels[i] for w, i in zip(weight, near)) + 0.25 * 0.6) / (sum(weight) + 0.25)) < 1e-6
    assert voters.votes(["", " \n"]).tolist() == pytest.approx([0.6, 0.6])


def test_votes_of_odd_rows(spark):
    train = [(100 + i, PLAIN + f" nice text number {i}") for i in range(40)] + [(200 + i, f"buy!! NOW!! ### {i} " * 9) for i in range(40)]
    docs = documents(spark, [*ODD, *((i, t, None) for i, t in train)])
    labels = spark.createDataFrame([(i, int(i < 200)) for i, _ in train] + [(1, None), (None, 1), (100, 0), (7, 0)], "doc_id long, quality int").selectExpr("*", "1 AS label", "2 AS id")
    voters = learn(docs, labels)
    assert set(np.unique(voters.labels)) == {0.0, 1.0} and np.array_equal(voters.labels, learn(docs.repartition(3), labels).labels)
    rows = local(score(docs, voters))
    assert len(rows) == len(ODD) + len(train) and rows["score"].between(0, 1).all()
    assert ((rows["score"] >= 0.7).astype(int) == rows["predicted"]).all()
    by_id = rows.dropna(subset="doc_id").drop_duplicates("doc_id").set_index("doc_id")
    assert by_id.loc[9, "score"] > 0.8 > 0.2 > by_id.loc[[200 + i for i in range(40)], "score"].max()
    assert by_id.loc[3, "score"] == pytest.approx(voters.share)
    assert all(bool(h) == (zlib.crc32(str(int(i)).encode()) % 4 == 2) for i, h in by_id["held_out"].items())
    assert score(docs.limit(0), voters).count() == 0
    assert set(local(score(docs, learn(docs, labels.limit(0))))["score"]) == {0.5}


def test_votes_hold_on_unseen_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = local(queries.op13_quality_votes(spark, sf_dir))
    labels = local(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = rows[rows["held_out"]].merge(labels, on="doc_id")
    assert len(held) > 60 and (held["predicted"] == held["quality"]).mean() > 0.95
