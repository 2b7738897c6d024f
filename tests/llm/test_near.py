"""Near-duplicate operators against brute force, and their shared parts."""

import random
import re
import tracemalloc

import numpy as np
import pytest
from odd import ODD, documents, local, table

from prodseq.llm import queries, shingles
from prodseq.llm.components import components
from prodseq.llm.embeddings import STEPS, Shard, _stored, audited, links_between, near_duplicates
from prodseq.llm.minhash import COORDINATES, _collisions, _common, _sets, keep_one
from prodseq.llm.minhash import near_duplicates as near_texts
from prodseq.llm.scratch import Scratch
from prodseq.llm.shingles import hashes_of_runs, mixed, shingle_sets


def smallest(links, n):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    random.seed(3)
    chain = [(i, i + 1) for i in range(60, 120)]
    edges = [(random.randrange(50), random.randrange(50)) for _ in range(30)] + random.sample(chain, len(chain)) + [(200, k) for k in range(201, 260)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    expected = smallest(edges, 300)
    assert found == {n: expected[n] for e in edges if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


def words(text, width):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute_texts(texts, width):
    sets = [words(t, width) for t in texts]
    links = [
        (a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return [len(s) for s in sets], smallest(links, len(sets))


def noisy_copies():
    """Copies of one text with up to a fifth of its words changed, some exact ones, and other texts."""
    random.seed(9)
    base = [f"word{random.randrange(400)}" for _ in range(150)]
    texts = []
    for k in range(120):
        changed = base[:]
        for at in random.sample(range(150), random.choice([0, 2, 5, 8, 12, 20, 30])):
            changed[at] = f"x{k}y{at}"
        texts.append(" ".join(changed))
    return texts + [" ".join(f"z{random.randrange(300)}" for _ in range(80)) for _ in range(40)] + ["solo", "SOLO", "ÉA b", "éA b", "", None, " \n"]


def test_shingle_sets_have_the_right_sizes():
    texts = [*(t or "" for t in noisy_copies()), "a b a b a b", "a", "b a"]
    for width in (2, 5):
        assert [len(s) for s in shingle_sets(texts, width)] == [len(words(t, width)) for t in texts]


def test_hashes_of_runs_in_blocks(monkeypatch):
    random.seed(5)
    raw = [bytes(random.choices(b"ab\xc3 \n\t", weights=(9, 9, 9, 3, 1, 1), k=n)) for n in (0, 1, 40, 300, 0, 7)] + [b"x" * 200, b" " * 50, b"y" * 63 + b" z"]
    runs = [re.findall(rb"[^\x20\x09-\x0D]+", r) for r in raw]
    base = 0x9E3779B97F4A7C15
    plain = [sum((byte + 1) * base**k for k, byte in enumerate(run)) % 2**64 for found in runs for run in found]
    for block in (1, 3, 64, 1 << 18):
        monkeypatch.setattr(shingles, "BLOCK", block, raising=False)
        hashes, counts = hashes_of_runs(raw)
        assert counts.tolist() == [len(found) for found in runs]
        assert np.array_equal(hashes, mixed(np.array(plain, np.uint64)))


def test_hashes_of_runs_take_few_bytes_for_each_of_a_text(monkeypatch):
    monkeypatch.setattr(shingles, "_powers", (np.ones(1, np.uint64), np.ones(1, np.uint64)))
    raw = [b"words of one long text " * 200_000]
    tracemalloc.start()
    hashes_of_runs(raw)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 24 * len(raw[0])


@pytest.mark.parametrize("width", [2, 5])
def test_minhash_equals_brute_force(spark, width):
    texts = noisy_copies()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    sizes, roots = brute_texts(texts, width)
    rows = local(near_texts(docs, width=width)).sort_values("doc_id")
    assert rows["n_shingles"].tolist() == sizes and rows["component_id"].tolist() == roots
    assert rows["kept"].tolist() == [i == r for i, r in enumerate(roots)]
    assert sorted(r.doc_id for r in keep_one(docs, width=width).collect()) == [i for i, r in enumerate(roots) if i == r]


def test_minhash_query_equals_brute_force(spark):
    docs = local(table(spark, "documents")).sort_values("doc_id")
    sizes, roots = brute_texts(docs["text"].tolist(), 2)
    rows = local(queries.op9_minhash(spark, "/root/testdata/sf0.001")).sort_values("doc_id")
    ids = docs["doc_id"].tolist()
    assert rows["n_shingles"].tolist() == sizes and rows["component_id"].tolist() == [ids[r] for r in roots]


def test_minhash_odd_rows(spark):
    docs = documents(spark)
    rows = near_texts(docs).collect()
    assert len(rows) == len(ODD)
    assert sorted(r.kept for r in rows if r.doc_id == 1) == [True, True]
    assert {(r.component_id, r.kept) for r in rows if r.doc_id is None} == {(1, False), (None, False)}
    assert {r.component_id for r in rows if r.doc_id in (9, 10)} == {9}
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert near_texts(docs.limit(0)).count() == 0 and keep_one(docs.limit(0)).count() == 0


def test_rows_without_id_meet_their_own_text_only(spark):
    # texts are found by the number of their row, so rows without id, or with one id, add no work
    random.seed(12)
    texts = noisy_copies() * 3
    nodes = spark.createDataFrame([(i,) for i in range(0, len(texts), 2)], "node long")
    plain = spark.createDataFrame([(i, None, t) for i, t in enumerate(texts)], "row long, id long, text string")
    assert _sets(plain, nodes, 2).count() == nodes.count()
    sizes, roots = brute_texts(texts, 2)
    with_ids = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for doc_id in ("CAST(NULL AS LONG)", "7L"):
        rows = near_texts(with_ids.selectExpr(f"{doc_id} AS doc_id", "text"))
        assert rows.groupBy().sum("n_shingles").first()[0] == sum(sizes)
    groups = len({r for r, n in zip(roots, sizes) if n})
    empty = sum(n == 0 for n in sizes)
    assert keep_one(with_ids.selectExpr("CAST(NULL AS LONG) AS doc_id", "text"), width=2).count() == groups + empty


def test_sketch_collisions(spark):
    random.seed(2)
    a, b = ([random.choice([0, 1, 128, 255]) for _ in range(COORDINATES)] for _ in range(2))
    number = lambda x: [int.from_bytes(bytes(x[i : i + 8]), "little", signed=True) for i in range(0, COORDINATES, 8)]
    frame = spark.createDataFrame([(number(a), number(b))], "a array<long>, b array<long>")
    assert frame.select(_collisions(frame.a, frame.b, COORDINATES)).first()[0] == sum(x == y for x, y in zip(a, b))


def test_common_counts():
    random.seed(8)
    sets = [sorted(random.sample(range(40), random.randint(0, 20))) for _ in range(9)]
    arrays = [np.array(s, np.uint64) for s in sets]
    assert _common(arrays[:4], arrays[4:]).tolist() == [[len(set(a) & set(b)) for b in sets[4:]] for a in sets[:4]]
    assert _common(arrays[:0], arrays).shape == (0, 9)


def brute_vectors(vectors, labels, least=0.93):
    n = len(vectors)
    good = [v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for v, label in zip(vectors, labels)]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if g else None for v, g in zip(vectors, good)]
    links = [
        (a, b) for a in range(n) for b in range(a)
        if good[a] and good[b] and labels[a] == labels[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least
    ]
    degree = np.bincount(np.array(links, int).ravel(), minlength=n).tolist() if links else [0] * n
    return degree, smallest(links, n)


def vectors_with_trouble():
    random_ = np.random.default_rng(4)
    rows = []
    for label in (0, 1, None):
        centres = random_.standard_normal((6, 16))
        for k in range(150):
            rows.append(((centres[k % 6] + 0.16 * random_.standard_normal(16) * (k % 5)).tolist(), label))
    rows += [(rows[3][0], 0), (rows[3][0], 0), (rows[3][0], 1), (None, 0), ([0.0] * 16, 0), ([float("nan")] * 16, 0), ([float("inf")] + [1.0] * 15, 1), ([None] + [1.0] * 15, 1), ([1.0, 2.0], 0), ([2.0, 4.0], 0), ([], 0)]
    return [v for v, _ in rows], [x for _, x in rows]


@pytest.mark.parametrize("shard_rows", [8192, 40])
def test_embeddings_equal_brute_force(spark, shard_rows):
    vectors, labels = vectors_with_trouble()
    frame = spark.createDataFrame(list(zip(range(len(vectors)), vectors, labels)), "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS row", "2 AS n", "3 AS shard", "4 AS step")
    degree, roots = brute_vectors(vectors, labels)
    rows = local(near_duplicates(frame, shard_rows=shard_rows)).sort_values("vec_id")
    assert rows["n_links"].tolist() == degree
    assert rows["component_id"].tolist() == roots
    assert near_duplicates(frame.limit(0)).count() == 0


def test_embedding_query(spark):
    frame = local(table(spark, "embeddings")).sort_values("vec_id")
    degree, roots = brute_vectors(list(frame["embedding"]), frame["label"].tolist())
    rows = local(queries.op2_embeddings(spark, "/root/testdata/sf0.001")).sort_values("vec_id")
    assert rows["n_links"].tolist() == degree
    assert rows["component_id"].tolist() == [frame["vec_id"].tolist()[r] for r in roots]


@pytest.mark.parametrize("shard_rows", [8192, 60])
def test_every_vector_searches_graphs(spark, shard_rows):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    plain = local(frame).sort_values("vec_id")
    degree, roots = brute_vectors(list(plain["embedding"]), plain["label"].tolist())
    rows = local(near_duplicates(frame, shard_rows=shard_rows)).sort_values("vec_id")
    assert rows["graph_searches"].min() >= (1 if shard_rows > 1000 else 3)
    assert rows["n_links"].tolist() == degree and rows["component_id"].tolist() == [plain["vec_id"].tolist()[r] for r in roots]


def shard_of(vectors, first=0):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return Shard(_stored(np.arange(len(unit)) + first, np.ones(len(unit), int), unit))


def test_audit_counts_what_each_step_finds():
    random_ = np.random.default_rng(0)
    vectors = random_.standard_normal((900, 12))
    vectors[1:200] = vectors[0] + 0.02 * random_.standard_normal((199, 12))  # more alike ones than the first beams hold
    shard = shard_of(vectors)
    some = np.arange(0, 900, 9)
    counted = audited(shard, shard.nodes[some], shard.vectors[some], 0.8)
    truth = shard.exact(shard.vectors, 0.8)
    np.fill_diagonal(truth, False)
    want = {int(i): int(truth[i].sum()) for i in some if truth[i].any()}
    for step, part in counted.groupby("step"):
        assert dict(zip(part["node"], part["links"])) == want and (part["found"] <= part["links"]).all()
    last = counted[counted["step"] == len(STEPS) - 1]
    assert (last["found"] == last["links"]).all()
    other = shard_of(random_.standard_normal((50, 12)), 5000)
    assert audited(other, np.arange(3), np.eye(12)[:3], 0.9999).empty


def test_wider_steps_find_what_narrow_ones_miss():
    random_ = np.random.default_rng(1)
    a, b = shard_of(random_.standard_normal((300, 32))), shard_of(random_.standard_normal((3000, 32)), 1000)
    truth = b.exact(a.vectors, 0.55)
    narrow = b.found(a.vectors, 0.55, 4, 0.0)
    found = [links_between(a, b, 0.55, step) for step in range(len(STEPS))]
    assert all(not (f & ~truth).any() for f in [narrow, *found])
    assert narrow.sum() < 0.9 * truth.sum() and (found[-1] == truth).all()
    assert found[3].sum() > 0.99 * truth.sum()


def test_audit_widens_a_label_until_it_passes(spark, monkeypatch):
    # weak links of random vectors: a narrow beam misses many, so the label climbs the ladder
    random_ = np.random.default_rng(2)
    vectors = random_.standard_normal((1200, 24))
    frame = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    degree, roots = brute_vectors(list(vectors), [i % 2 for i in range(1200)], 0.5)
    rows = local(near_duplicates(frame, least=0.5, shard_rows=300)).sort_values("vec_id")
    assert rows["audit_recall"].min() >= 0.99
    assert rows["n_links"].sum() >= 0.99 * sum(degree) and (rows["n_links"].to_numpy() <= degree).all()
    assert rows["component_id"].tolist() == roots
