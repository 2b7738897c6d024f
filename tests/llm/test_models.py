"""Learned operators: gradients, held-out accuracy and rows they never learn from."""

import zlib

import numpy as np
import pytest
from odd import ODD, documents, local, table
from pyspark.sql import functions as F

from prodseq.llm import language, queries
from prodseq.llm.language import UNKNOWN, Network, keep_known_language, label_texts, learn, predict
from prodseq.llm.toxicity import Machine
from prodseq.llm.toxicity import learn as learn_toxic
from prodseq.llm.toxicity import score, terms, train

SF = "/root/testdata/sf0.01"


def test_gradient_by_differences():
    network = Network.start(["a", "b", "c"], units=3)
    for name in ("inputs", "states", "head", "bias"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    windows = np.random.default_rng(0).integers(0, 256, (6, 4))
    weight, label = np.ones((6, 4)), np.array([0, 1, 2, 1])
    weight[4:, 2] = 0

    def loss():
        chances = network.chances(network.run(windows).astype(np.float64))
        return -(np.log(chances[:, label, np.arange(4)]) * weight).sum() / weight.sum()

    for values, gradient in zip(network.weights(), network.gradient(windows, weight, label), strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept, step = values[at], 1e-3
        values[at] = kept + step
        up = loss()
        values[at] = kept - step
        down = loss()
        values[at] = kept
        assert abs((up - down) / (2 * step) - gradient[at]) < 1e-3 * abs(gradient[at]) + 1e-5


def test_language_query(spark):
    truth = local(spark.read.parquet(f"{SF}/documents.parquet")).set_index("doc_id")
    rows = local(queries.op7_language(spark, SF)).set_index("doc_id")
    assert len(rows) == len(truth)
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.index]
    assert rows["held_out"].tolist() == held
    right = rows["lang_pred"] == truth.loc[rows.index, "lang"]
    assert right[rows["held_out"]].mean() >= 0.97 and right.mean() >= 0.97
    assert rows["score"].between(0, 1).all()


def test_language_odd_rows(spark):
    docs = documents(spark)
    network = learn(docs, per_label=10)
    rows = predict(docs, network).collect()
    assert len(rows) == len(ODD)
    for row, (_, text, _) in zip(rows, ODD, strict=True):
        assert (row.lang_pred == UNKNOWN) == (not any(map(str.isalpha, text or "")))
    assert predict(docs.limit(0), network).count() == 0
    nothing = docs.limit(0)
    assert learn(nothing) is None and {r.lang_pred for r in predict(docs, None).collect()} == {UNKNOWN}
    kept = keep_known_language(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {None, 1, 5, 7, 8, 9, 10}
    assert keep_known_language(nothing).count() == 0


def test_whole_text_counts():
    network = Network.start(["a", "b"], units=2)
    long = "x" * 1000 + "y" * 5000
    assert label_texts(network, [long])[1][0] != label_texts(network, ["x" * 1000])[1][0]
    alone = [label_texts(network, [t])[1][0] for t in ("ab", long, "c")]
    assert np.allclose(label_texts(network, ["ab", long, "1", "c"])[1], [alone[0], alone[1], 0, alone[2]], atol=1e-5)


def plain_chances(network, text):
    """Mean chances of a text, one byte at a time from both ends, with gates as usually written."""
    logistic = lambda x: 1 / (1 + np.exp(-x))
    units, raw = network.states.shape[2], text.encode()
    states = np.zeros((len(raw), 2 * units))
    for side in range(2):
        state = np.zeros(units)
        for t in range(len(raw)) if side == 0 else reversed(range(len(raw))):
            given, carried = network.inputs[side][:, raw[t]], network.states[side] @ state
            update, reset = (logistic(2 * (given + carried)[k * units : (k + 1) * units]) for k in range(2))
            new = np.tanh(given[2 * units :] + 2 * reset * carried[2 * units :])
            state = update * state + (1 - update) * new
            states[t, side * units : (side + 1) * units] = state
    scores = np.exp(states @ network.head.T + network.bias[:, 0])
    return (scores / scores.sum(axis=1, keepdims=True)).mean(axis=0)


@pytest.mark.parametrize("slow", [False, True])
def test_states_are_carried_over_windows(monkeypatch, slow):
    network = Network.start(["a", "b", "c"], units=4, seed=3)
    monkeypatch.setattr(language, "EDGE", 1e-6)
    if slow:
        # blanks keep the state almost as it is, so that no run-in tells it
        network.inputs[:, :4, ord(" ")] = 8
        network.inputs[:, 4:, ord(" ")] = 0
    random = np.random.default_rng(1)
    word = lambda n: "".join(random.choice(list("abcdeéß日 "), n))
    texts = ["a", word(255), word(256), word(300), word(2000), word(50) + " " * 1500 + word(9), "ab" + " " * 700, word(5000)]
    texts = [t if any(map(str.isalpha, t)) else "a" + t for t in texts]
    names, scores = label_texts(network, texts)
    for text, name, found in zip(texts, names, scores, strict=True):
        expected = plain_chances(network, text)
        assert abs(found - expected.max()) < 1e-4 and name == network.labels[int(expected.argmax())]


def test_a_window_runs_again_from_one_side(monkeypatch):
    network = Network.start(["a", "b"], units=4, seed=3)
    # blanks keep the state: each window tells the next one that its guess was wrong, from one end only
    network.inputs[:, :4, ord(" ")] = 8
    network.inputs[:, 4:, ord(" ")] = 0
    steps = []
    walk = Network.walk
    monkeypatch.setattr(Network, "walk", lambda self, side, windows, *rest: steps.append(len(windows)) or walk(self, side, windows, *rest))
    text = "abc" + " " * (40 * language.WINDOW)
    names, scores = label_texts(network, [text, text + "  "])
    expected = plain_chances(network, text)
    assert abs(scores[0] - expected.max()) < 1e-3 and names[0] == network.labels[int(expected.argmax())]
    assert 40 * language.WINDOW < sum(steps) < 60 * language.WINDOW


def test_few_bytes_are_run_again_or_for_a_guess(monkeypatch):
    network = Network.start(["a", "b", "c"], seed=3)
    random = np.random.default_rng(8)
    texts = ["".join(random.choice(list("abcdefgh "), n)) for n in [1900] * 60 + [6000] * 30]
    ran = []
    walk = Network.walk
    monkeypatch.setattr(Network, "walk", lambda self, side, windows, *rest: ran.append(windows.size) or walk(self, side, windows, *rest))
    label_texts(network, texts)
    assert sum(ran) < 2.6 * sum(map(len, texts))


@pytest.mark.parametrize("some", [1, 16, 5000])
def test_chances_are_summed_over_windows_of_any_length(monkeypatch, some):
    network = Network.start(["a", "b", "c"], seed=3)
    monkeypatch.setattr(language, "EDGE", 1e-6)
    monkeypatch.setattr(language, "SOME", some, raising=False)
    random = np.random.default_rng(2)
    texts = ["".join(random.choice(list("abcdeé日 "), n)) for n in (1, 16, 17, 900, 2300, 3000)]
    texts += ["x" * n for n in (language.WINDOW - 1, language.WINDOW, language.WINDOW + 1, 2 * language.WINDOW + 15)]
    texts = ["a" + t for t in texts]
    names, scores = label_texts(network, texts)
    for text, name, found in zip(texts, names, scores, strict=True):
        expected = plain_chances(network, text)
        assert abs(found - expected.max()) < 1e-5 and name == network.labels[int(expected.argmax())]


def test_states_do_not_depend_on_how_many_inputs_are_looked_up(monkeypatch):
    network = Network.start(["a", "b", "c"], units=3)
    windows = np.random.default_rng(4).integers(0, 256, (37, 5))
    left = np.array([37, 1, 20, 36, 9])
    found = []
    for most in (1, 35, 100, 10_000):
        monkeypatch.setattr(language, "LOOKED_UP", most, raising=False)
        found.append(network.run(windows, left=left))
    assert all(np.array_equal(found[0], f) for f in found)


def test_gradient_by_differences_with_short_windows():
    network = Network.start(["a", "b"], units=3, seed=2)
    for name in ("inputs", "states", "head", "bias"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    windows, left, label = np.random.default_rng(4).integers(0, 256, (7, 3)), np.array([7, 3, 5]), np.array([0, 1, 1])
    weight = (np.arange(7)[:, None] < left).astype(float)

    def loss():
        chances = network.chances(network.run(windows, left=left).astype(np.float64))
        return -(np.log(chances[:, label, np.arange(3)]) * weight).sum() / weight.sum()

    for values, gradient in zip(network.weights(), network.gradient(windows, weight, label, left), strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept, step = values[at], 1e-3
        values[at] = kept + step
        up = loss()
        values[at] = kept - step
        down = loss()
        values[at] = kept
        assert abs((up - down) / (2 * step) - gradient[at]) < 1e-3 * abs(gradient[at]) + 1e-5


def test_logits_equal_the_plain_sum_over_pairs():
    random = np.random.default_rng(8)
    machine = Machine(random.standard_normal(50), random.standard_normal((50, 4)), 0.3)
    sets = [[], [7], [3, 4], *(random.choice(50, size, replace=False).tolist() for size in (5, 17, 50)), []]
    plain = [
        machine.bias
        + sum(machine.weights[a] for a in one)
        + sum(float(machine.factors[a] @ machine.factors[b]) for k, a in enumerate(one) for b in one[k + 1 :])
        for one in sets
    ]
    found = machine.logits(np.array([f for s in sets for f in s], dtype=np.int64), np.array([len(s) for s in sets]))
    assert np.allclose(found, plain)


def test_toxicity_fit_does_not_depend_on_the_order_of_rows(spark):
    words = "red green blue stone river cloud".split()
    rows = [(k // 2, f"{words[k % 6]} {words[k // 6 % 6]} {'bad' if k % 4 < 2 else 'good'}") for k in range(120)]
    labels = spark.createDataFrame([(k, int(k % 2 == 0)) for k in range(60)], "doc_id long, toxic int")
    fits = [learn_toxic(spark.createDataFrame(some, "doc_id long, text string").repartition(n), labels) for some, n in ((rows, 1), (rows[::-1], 5))]
    assert (fits[0].weights == fits[1].weights).all() and (fits[0].factors == fits[1].factors).all() and fits[0].bias == fits[1].bias


def test_factors_learn_what_weights_cannot():
    # two terms are toxic only together
    sets = [[0], [1], [0, 1], []] * 100
    labels = np.array([0, 0, 1, 0] * 100)
    lengths = np.array([len(s) for s in sets])
    machine = train(np.array([f for s in sets for f in s]), lengths, labels, 2, np.zeros(1, np.int32), rounds=1500)
    chances = 1 / (1 + np.exp(-machine.logits(np.array([0, 1, 0, 1]), np.array([1, 1, 2]))))
    assert chances[2] > 0.5 > max(chances[:2])


def test_toxicity_query(spark):
    sf = "/root/testdata/sf0.1"
    truth = local(spark.read.parquet(f"{sf}/labels.parquet")).set_index("doc_id")["toxic"]
    rows = local(queries.op5_toxicity(spark, sf)).set_index("doc_id")
    assert rows["score"].between(0, 1).all() and (rows["predicted"] == (rows["score"] >= 0.5)).all()
    both = rows.join(truth, how="inner")
    held = both[both["held_out"]]
    hits = ((held["predicted"] == 1) & (held["toxic"] == 1)).sum()
    assert hits / (held["toxic"] == 1).sum() >= 0.8 and hits / (held["predicted"] == 1).sum() >= 0.85


def test_toxicity_odd_rows(spark):
    docs, labels = documents(spark), table(spark, "labels").selectExpr("doc_id", "IF(doc_id % 7 = 0, NULL, toxic) AS toxic", "quality")
    machine = learn_toxic(docs, labels)
    rows = score(docs, machine).collect()
    assert len(rows) == len(ODD) and score(docs.limit(0), machine).count() == 0
    nothing = learn_toxic(docs, labels.limit(0))
    assert {r.score for r in score(docs, nothing).collect()} == {0.5}


def test_toxicity_counts_texts_that_share_their_extreme_slots(spark):
    # every text holds the words of the least and the greatest slot
    names = [f"w{k}" for k in range(2000)]
    slots = {r.w: r.s[0] for r in spark.createDataFrame([(w,) for w in names], "w string").select("w", terms(F.col("w")).alias("s")).collect()}
    order = sorted(names, key=slots.get)
    least, greatest, inner = order[0], order[-1], order[1:-1]
    texts = [f"{least} {greatest} {inner[k]} {inner[-1] if k % 2 else inner[-2]}" for k in range(400)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, toxic int")
    rows = local(score(docs, learn_toxic(docs, labels))).set_index("doc_id")
    assert (rows["predicted"] == rows.index % 2).all()


def test_toxicity_learns_terms_that_are_toxic_only_together(spark):
    # each term alone is as frequent in clean as in toxic texts
    kinds = ["", "alpha", "beta", "alpha beta"]
    fillers = np.random.default_rng(2).integers(0, 58, (4000, 6))
    docs = spark.createDataFrame([(k, f"{kinds[k % 4]} {' '.join(f'f{x}' for x in fillers[k])}") for k in range(4000)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 in (0, 3))) for k in range(4000)], "doc_id long, toxic int")
    rows = local(score(docs, learn_toxic(docs, labels))).set_index("doc_id")
    chance = [rows[rows.index % 4 == k]["score"].mean() for k in range(4)]
    assert chance[3] > 0.55 and max(chance[1:3]) < 0.5
