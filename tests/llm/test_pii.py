"""Personal data: fixed patterns against plain search, and contexts that find unseen ones."""

import hashlib
import random
import re

from odd import ODD, documents, local, table
from pyspark.sql import functions as F

from prodseq.llm import queries
from prodseq.llm.pii import KINDS, _luhn, base_spans, candidates, find_personal_data, mask_personal_data

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = (True, kind == 1 and all(int(p) <= 255 for p in m[0].split(".")), 13 <= len(digits) <= 19 and _luhn(digits), 9 <= len(digits) <= 15)[kind]
            if good:
                found.append((kind, m.start(), m.end()))
    return found


def test_base_spans_equal_plain_search():
    random.seed(6)
    letters = list("0123456789" * 2 + "..--@@+ ()ab\n")
    for _ in range(20_000):
        text = "".join(random.choices(letters, k=random.randint(0, 30)))
        assert base_spans(text) == plain(text)
    assert base_spans("1" * 50_000 + "." * 10 + "a" * 50_000) == []


def test_query_equals_plain_search(spark):
    texts = local(table(spark, "documents")).set_index("doc_id")["text"]
    rows = local(queries.op10_personal_data(spark, "/root/testdata/sf0.001"))
    assert len(rows) == len(texts)
    for row in rows.itertuples():
        spans = plain(texts[row.doc_id])
        told = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)
        assert row.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in spans) for k in range(4)]
        assert row.spans.startswith(told)


def letters():
    """Addresses in one context, a form of identifier no pattern knows in the same, and numbers elsewhere."""
    random.seed(1)
    rows = [f"Note {k}: client id 10.0.{k % 200}.{k % 250} confirmed today." for k in range(60)]
    rows += [f"Note {k}: client id 10.0.{k}.{k + 300} confirmed today." for k in range(3)]
    rows += [f"The year {1900 + k} had {random.randrange(10_000, 99_999)} cases in all." for k in range(60)]
    return rows


def test_contexts_find_unseen_identifiers(spark):
    texts = letters()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = local(find_personal_data(docs)).set_index("doc_id")
    found = {i: [texts[i][int(s.split(":")[1]) : int(s.split(":")[2])] for s in rows.loc[i, "spans"].split(",") if s.startswith("other")] for i in rows.index}
    assert all(found[i] == [f"10.0.{i - 60}.{i + 240}"] for i in range(60, 63))
    assert not any(found[i] for i in found if i not in range(60, 63))


def plain_discovery(texts):
    """The same bootstrapping in one process: {document: spans}."""
    uses, graph = [], {}
    for row, text in enumerate(texts):
        for c in candidates(text, base_spans(text)):
            patterns = [("before", c["before"], c["shape"])] * (c["before"] != "") + [("after", c["shape"], c["after"])] * (c["after"] != "")
            patterns += [("both", c["before"], c["after"])] * (c["before"] != "" and c["after"] != "")
            for p in patterns:
                uses.append((row, c, p))
                held = graph.setdefault(p, {})
                held[c["instance"]] = held.get(c["instance"], False) or c["seed"]
    state = {}
    for held in graph.values():
        for token, seed in held.items():
            state[token] = 1 if seed or state.get(token) == 1 else 0
    seeds = {t for t, s in state.items() if s == 1}
    near = {t for held in graph.values() if any(held.values()) for t in held}
    for p, held in graph.items():
        if p[0] == "both" and len(held) >= 3 and not any(held.values()) and 2 * len(near & set(held)) < len(held):
            state |= {t: -1 for t in held if t not in seeds}
    while True:
        trust = {}
        for p, held in graph.items():
            good, bad, unknown = (sum(state[t] == k for t in held) for k in (1, -1, 0))
            share = good / (good + bad + max(0, unknown - good) + 1)
            if good >= 3 and share >= 0.8:
                trust[p] = share
        new = set()
        for token in [t for t, s in state.items() if s == 0]:
            wrong = 1.0
            for p in [p for p, held in graph.items() if token in held and p in trust]:
                wrong *= 1 - trust[p]
            if 1 - wrong >= 0.8:
                new.add(token)
        if not new:
            break
        state |= {t: 1 for t in new}
    found = {}
    for row, c, p in uses:
        if not c["seed"] and p in trust and state[c["instance"]] == 1 and c["instance"] not in seeds:
            found.setdefault(row, set()).add((c["start"], c["end"]))
    return found


def added(docs):
    rows = find_personal_data(docs).collect()
    return {r.doc_id: {tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("other")} for r in rows if "other" in r.spans}


def test_discovery_equals_plain_bootstrapping(spark):
    random.seed(21)
    words = ["id", "call", "code", "the", "of", "on"]
    for _ in range(3):
        forms = [lambda: f"10.{random.randrange(9)}.1.{random.randrange(99)}", lambda: f"AB-{random.randrange(10**5, 10**6)}", lambda: str(random.randrange(1000, 9999)), lambda: f"u{random.randrange(10)}@x.de"]
        texts = []
        for _ in range(150):
            at = random.randrange(3)
            texts.append(f"{words[at]} {random.choice(forms[: at + 2])()} {random.choice(words[3:5])} more")
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        assert added(docs) == plain_discovery(texts)


def test_half_of_a_context_may_be_unseen(spark):
    texts = [f"Please call +1 (555) 010-{1000 + k} today." for k in range(40)]
    texts += [f"Please call 0171/{230000 + 37 * k} today." for k in range(40)]
    texts += [f"Built in {1800 + k} by hand." for k in range(50)] + [f"Please call {1800 + k} today." for k in range(3)]
    # what a first round accepts makes a second context good
    texts += [f"Fax 0171/{230000 + 37 * k} again." for k in range(10)] + [f"Fax 0171/{990000 + k} again." for k in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = added(docs)
    assert set(range(40, 80)) <= set(found) and not set(found) & set(range(80, 133))
    assert set(range(133, 147)) <= set(found)
    assert found == plain_discovery(texts)


def test_long_tokens_are_cut_at_punctuation():
    text = '{"a":"' + "x" * 80 + '","phone":"0171-234567","b":"' + "y" * 90 + '"}'
    assert [c["instance"] for c in candidates(text, [])] == ["0171-234567"]
    assert candidates("9" * 200, []) == [] and candidates("a" * 100 + "1234", []) == []


def test_masking(spark):
    docs = spark.createDataFrame([(1, "mail a.b@c.de now", 17), (2, None, 0), (3, "call +1 (555) 123-4567!", 23), (4, "none", 4)], "doc_id long, text string, n_chars int").withColumn("row", F.lit("x"))
    masked = mask_personal_data(docs)
    assert masked.schema.names == docs.schema.names
    rows = {r.doc_id: r for r in masked.collect()}
    assert rows[1].text == "mail <email> now" and rows[1].n_chars == len(rows[1].text)
    assert rows[2].text is None and rows[3].text == "call <phone>!" and rows[4].text == "none"


def test_odd_rows(spark):
    docs = documents(spark)
    assert find_personal_data(docs).count() == len(ODD)
    assert mask_personal_data(docs).columns == docs.columns
    assert find_personal_data(docs.limit(0)).count() == 0 and mask_personal_data(docs.limit(0)).count() == 0
