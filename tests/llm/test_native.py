"""Quality ledger and secret scan against SQL, and their policies and queries."""

import re

import duckdb
import pytest
from odd import ODD, documents, local, table
from pyspark.sql import functions as F

from prodseq.llm import queries
from prodseq.llm.quality import POLICIES, RULES, ablation, keep_good, ledger, mask, store, verdicts
from prodseq.llm.secrets import RULES as SECRETS
from prodseq.llm.secrets import candidates, find_secrets, secret_digest
from prodseq.llm.trigrams import trigram_query


def shown(frame):
    return sorted(tuple("" if v is None or v != v else str(v) for v in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", ["op1_quality", "op6_secrets"])
@pytest.mark.parametrize("source", ["table", "odd"])
def test_query_equals_sql(spark, name, source, tmp_path):
    docs = table(spark, "documents") if source == "table" else documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.execute(queries.oracle_sql()[name]).df()
    found = local(queries.queries()[name](spark, str(tmp_path)))[list(expected.columns)]
    for column in found.select_dtypes("float"):
        expected[column] = expected[column].astype(float)
    assert shown(found) == shown(expected)


def brute_repeats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return len(words), len(hit)


def test_repeated_windows(spark):
    texts = ["a b c d e", "a a a a a a", "a b c d e f a b c d e", "a b c d e a b c d e a b c d", "x " * 40, "p q r s t u p q r s t v q r s t u"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_repeat_words) for r in verdicts(store(docs)).collect()}
    assert found == {i: brute_repeats(t) for i, t in enumerate(texts)}


def test_ablation_counts_by_bits(spark):
    rows = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,), (1 << 5,)], "fail_bits long")
    found = {(r.policy, r.rule): r for r in ablation(rows).collect()}
    assert len(found) == sum(map(len, POLICIES.values()))
    few = found["base-1", "few_words"]
    assert (few.n_rows, few.n_failed, few.n_sole, few.n_kept, few.n_kept_without) == (6, 3, 2, 3, 5)
    assert found["web-2", "word_length"].n_sole == 1
    assert ablation(rows.limit(0)).count() == 0 and mask("web-3") == (1 << len(RULES)) - 1


def test_each_rule_rejects_its_text(spark):
    plain = [f"word{'abcdefghij'[i % 10]}{'klmnopqrstuvwxyz'[i % 16]} here" for i in range(12)]
    cases = {
        "": " ".join(plain),
        "few_words": "only three words",
        "symbols": " ".join(plain) + " ####################",
        "repeated_lines": "\n".join(line for first in plain[:6] for line in (first, "Same")),
        "capitals": " ".join(plain).upper(),
        "word_length": " ".join("abcdefghijklmnopqrstuvwxyzabcd" + c for c in "abcdefghijk"),
        "letterless": " ".join(f"{i * 7919 % 90001:06d}" for i in range(12)),
        "long_words": " ".join(plain) + " " + " ".join("x" * 41 + c for c in "abcdef"),
        "bullet_lines": "\n".join(f" - {line}" for line in plain),
        "cut_lines": "\n".join(f"{line}...\r" for line in plain),
    }
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(cases.values())], "doc_id long, text string")
    stored = store(docs)
    found = {r.doc_id: (r.sole_failure or "", r.kept) for r in verdicts(stored).collect()}
    assert found == {i: (name, not name) for i, name in enumerate(cases)}
    assert "text" not in stored.columns and "row" not in stored.columns
    assert {r.doc_id for r in verdicts(stored, "web-2").filter("kept").collect()} == {0, 6, 7, 8, 9}


def test_good_rows_keep_all_columns(spark):
    docs = documents(spark)
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {None, 1, 5, 9, 10}
    assert ledger(docs).count() == len(ODD) and keep_good(docs.limit(0)).count() == 0


def test_trigram_queries():
    assert trigram_query("abcd") == [["abc", "bcd"]]
    assert trigram_query("abc|xyz") == [["abc"], ["xyz"]]
    assert trigram_query("ab?c+de[0-9]+") == []
    assert trigram_query("(?i:KEY)[0-9]") == [["key"]]
    assert trigram_query("(abc)+x") == [["abc"]] and trigram_query("(abc)*x") == []
    assert trigram_query("[0-9a-f]{24,}") == []


TROUBLE = [
    (1, 'password = "abcdef" and PASSWORD:x token=abc api_key: "ABC/def=1" apikey=\'123456\''),
    (2, "AKIA" + "A" * 16 + " AKIAB AKIA" + "0" * 30),
    (3, "é😀 " + "0123456789abcdef" * 2 + "g" + "f" * 23),
    (4, "ghp_" + "a1" * 20 + " xoxb-1234567890-abc sk_live_" + "A" * 24 + " AIza" + "x" * 35),
    (5, "-----BEGIN RSA PRIVATE KEY----- eyJabcdefgh.eyJabcdefgh.sig"),
    (6, None), (7, ""), (None, "secret=abcdefg"), (None, "nothing"), (8, "secret=token=abcdefgh"), (8, "secret=token=abcdefgh"),
]


def test_secrets_equal_plain_search(spark):
    docs = spark.createDataFrame(TROUBLE, "doc_id long, text string").withColumn("spans", F.lit(1))
    found = [[(s.start, s.place, s.end) for s in r.spans] for r in find_secrets(docs).select("row.text", "spans").orderBy("row.doc_id", "row.text").collect()]
    texts = [r.text or "" for r in docs.orderBy("doc_id", "text").collect()]
    plain = [sorted((m.start(), k, m.end()) for k, rule in enumerate(SECRETS) for m in re.finditer(rule.pattern, t) if len(m[rule.group]) >= rule.least) for t in texts]
    assert found == plain
    assert secret_digest(docs).count() == len(TROUBLE)


def test_candidates_come_from_postings(spark):
    texts = spark.createDataFrame([(i, t or "") for i, t in TROUBLE], "key long, text string")
    found = {r.key: set(r.rules) for r in candidates(texts).collect()}
    assert found[1] == {"assign"} and found[2] == {"access"} and 3 not in found and found[5] == {"key_block", "web_token"}
    assert candidates(texts.limit(0)).count() == 0


def test_ablation_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.queries()["op1_ablation"](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    expected = con.execute(queries.oracle_sql()["op1_ablation"])
    assert rows.columns == [d[0] for d in expected.description]
    assert sorted(map(tuple, rows.collect())) == sorted(expected.fetchall())
