"""The corpus pipeline: each stage's decisions take effect, and the whole runs on odd rows."""

import random

import corpus_pipeline
from odd import documents, local, table
from tokenizers import Tokenizer

import __spark_entry__ as entry
import public_tokenizers
from prodseq.llm import scratch as written
from prodseq.llm.minhash import near_duplicates
from prodseq.llm.quality import passes, ledger
from prodseq.llm.scratch import Scratch

STAGES = dict(corpus_pipeline.STAGES)
SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = entry.queries()
    assert [next(n for n in names if n.startswith(f"op{k}_")) for k in range(1, 14)] and "pipeline" in names
    assert list(STAGES) == ["quality_rules", "language_id", "near_dedup", "personal_data", "packing"]


def test_stages_follow_each_other(spark):
    scratch = Scratch(spark, "test")
    docs = table(spark, "documents")
    good = scratch.write(STAGES["quality_rules"](spark, docs, SF), "good")
    assert good.columns == docs.columns
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in ledger(docs).filter(passes("base-1") & passes("web-3")).select("row.doc_id").collect()}
    told = scratch.write(STAGES["language_id"](spark, good, SF), "told")
    assert told.columns == docs.columns and told.count() >= 0.97 * good.count()
    single = scratch.write(STAGES["near_dedup"](spark, told, SF), "single")
    components = {r.component_id for r in near_duplicates(told, width=5).collect()}
    assert {r.doc_id for r in single.collect()} == components and single.count() == len(components)
    masked = scratch.write(STAGES["personal_data"](spark, single, SF), "masked")
    assert masked.columns == docs.columns and masked.count() == single.count()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in masked.collect())
    packed = local(STAGES["packing"](spark, masked, SF))
    assert packed["length"].sum() == tokens and set(packed["doc_id"]) == components


def test_run_on_odd_rows(spark, tmp_path):
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {None if x != x else x for x in local(corpus_pipeline.run(spark, str(tmp_path)))["doc_id"]} <= {1, 5, 9, 10}
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_no_side_that_grows_is_broadcast(spark, monkeypatch):
    draw = random.Random(3)
    texts = [" ".join(f"word{draw.randrange(500)}" for _ in range(60)) for _ in range(12)]
    texts += [t + " more" for t in texts[:6]] + [f"{t} order ref {k}4711-{k} was sent to me{k}@mail.org now" for k, t in enumerate(texts[6:])]
    rows = spark.createDataFrame([(k, t, "en", "src", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    write, plans = Scratch.write, []

    def noted(self, frame, name):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return write(self, frame, name)

    def run(docs):
        for name in ("near_dedup", "personal_data", "packing"):
            docs = Scratch(spark, "test").write(STAGES[name](spark, docs, SF), name)
        return sorted(map(tuple, docs.collect()), key=str)

    usual = run(rows)
    monkeypatch.setattr(Scratch, "write", noted)
    monkeypatch.setattr(written, "FEW", -1, raising=False)
    assert run(rows) == usual
    joins = [line for plan in plans for line in plan.splitlines() if "Join" in line]
    assert joins and not [line for line in joins if "SortMergeJoin" not in line]
