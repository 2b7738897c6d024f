"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.quality import store, verdicts

    return verdicts(store(_table(spark, sf_dir, "documents")))


def op1_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.quality import ablation, store

    return ablation(store(_table(spark, sf_dir, "documents")))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.embeddings import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.93)


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.pieces import encode_and_decode

    return encode_and_decode(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.token_counts import count_tokens

    return count_tokens(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), limit=2048)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.toxicity import learn, score

    docs = _table(spark, sf_dir, "documents")
    return score(docs, learn(docs, _table(spark, sf_dir, "labels")))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.secrets import secret_digest

    return secret_digest(_table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.language import learn, predict

    docs = _table(spark, sf_dir, "documents")
    return predict(docs, learn(docs))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), window=2048, end_id=1)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.pii import find_personal_data

    return find_personal_data(_table(spark, sf_dir, "documents"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.max_sketches import rank_documents

    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.periodic_runs import run_digest

    return run_digest(_table(spark, sf_dir, "documents"))


def op13_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prodseq.llm.neighbour_votes import learn, score

    docs = _table(spark, sf_dir, "documents")
    return score(docs, learn(docs, _table(spark, sf_dir, "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op1_ablation": op1_ablation,
        "op2_embeddings": op2_embeddings,
        "op3_pieces": op3_pieces,
        "op4_token_counts": op4_token_counts,
        "op5_toxicity": op5_toxicity,
        "op6_secrets": op6_secrets,
        "op7_language": op7_language,
        "op8_packing": op8_packing,
        "op9_minhash": op9_minhash,
        "op10_personal_data": op10_personal_data,
        "op11_search": op11_search,
        "op12_runs": op12_runs,
        "op13_quality_votes": op13_quality_votes,
    }


def oracle_sql() -> dict[str, str]:
    from prodseq.llm.max_sketches import RANKED_SQL
    from prodseq.llm.quality import ABLATION_SQL, VERDICTS_SQL
    from prodseq.llm.secrets import DIGEST_SQL

    return {"op1_quality": VERDICTS_SQL, "op1_ablation": ABLATION_SQL, "op6_secrets": DIGEST_SQL, "op11_search": RANKED_SQL}
