"""Named queries of the pipeline operators, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractcheck.llm import chat, decontaminate, divergence, fill_in_middle, fingerprints, licences, mixing, ngram_join, pii, quality_model, rules, token_counts, toxicity
from contractcheck.llm.oracles import ABLATION_SQL, CONTAMINATION_SQL, DIVERGENCE_SQL, FIM_SQL, JACCARD_SQL, LICENCE_SQL, MIX_SQL, RULES_SQL

TOKENIZER = "byte_bpe_50k.json"


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(documents(spark, sf_dir))
    counts = [pii.number_of(k).cast("bigint").alias(f"n_{k}") for k in pii.BASE]
    base = pii.digest(F.col("base"))
    every = F.concat("base", F.transform("extra", lambda s: s.dropFields("score")))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), pii.digest(every).alias("spans"))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(documents(spark, sf_dir))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality(documents(spark, sf_dir))


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = toxicity.train(docs, labels, usable=fold != 0)
    scored = toxicity.toxicity(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("sentences").cast("bigint").alias("n_sentences"),
        F.transform("sentences", lambda s: F.concat_ws(":", s["start"], s["end"])).alias("sentence_spans"),
    )


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("conv").cast("string").cast("binary")) % 5
    return chat.chat_turns(documents(spark, sf_dir, "conversations"), usable=fold != 0)


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    ids = F.array_join("items", ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(documents(spark, sf_dir))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.ledger(documents(spark, sf_dir))
    base = ~rules.kept_under("base-1")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & rules.kept_under("web-1")).alias("kept"), "bits")


def rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.ablation(rules.ledger(documents(spark, sf_dir)))


def fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fim_digests(documents(spark, sf_dir))


def source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(documents(spark, sf_dir))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


QUERIES = {
    "op1_pii": pii_spans,
    "op2_jaccard_join": jaccard_join,
    "op3_quality": quality,
    "op4_mix": mix,
    "op5_token_counts": tokens,
    "op6_toxicity": toxic,
    "op7_chat_format": chat_format,
    "op8_contamination": contamination,
    "op9_licences": licence_scan,
    "op10_quality_rules": quality_rules,
    "rule_ablation": rule_ablation,
    "op11_fill_in_middle": fim,
    "op12_source_divergence": source_audit,
    "op13_fingerprints": document_fingerprints,
}
ORACLES = {
    "op2_jaccard_join": JACCARD_SQL,
    "op4_mix": MIX_SQL,
    "op8_contamination": CONTAMINATION_SQL,
    "op9_licences": LICENCE_SQL,
    "op10_quality_rules": RULES_SQL,
    "rule_ablation": ABLATION_SQL,
    "op11_fill_in_middle": FIM_SQL,
    "op12_source_divergence": DIVERGENCE_SQL,
}
