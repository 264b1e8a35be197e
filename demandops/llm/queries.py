"""The registered queries of the corpus operators (production parameters)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandops.llm import chat_format, decontamination, jaccard_join, lexical_search, merkle, mixing, packing, quality_lm, quality_rules, secret_scan, suffix_dedup, toxicity, url_filter
from demandops.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Rules of the query on ``pages`` (fixed values).
URL_RULES: list[url_filter.Rule] = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Host name parts whose pages make up the list of the query (fixed values).
LISTED_HOST_PARTS = "(^|[.-])(spam|pills|casino|lottery)([.-]|$)"


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    listing = pages.filter(url_filter.host_of(F.col("url")).rlike(LISTED_HOST_PARTS)).select("url")
    return (url_filter.filter_urls(pages, listing, URL_RULES)
            .select("page_id", "host", "path", "rule", "verdict", "canonical", "listed"))


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op10_chat_format")
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_conversations(table(spark, sf_dir, "conversations"))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack_documents(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"))


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


@query("op2_quality_lm")
def op2_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (quality_lm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
            .select("doc_id", "lang", "n_symbols", "perplexity", "threshold", "accepted"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn(
        "held_out", F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    judged = toxicity.classify(docs, table(spark, sf_dir, "labels"), train_on=~F.coalesce("held_out", F.lit(False)))
    return judged.select("doc_id", "held_out", "score", "predicted")


@query("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (secret_scan.scan(table(spark, sf_dir, "documents"))
            .select(F.col("id").alias("doc_id"), "start", "end", "kind", F.length("value").alias("length"),
                    F.sha2("value", 256).alias("value_sha256"), "score", "secret"))


@query("op11_merkle_manifest")
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    n_chars = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))

    def leaf(chars):
        return merkle.leaf_digest([F.col("doc_id"), F.col("source"), F.col("lang"), chars, F.col("text")])
    given = docs.withColumn("_seen", F.when(tampered, leaf(n_chars)))
    rows = merkle.manifest(given, leaf(F.col("n_chars")), "lang", "doc_id", keep=["doc_id", "_seen"])
    return (rows.withColumn("folded_root", merkle.fold_to_root(F.coalesce("_seen", "leaf")))
            .select("doc_id", "leaf", "subroot", "root", merkle.proof_digest().alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


@query("op12_source_mix")
def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, cap=2))


@query("op13_lexical_search")
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
