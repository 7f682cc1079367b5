"""One query per operator over the test tables, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import chat, decontaminate, fertility, langid, line_dedup, oracles, pieces, prefix_trie, ranked_search, rule_ensemble, secrets, simhash, token_counts, url_templates
from basketry.llm.common import crc_bucket, table
from basketry.session import ensure_checkpoint_dir

URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def quality_vocabularies() -> list[str]:
    """The vocabularies of the quality rules: pieces with byte fallback, and byte pairs for many languages."""
    return [tokenizer_path(), tokenizer_path("byte_bpe_multi_50k.tiktoken")]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents; a cache of its own, so that every run does the whole work."""
    cache = f"{ensure_checkpoint_dir(spark)}/token-cache-{uuid.uuid4().hex}"
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), cache)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids and decoded texts of all documents, as digests."""
    return pieces.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics, tokeniser fertility and the verdict on all documents."""
    return fertility.quality_rules(table(spark, sf_dir, "documents"), quality_vocabularies())


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; learnt from labelled rows whose crc32 modulo 5 is not 0."""
    scored = rule_ensemble.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train_if=crc_bucket("doc_id", 5) != 0
    )
    held_out = F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents; learnt from those whose crc32 modulo 4 is not 2."""
    found = langid.identify(table(spark, sf_dir, "documents"), train_if=crc_bucket("doc_id", 4) != 2)
    held_out = F.coalesce(crc_bucket("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cost", "rejected")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without exact and near copies of earlier lines; the text as a digest."""
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "lines.n_lines",
        "lines.n_exact",
        "lines.n_near",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents."""
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_items(docs, items)
    return found.select(
        "doc_id",
        decontaminate.contaminated().alias("contaminated"),
        F.size("matches").cast("long").alias("n_items"),
        F.col("matches.item").alias("item_ids"),
        F.array_min(F.col("matches.distance")).alias("least_distance"),
    )


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    back = chat.read_back(chat.format_windows(turns.unionByName(extra)))
    return back.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("turns_blob").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_blob").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_blob").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page url."""
    return url_templates.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each rebuilt from the first turns of conversation c - c % 5."""
    numbered = prefix_trie.number_turns(prefix_trie.turn_digests(table(spark, sf_dir, "conversations")))
    conv = F.col("conv")
    return prefix_trie.build(*prefix_trie.fork(numbered, head=crc_bucket("conv", 9), base=conv - conv % 5))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secrets")
    count = lambda kind: F.size(secrets.of_kinds(spans, (kind,))).cast("long").alias(f"n_{kind}")
    base = secrets.spans_text(secrets.of_kinds(spans, secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(k) for k in secrets.BASE_KINDS],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(spans).alias("spans"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: f for k, f in globals().items() if k.startswith("op") and k[2:].split("_")[0].isdigit()}
    return found


def oracle_sql() -> dict[str, str]:
    """The other queries tokenise, hash or match edits, which SQL cannot; tests hold them against brute force."""
    return {"op8_chat_windows": oracles.CHAT, "op10_url_filter": oracles.url_sql(URL_RULES), "op11_prefix_trie": oracles.TRIE, "op12_secret_scan": oracles.secrets_sql(), "op13_ranked_search": oracles.SEARCH}
