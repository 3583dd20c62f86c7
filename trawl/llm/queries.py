"""Registered queries of the numbered operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import chat, collocations, decontaminate, jaccard, language, lexical, near_vectors, packing, pitman_yor, quality, sharding, token_files, warc
from trawl.llm.common import fold, table
from trawl.storage import scratch_path

TOKENIZER = "byte_bpe_50k.json"
EXTRA_CONVERSATION = "<|im_end|><|im_start|>assistant ok"
SHARDS = sharding.even_tree(40)


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.link_vectors(table(spark, sf_dir, "embeddings"))


def op2_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql(
        "SELECT -1L AS conv_id, id AS turn, IF(id = 0, 'user', 'assistant') AS role, "
        f"'{EXTRA_CONVERSATION}' AS text FROM range(2)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat.read_back(chat.format_conversations(rows))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arcs = warc.write_arcs(table(spark, sf_dir, "pages"), scratch_path(spark, "arc"))
    warcs = warc.convert(arcs, scratch_path(spark, "warc"))
    records = warc.resolve_revisits(warc.read_warcs(warcs, payloads=False))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = language.fit(docs.where(fold("doc_id", 4) != 2))
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    return language.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), network).drop("text")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    shards = token_files.write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    back = token_files.read_token_files(spark, folder, shards)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    field = quality.fit(docs, labels)
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    scored = quality.score(docs.select("doc_id", held_out.alias("held_out"), "text"), field).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.fit_and_score(table(spark, sf_dir, "documents"), fold("doc_id", 5) != 1)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "shards")
    schema = sharding.write_shards(table(spark, sf_dir, "documents"), folder, SHARDS)
    back = sharding.read_shards(spark, folder, schema)
    return back.select(
        "doc_id", sharding.size_of(F.col("text")).alias("size"), sharding.checksum_of(F.col("text")).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot", sharding.place(F.col("doc_id"), sharding.grown(SHARDS)).alias("grown_shard"),
    )


QUERIES = {
    "op1_near_vectors": op1_near_vectors,
    "op2_chat_round_trip": op2_chat_round_trip,
    "op3_packing": op3_packing,
    "op4_warc": op4_warc,
    "op5_language": op5_language,
    "op6_jaccard": op6_jaccard,
    "op7_token_files": op7_token_files,
    "op8_quality": op8_quality,
    "op9_decontaminate": op9_decontaminate,
    "op10_pitman_yor": op10_pitman_yor,
    "op11_collocations": op11_collocations,
    "op12_lexical": op12_lexical,
    "op13_sharding": op13_sharding,
}
