"""The thirteen operators as queries over the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, decontaminate, lm, manifest, minhash, mixing, packing, phrases, quality, sharding, simhash, toxicity, warc
from .common import crc, shared_dir, stored

#: What conversation -1 says, twice (fixed value).
CONTROL_TURN = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(of: int):
    """crc32 of the id as text, mod `of`; a null id leaves none."""
    return F.coalesce(F.pmod(crc(F.col("doc_id")), F.lit(of)), F.lit(-1))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    pair = spark.createDataFrame([(-1, CONTROL_TURN, CONTROL_TURN)], "conv_id long, prompt string, completion string")
    turns = chat.to_turns(conversations).unionByName(chat.to_turns(pair))
    formatted = chat.format_turns(turns).select("conv_id", "turn", "formatted", "loss_start", "loss_length")
    return chat.digest_conversations(chat.read_back(formatted))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    learnt = F.pmod(crc(F.col("_id")), F.lit(3)) != 1
    model = quality.fit_on_sample(docs, labels, "quality", learnt)
    rows = docs.select("doc_id", (_remainder(3) == 1).alias("held_out"), "text")
    return quality.score_texts(rows, model).select("doc_id", "held_out", "score", "predicted")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.train_and_score(_table(spark, sf_dir, "documents"), _remainder(7) == 2)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.place(docs, shards=40).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
    )
    placed = stored(placed, shared_dir(spark), "placed")
    slotted = sharding.with_slots(placed, "shard", ("doc_id", "text_crc32"))
    return slotted.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    rows = mixed.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    learnt = F.pmod(crc(F.col("_id")), F.lit(5)) != 0
    return toxicity.classify(docs, labels, "toxic", learnt, _remainder(5) == 0)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=2, threshold=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.find_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.with_near(simhash.with_edits(_table(spark, sf_dir, "documents")))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), capacity=1024, carry=("ids_crc32",))
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"), least=30, order=4, most=2000, percent=80)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth document's text is changed after its proof was made."""
    docs = _table(spark, sf_dir, "documents")
    changed = [manifest.lowered() if c == "text" else F.col(c) for c in manifest.FIELDS]
    now = F.when(_remainder(5) == 0, manifest.leaf(changed)).otherwise(manifest.leaf([F.col(c) for c in manifest.FIELDS]))
    proved = manifest.proofs(docs, carry={"now": now})
    proved = proved.withColumn("folded_root", manifest.folded(F.col("now"), F.col("segment")))
    return proved.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        manifest.proof_digest(F.col("segment")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_chat_format,
        op2_quality,
        op3_language_model,
        op4_sharding,
        op5_mixing,
        op6_toxicity,
        op7_minhash,
        op8_decontamination,
        op9_warc,
        op10_simhash,
        op11_packing,
        op12_phrases,
        op13_manifest,
    )
    return {f.__name__: f for f in found}
