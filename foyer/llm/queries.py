"""One registered query per operator, over its whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foyer.llm import lm, oracle, quality, rules, secrets, whitening
from foyer.llm.common import documents, key_hash, whole_text, words, written
from foyer.llm.decontaminate import leaks
from foyer.llm.jaccard import jaccard_groups
from foyer.llm.manifest import manifest, proof_digest
from foyer.llm.minhash import near_groups
from foyer.llm.mixing import mixed, weights_of
from foyer.llm.repeats import without_repeats
from foyer.llm.sharding import shard_by_ring
from foyer.llm.tokens import token_counts

SHARDS = 40


def op1_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards; counts differ by at most one."""
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(whole_text()) + 16).cast("long").alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32"),
    )
    return shard_by_ring(
        rows, SHARDS, text="text_crc32", tie=[F.col("text_crc32"), F.col("size")]
    ).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_unigram_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of unigram tokens of every whole text."""
    return token_counts(documents(spark, sf_dir).select("doc_id", "text"), keep=["doc_id"])


def op3_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every whole text; two thirds of the rows may give their labels."""
    held_out = (key_hash("doc_id") % 3 == 1).alias("held_out")
    rows = quality.described(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"])
    rows = written(rows.select("doc_id", held_out, *quality.STATISTICS), "op3-statistics")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.fit(rows.where("not held_out").join(labels, "doc_id"), "quality")
    return quality.scores(rows, model, ["doc_id", "held_out"]).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that it holds, whole or nearly so."""
    rows = documents(spark, sf_dir).select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = leaks(rows, items, keep=["doc_id"])
    return found.select(
        "doc_id", (F.size("leaks") > 0).alias("contaminated"), F.col("leaks.item").alias("item_ids"),
        F.col("leaks.edits").alias("edits"),
    )


def op5_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every whole text, and whether the rules keep it."""
    rows = rules.measured(documents(spark, sf_dir).select("doc_id", "text", "lang"))
    rows = written(rows.drop("text", "lang"), "op5-measures")
    return rules.judged(rows, rules.refined(rows)).select(
        "doc_id", *rules.MEASURES, "base_failed", "kept"
    )


def op6_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every whole text; the model learns from six sevenths of the rows."""
    rows = documents(spark, sf_dir).select("doc_id", "text")
    held_out = key_hash("doc_id") % 7 == 2
    text_key = F.xxhash64(whole_text())
    model = lm.train_model(rows.where(~held_out))
    scores = lm.score_texts(rows, model)
    rows = rows.select("doc_id", held_out.alias("held_out"), text_key.alias("text_key"))
    return rows.join(scores, "text_key").select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op7_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that also start elsewhere."""
    rows = without_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda done, span: done + span["end"] - span["start"]
    )
    return rows.select(
        "doc_id",
        F.octet_length(whole_text()).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept_bytes", 256).alias("kept_sha256"),
    )


def op8_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text: the base finds, and weak ones with complements near."""
    rows = documents(spark, sf_dir).select("doc_id", "text")
    rows = secrets.parts(rows.withColumn("text_key", F.md5(whole_text().cast("binary"))))
    rows = written(rows.drop("text"), "op8-parts")
    place = "transform(strong, x -> struct(x.start as start, x.kind_no as kind_no, x.end as end))"
    rows = rows.select("doc_id", "text_key", F.expr(place).alias("base"), "strong", "weak")
    added = secrets.linked(rows, "text_key")
    rows = rows.select("doc_id", "text_key", "base").join(added, "text_key", "left")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind_no"] == secrets.KINDS.index(kind))).cast("long")

    return rows.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in secrets.STRONG),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.when(F.col("added").isNull(), F.col("base")).otherwise(
            F.concat("base", "added")
        )).alias("spans"),
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set and its component by links of 0.75 or more."""
    return jaccard_groups(documents(spark, sf_dir).select("doc_id", "text")).select(
        F.col("key").alias("doc_id"), F.col("n_grams").alias("n_shingles"),
        F.col("group_key").alias("component_id"),
    )


#: Target weights of domains and languages; sources weigh alike. A source's domain goes by its number.
DOMAINS, DOMAIN_WEIGHTS = ["web", "books", "code"], {"web": 5, "books": 3, "code": 2}
LANGUAGE_WEIGHTS = {"en": 4, "de": 3, "fr": 2, "es": 2}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = (3, 4), 2, 7


def with_mix_levels(docs: DataFrame) -> DataFrame:
    """The rows with their domain, a weight per level, and their number of words."""
    number = F.expr("try_cast(regexp_extract(source, '[0-9]+', 0) as int)")
    return docs.withColumns({
        "domain": F.element_at(F.array(*map(F.lit, DOMAINS)), number % len(DOMAINS) + 1),
        "n_tokens": F.size(words(whole_text())).cast("long"),
    }).withColumns({
        "w_domain": weights_of(F.col("domain"), DOMAIN_WEIGHTS),
        "w_lang": weights_of(F.col("lang"), LANGUAGE_WEIGHTS),
        "w_source": F.lit(1).cast("long"),
    })


def op10_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that a mixture of three quarters of all words takes, with their epochs."""
    rows = with_mix_levels(documents(spark, sf_dir).select("doc_id", "text", "lang", "source")).drop("text")
    return mixed(
        written(rows, "op10-rows"), ["domain", "lang", "source"], ["w_domain", "w_lang", "w_source"],
        share=MIX_SHARE, max_epochs=MIX_EPOCHS, seed=MIX_SEED,
    ).select("doc_id", "domain", "lang", "source", "epoch", "n_tokens", "taken", "mix_rank")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, its proof, and whether its text as found leads to the root."""
    rows = documents(spark, sf_dir)
    found = F.when(key_hash("doc_id") % 5 == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return manifest(rows, changed={"text": found}).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest().alias("proof_sha256"),
        "folded_root", "verified",
    )


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set, its component by links of 0.8 or more, and whether it stays."""
    return near_groups(documents(spark, sf_dir).select("doc_id", "text")).select(
        F.col("key").alias("doc_id"), F.col("n_grams").alias("n_shingles"),
        F.col("group_key").alias("component_id"), "kept",
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector along up to 32 exact components, each of unit variance."""
    rows = whitening.usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    model = whitening.fit(rows)
    error = whitening.identity_error(rows, model)
    explained = F.array(*map(F.lit, model.explained)).cast("array<double>")
    return whitening.whitened(rows, model, keep=["vec_id"]).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.expr("try_cast(deviation as long)").alias("deviation"), "whitened",
        F.get(explained, "at").alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


QUERIES = {
    "op1_ring_sharding": op1_ring_sharding,
    "op2_unigram_tokens": op2_unigram_tokens,
    "op3_quality_discriminant": op3_quality_discriminant,
    "op4_benchmark_leaks": op4_benchmark_leaks,
    "op5_divergence_rules": op5_divergence_rules,
    "op6_recurrent_scores": op6_recurrent_scores,
    "op7_repeated_spans": op7_repeated_spans,
    "op8_linked_secrets": op8_linked_secrets,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_source_mixture": op10_source_mixture,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLES: dict[str, str] = oracle.ORACLES
