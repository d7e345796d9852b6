"""Documents to training shards: five stages, each an operator of ``foyer.llm``.

Rules drop junk, the Jaccard join leaves one document of each group of near copies, texts that hold a
benchmark item go, a mixture brings sources nearer to their target weights, and what is left is dealt
to shards. Each stage reads what the one before wrote. All but the last return the columns of the
documents with the values that they had, in any order of rows; nulls, empty texts and repeated rows are as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foyer.llm import rules
from foyer.llm.common import named, written
from foyer.llm.decontaminate import leaks
from foyer.llm.jaccard import one_per_group
from foyer.llm.mixing import mixed
from foyer.llm.queries import SHARDS, with_mix_levels
from foyer.llm.sharding import shard_by_ring

#: The mixture keeps this share of the words, each row once.
MIX_SHARE, MIX_SEED = (4, 5), 11


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """Whole rows in ``row``, beside the columns that a stage works on: it then replaces none of the rows' own."""
    return docs.select(F.struct(*map(named, docs.columns)).alias("row"), *(named(name).alias(name) for name in names))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the divergence rules keep."""
    rows = written(rules.measured(packed(docs, "text", "lang")).drop("text", "lang"), "pipeline-measures")
    reference = rules.refined(rows.drop("row"))
    return rules.judged(rows, reference).where("kept").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents."""
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or nearly so."""
    found = leaks(packed(docs, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["row"])
    return found.where(F.size("leaks") == 0).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the token prefix of each source; a last one is kept whole."""
    rows = with_mix_levels(packed(docs, "doc_id", "lang", "source", "text")).drop("text")
    taken = mixed(
        rows, ["domain", "lang", "source"], ["w_domain", "w_lang", "w_source"],
        share=MIX_SHARE, max_epochs=1, seed=MIX_SEED,
    )
    return taken.select("row.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place there."""
    return shard_by_ring(docs, SHARDS, tie=[F.xxhash64("text")])


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("sharding", sharding),
]

#: No SQL: links are followed to components, edit distances are verified and a ring is walked.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{number}")
    return docs
