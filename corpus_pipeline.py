"""From raw documents to packed training sequences: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before has kept; run()
writes each stage's rows as Parquet in the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import decontam, packing, pii, quality, setsketch
from tessera.llm.common import fold, table, written
from tessera.llm.queries import QUALITY_CUT

#: The classifier and the field are trained models, which SQL cannot express.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return quality.scored(docs, model).filter(F.col("score") >= QUALITY_CUT).select("row.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one of the smallest id; of repeated rows one."""
    found = written(setsketch.near_duplicates(docs).select("doc_id", "kept"), "kept")
    kept = docs.join(found.filter("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    again = found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(kept.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"]))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return pii.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmarks),
    ("personal_data", without_personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
