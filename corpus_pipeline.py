"""A training-data pipeline over ``documents``: each stage is written as Parquet and read again by the next one.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of ``documents``. The last adds the sampled segmentations of what is left. Further columns of ``documents`` are kept,
whatever their names; if one is called ``tokens``, that of the segmentations has an underscore before its name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutewise.llm.common import free_name, store, table
from minutewise.llm.containment import without_contaminated
from minutewise.llm.line_spread import remove_spread_lines
from minutewise.llm.near_minhash import near_duplicates
from minutewise.llm.segment import SAMPLES, with_tokens
from minutewise.llm.toxicity import flag_toxic

#: Segmentations of each document, as many as the operator draws.
DRAWS = SAMPLES


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic at the threshold of their language."""
    flagged = flag_toxic(docs, table(spark, sf_dir, "labels"))
    return flagged.where(~F.col(free_name(docs, "_toxic"))).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines; one that was nothing but such lines goes."""
    out = remove_spread_lines(docs)
    n_removed = F.col(free_name(docs, "_n_removed"))
    emptied = (n_removed > 0) & ~F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    return (out.where(~emptied).withColumn("n_chars", F.when(n_removed > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                                           .otherwise(F.col("n_chars"))).select(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    # ids that go grow with the corpus: the same shuffle join at every size
    return docs.join(gone.hint("merge"), docs["doc_id"].cast("long") == gone["_gone"], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``tokens``, sampled segmentations of each."""
    return with_tokens(docs, k=DRAWS)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("segmentation", segmentation)]

#: SQL cannot state the trained classifier nor the sampled segmentations; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
