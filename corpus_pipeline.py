"""A corpus pipeline: language, quality, near copies, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again before the next stage starts, so a stage may drop
the scratch tables of those before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import common, stages

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(work: Callable[[DataFrame], DataFrame]) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.release_stages(spark)
        with common.stage_scratch():
            return work(docs)

    run_stage.__name__, run_stage.__doc__ = work.__name__, work.__doc__
    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("language_id", _stage(stages.identify_language)),
    ("quality_rules", _stage(stages.apply_quality)),
    ("near_dedup", _stage(stages.drop_near_copies)),
    ("mixing", _stage(stages.mix_to_targets)),
    ("packing", _stage(stages.pack_sequences)),
]

#: Language identification is learned, so SQL can't give the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    common.release_stages(spark)
    return docs
