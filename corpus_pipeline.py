"""A training corpus from raw documents, in stages that are written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobweave.llm import dac, decontaminate, mixing, quality, simhash
from jobweave.llm.common import prepare, shared_folder, table
from jobweave.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    The classifier learns from the labelled rows that ``docs`` still has, held-out ones
    excepted; without any, each document scores 0.5 and stays.  Null and empty texts are scored
    like any other; repeated rows share a fate.
    """
    machine = quality.fit(docs, table(prepare(spark), sf_dir, "labels"))
    return quality.keep_good(docs, machine)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays, the one with the smallest id.

    Texts without words are one component; of rows without ids see ``simhash.one_of_each``.
    """
    prepare(spark)
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up a twentieth or more go."""
    return decontaminate.remove_documents(docs, table(prepare(spark), sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Domains, languages and sources in their target weights; a document may come several times."""
    prepare(spark)
    return mixing.mix(docs)


def write_token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture as a token file, and what the file says of each document."""
    path = shared_folder(prepare(spark), "corpus-tokens")
    dac.write_tokens(docs, path, tokenizer_path())
    return dac.read_documents(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", drop_low_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID binary output", write_token_file),
]

#: The first, second and last stage are not for SQL; tests/llm holds them against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder."""
    docs = table(prepare(spark), sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return out
        path = shared_folder(spark, f"stage-{i + 1}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs


PIPELINE_QUERY = {"pipeline": run}
PIPELINE_SQL: dict[str, str] = {}
