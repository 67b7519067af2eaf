"""From raw documents to coded training tokens: five stages, each a table for the next.

Languages first, so that unreadable texts cost nothing further; near duplicates before contamination
and mixing, so that each text is judged once and sizes are those of what remains; tokens last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import cube, decontaminate, jaccard_join, langid, token_files
from millrace.llm.queries import END, tokenizer
from millrace.llm.workspace import written


OWN = ("doc_id", "text", "lang", "source")


def _beside_others(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with all columns beyond ``OWN`` packed into one, so that none can clash with an operator's own."""

    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in OWN]
        packed = docs.select(*OWN, F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("other_columns"))
        kept = work(spark, packed, sf_dir)
        return kept.select(*[F.col("other_columns")[f"c{others.index(c)}"].alias(c) if c in others else F.col(c) for c in docs.columns])

    stage.__name__, stage.__doc__ = work.__name__, work.__doc__
    return stage


@_beside_others
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the models know; what they reject goes.

    Null and empty texts, and those without a letter, are rejected. Repeated rows and rows without id are judged like
    any; long texts are read whole. An empty table, or one without labelled documents, leaves no rows.
    """
    models = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.identify(docs, models).where(~F.col("rejected")).select(*docs.columns)


@_beside_others
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones: the least id, null last; of rows alike one.

    Texts without words, null ones included, are like no other and all stay. Long texts are compared whole. An empty
    table leaves no rows.
    """
    return jaccard_join.one_of_each(docs)


@_beside_others
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without too many words of the benchmark.

    Texts without words are clean and stay; repeated rows and rows without id are judged like any; long texts are
    read whole. With an empty benchmark all stay; an empty table leaves no rows.
    """
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_beside_others
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Null and empty texts have size 0 and are drawn too; a null source is one of its own; rows alike are drawn one by
    one. An empty table leaves no rows.
    """
    mix = cube.mixed(docs).where(F.col("copies") > 0)
    times = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mix.select(*docs.columns, times.alias("time_taken")).drop("time_taken")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files; per document its place and checksum, as read back.

    A null text is an empty one: its end id only. Documents come by id, null first, those of one id by text. Long texts are
    coded whole. An empty table gives no rows. Columns other than doc_id and text are ignored.
    """
    return token_files.token_digests(docs, tokenizer(), END)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: Fitted models, drawn mixes and coded tokens have no SQL; tests compare the run with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
