"""The corpus pipeline: documents go through the stages one after another, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import queries, toxicity
from tidemark.llm.common import Scratch, cleared
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.mixing import mix
from tidemark.llm.packing import pack

#: From this chance of toxicity on, a document goes.
TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely toxic go; null and empty texts stay.

    Each row is judged by its text, so rows that share an id or a text are judged alike, and a null id changes
    nothing. Without labels of both kinds all stay. Empty table: empty.
    """
    model = toxicity.fit(docs, queries.read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("score") < TOXIC_FROM).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; every document stays, a null text as an empty one, and n_chars counts what is left.

    Rows that share an id count as one document; null ids together as one that comes last. Empty table: empty.
    """
    out = line_dedup(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the smallest id stays; rows with a null id stay, and so do all rows of an id that stays."""
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All sources alike in their numbers of documents; a document has a row for each of its copies, maybe none.

    A null source is a source of its own, named by the empty text. Rows that share an id are copied alike, as the
    number comes from a hash of the id; so are rows with a null id. Empty table: empty.
    """
    return mix(docs).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece, with its place in a sequence; each copy of a document is packed.

    Null and empty texts are the end id alone. Rows that share an id, or have none, are packed each for itself; which
    of equally long pieces goes where follows ids and contents. Empty table: empty.
    """
    return pack(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Toxicity, shingle similarity on deduplicated lines and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.read(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        with cleared(spark):
            after = scratch.save(stage(spark, docs, sf_dir))
        scratch.drop(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
