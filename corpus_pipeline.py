"""Cleaning and mixing a corpus: each stage works on all that the one before kept.

Counted as part of the corpus subpackage. A stage takes (spark, docs, sf_dir) and gives a
DataFrame that is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patina.llm import decontaminate, linededup, minhash, mixing, toxicity
from patina.llm.queries import learning_fold, read
from patina.llm.shared import broadcast_below, free_name, stored
from patina.session import configure

BROADCAST_IDS = 1_000_000


def set_aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with those columns renamed that an operator's own ``names`` would replace, and how to get all back."""
    taken = {n.lower() for n in names}
    other = {c: free_name(docs, f"kept_{c}") for c in docs.columns if c.lower() in taken}
    back = [F.col(other.get(c, c)).alias(c) for c in docs.columns]
    return docs.withColumnsRenamed(other), back


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the model never sees the held-out fold.

    Null and empty texts have the score of a text without any feature; repeated rows all
    stay or all go. Columns of ``docs`` stay as they are, whatever their names; an empty
    table gives no rows.
    """
    configure(spark)
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learn_from=learning_fold)
    rows, back = set_aside(docs, toxicity.RESULT)
    return toxicity.score(rows, model).where(F.col("predicted") == 0).select(*back)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines on more than a tenth of their source's documents.

    ``n_chars`` follows the text. Null texts stay null, a null source is a source of its
    own, and repeated rows are documents of their own. Other columns stay as they are,
    whatever their names; an empty table gives no rows.
    """
    configure(spark)
    rows, back = set_aside(docs, linededup.RESULT)
    cleaned = linededup.drop_boilerplate(rows)
    length = F.coalesce(F.length("text"), F.lit(0)).cast("bigint")
    changed = F.when(F.col("n_dropped") > 0, length).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", changed).select(*back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the least doc_id.

    Only the ids to drop are joined to the texts. Where rows share a doc_id the least row
    stays; rows without a doc_id all stay.
    """
    configure(spark)
    found = stored(minhash.near_duplicates(docs.select("doc_id", "text")).select("doc_id", "kept"))
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    left = docs.join(broadcast_below(gone, BROADCAST_IDS), "doc_id", "left_anti").select(*docs.columns)
    again = found.where(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("doc_id").count()
    again = stored(again.where(F.col("count") > 1).select("doc_id"))
    if not again.limit(1).count():
        return left
    again = broadcast_below(again, BROADCAST_IDS)
    once = left.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(once.select("row.*"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten consecutive words of a benchmark item occurs.

    Null and empty texts hold none and stay, repeated rows too. Columns of ``docs`` stay as
    they are, whatever their names; an empty table or benchmark gives all rows back.
    """
    configure(spark)
    rows, back = set_aside(docs, decontaminate.RESULT)
    found = decontaminate.find_passages(rows, read(spark, sf_dir, "benchmark"))
    return found.where(F.col("n_hit") == 0).select(*back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training order of all copies the mix takes: the columns of documents, epoch, position.

    Texts without words have no copies; repeated rows are documents of their own. Columns
    named as those that mixing adds (size, source_size, target, taken, positions, epoch,
    position) are replaced. An empty table gives no rows.
    """
    configure(spark)
    return mixing.training_order(mixing.mix(docs))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("minhash", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("mix", mix_sources),
]

# A trained model decides in the first stage, so no SQL gives these rows.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stored before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
