"""Cleaning of ``documents`` for training: every stage works on all rows the one before kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from standwise.llm import bpe, decontaminate, line_dedup, minhash, toxicity
from standwise.llm.queries import WORD_BPE, table, trusted_labels
from standwise.sources.staging import in_turn


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose restored text scores as toxic."""
    scorer = toxicity.fit(docs, trusted_labels(spark, sf_dir))
    return toxicity.drop_toxic(docs, scorer)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a tenth of their source's distinct texts have;
    only one with no line of its own stays whole."""
    out = line_dedup.dedup_texts(docs, whole_above=1.0, copies_once=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of whose words a twentieth or more stand in benchmark windows."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return bpe.round_trip(docs, WORD_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# The first and last stages cannot be put into SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written as Parquet and read again; what a stage
    leaves behind is removed once the next one stands."""
    steps = [lambda rows, work=work: work(spark, rows, sf_dir) for _, work in STAGES]
    return in_turn(spark, table(spark, sf_dir, "documents"), steps)
