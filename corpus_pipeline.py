"""The corpus pipeline: documents in, a mixed and cleaned corpus out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a runner writes it as Parquet and reads it again as the next stage's ``docs``. All but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm import decontam, langid, line_dedup, mixing, simhash
from tarnlake.llm.common import packed, stage, unpacked

#: Least mean probability of the predicted language. A text without a letter has score 0.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language can be told stay. Rejected: null, no letter, or a score below LEAST_SCORE."""
    marked = langid.identify(packed(docs, "text"), langid.train(docs))
    return unpacked(marked.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).drop("lang_pred", "score"), docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that later copies of three-line windows cover go, and with them documents of which no other line is left. ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(packed(docs, "doc_id", "text"))
    out = out.where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return unpacked(out.drop("n_lines", "n_removed"), docs.columns, n_chars=F.length("text").cast("long"))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest doc_id. Linked are fingerprints within two bits, and texts that share four fifths of their five-word shingles."""
    return simhash.drop_near_duplicates(docs, percent=simhash.SIMILAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    marked = decontam.mark_contamination(packed(docs, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return unpacked(marked.where(~F.col("contaminated")).select("doc_id", "text", "_row"), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its place in the mix, in files that follow it."""
    return mixing.mix_sources(docs).repartitionByRange("mix_index").sortWithinPartitions("mix_index")


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_near),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
]

#: A network trained on the table decides the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
