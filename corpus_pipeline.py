"""A pipeline over ``documents``: toxic texts go, one of each group of near-duplicates stays, texts that
contain benchmark passages go, personal data are replaced, and the rest is encoded.

Each stage is a function of (spark, docs, sf_dir); ``run`` writes what a stage returns to the shared
folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heronry.llm import bpe, decontaminate, pseudonyms, simhash, toxicity
from heronry.llm.queries import pseudonym_key, table, tokenizer, toxicity_model
from heronry.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose text scores below 0.5 under a model of ``labels.toxic``, learned from the labelled rows
    outside fold 0 of 5. Null and empty texts have the score of a text without words; repeated rows have one
    score; no rows give no rows. All columns are kept."""
    return toxicity.drop_toxic(docs, toxicity_model(spark, docs, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of texts that are linked by SimHash fingerprints of 4-word
    shingles, at 4 differing bits or fewer. Null and empty texts are one group; of repeated rows one stays;
    rows without an id come after all others; no rows give no rows. All columns are kept."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose text holds no window of ten words of a benchmark item (of a shorter item, all its words).
    Null and empty texts stay, repeated rows are judged alike, no rows give no rows. All columns are kept."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with pseudonyms for the personal data in their text. Null and empty texts stay as they are,
    equal values get equal pseudonyms in all rows, no rows give no rows. All columns are kept."""
    return pseudonyms.pseudonymised(docs, pseudonym_key(spark))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip) of each document that is left; null texts
    count as empty and have no tokens, repeated rows are each encoded, no rows give no rows."""
    return bpe.round_trip_digests(docs, tokenizer(spark))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", replace_personal_data),
    ("encoding", encode),
]

# The classifier, the tokenizer and the keyed permutations have no SQL form; the tests compare the stages
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
