"""A corpus pipeline: language ID, near-dedup, decontamination, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of `documents`. Null ids, null texts and repeated rows are rows
like any other; an empty table stays empty.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowatlas.llm import bpe, decontaminate, language, pii, simhash
from flowatlas.llm.common import cut_lineage, free_name, read
from flowatlas.llm.queries import RANKS, TOKENIZER

#: Below this share of its words no language holds a text. Mixed texts of two languages stay.
LEAST_SHARE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter (null ones too) and those that no language holds."""
    model = language.train(docs, learn_from=language.learnable())
    into = free_name(docs, "_language")
    found = language.identify(docs, model, into=into)
    kept = (F.col(into)["lang_pred"] != "und") & (F.col(into)["score"] >= LEAST_SHARE)
    return found.filter(kept).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of linked fingerprints."""
    return simhash.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with one word in twenty or more under a benchmark window."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; n_chars follows the new text."""
    into = free_name(docs, "_pii")
    found = pii.find_personal_data(docs, pii.train(docs), into=into)
    changed = F.size(F.col(into)["spans"]) > 0
    text = F.col(into)["redacted"]
    new = {"text": text, "n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))}
    return found.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with whether decoding gives the text back."""
    encoded = bpe.encode(docs.select("doc_id", "text"), TOKENIZER, RANKS)
    decoded = bpe.decode(encoded, TOKENIZER)
    exact = F.col("decoded") == F.coalesce("text", F.lit(""))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", exact.alias("exact"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("tokens", tokenize),
]

#: The language model, the field and the fingerprints have no SQL; tests/llm compares by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
