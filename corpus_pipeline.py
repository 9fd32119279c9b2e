"""A corpus pipeline: language, quality, near-duplicates, contamination, tokens.

Each stage takes all documents that the one before kept, and all but the last
return the columns of ``documents``. Extra columns pass through every stage;
nulls, empty texts and empty tables have the results that the operators define:
texts without a letter go in the first stage, and with them all null and blank
ones. No SQL can express the fitted and iterative stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate, language, pieces, simhash, weaklabels
from tallyframe.llm.common import table
from tallyframe.session import materialise

#: Below this, no learned language is likelier than not at both levels.
LEAST_SCORE = 0.25
ORACLE_SQL = None


def surviving(docs: DataFrame, judge: Callable[[DataFrame, list[str], str], DataFrame], passed: str) -> DataFrame:
    """The documents that pass, with their own columns, whatever those are called."""
    names = docs.columns
    hidden = [f"__c{k}" for k in range(len(names))]
    judged = judge(docs.toDF(*hidden), hidden, hidden[names.index("text")])
    return judged.filter(passed).select(*[F.col(h).alias(n) for h, n in zip(hidden, names, strict=True)])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from ``lang``; all with letters if nothing can be learned."""
    model = language.fit(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    judge = lambda d, keep, text: language.identify(d, model, keep, text)
    return surviving(docs, judge, f"lang_pred <> '{language.UNKNOWN}' AND score >= {LEAST_SCORE}")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    model = weaklabels.fit(docs)
    return surviving(docs, lambda d, keep, text: weaklabels.judge(d, model, keep, text), "kept")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return simhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage by the operator's rule."""
    benchmark = table(spark, sf_dir, "benchmark")
    return surviving(docs, lambda d, keep, text: decontaminate.find(d, benchmark, keep, text), "NOT contaminated")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Id, tokens and parity of each document."""
    tokens = pieces.encode(docs, pieces.read_model(pieces.MODEL_FILE), keep=["doc_id"], results="tokens")
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "parity")


STAGES = [
    ("language identification", identify_language),
    ("quality classifier", keep_quality),
    ("SimHash near-deduplication", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
