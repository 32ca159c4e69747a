"""A corpus from raw documents to packed sequences, in five stages.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read again as the next one's
documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordscope.llm.common import durable
from recordscope.llm.minhash import drop_near_copies
from recordscope.llm.mixing import mixed_rows
from recordscope.llm.packing import pack_along_curve
from recordscope.llm.quality import drop_rejected
from recordscope.llm.secrets import mask_secrets
from recordscope.sources.io import owned

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base limits and the learned rules keep.

    Null, empty and short texts fail the base. Every row is judged by its own text, whatever its id: repeated and null ids are
    kept or dropped row by row. An empty table gives none; columns beside those of ``documents`` are left out.
    """
    return drop_rejected(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component: that of the smallest id, null ids last.

    Rows are told apart by place: of repeated rows one stays, rows that share an id but not a text both stay, and rows with a
    null id take part like others. Rows without words (null and empty texts) are linked with nothing and all stay. An empty
    table gives none; other columns are left out.
    """
    return drop_near_copies(docs.select(COLUMNS))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, live secrets masked and ``n_chars`` counted anew there; copied examples stay.

    Each row is masked by its own spans, so null and repeated ids are as safe as others. Null texts stay null. An empty table
    gives none; other columns are left out.
    """
    return mask_secrets(docs.select(COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it.

    A null source is a source of its own. Null ids and repeated rows are taken row by row; rows without words count 0 words but
    are repeated at their source's rate. An empty table gives none; other columns are left out.
    """
    return mixed_rows(docs.select(COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids.

    A row without text is its end id alone. Repeated rows are packed as often as they come, null ids stay null. An empty table
    gives none; other columns are ignored.
    """
    return pack_along_curve(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near-dedup", dedup_stage),
    ("secret scans", secrets_stage),
    ("source mix", mixing_stage),
    ("packing", packing_stage),
]

#: The stages learn rules, hash shingles and tokenise, which SQL cannot express; tests hold them against a brute-force version.
ORACLE_SQL = None


@owned
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the tables between them go when the last one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
