"""From raw documents to packed training sequences: toxicity, quality rules, near duplicates, repeated passages, packing.

Each stage takes all rows its predecessor kept and returns the columns of ``documents``; the last returns the packed pieces. Near
duplicates are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, directly or through others; the one with the smallest
doc_id stays, null ids last, and of equal ids the one with the smallest hash of its text. Null and empty texts are no toxicity, fail the quality rules
and so leave there. Other columns, whatever their names, are carried along unchanged, except ``n_chars``, which follows the text when passages are cut. Empty tables stay
empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import jaccard_join, quality_rules, suffix_dedup, toxicity
from orderloom.llm.catalog import packed_documents
from orderloom.llm.common import cut_lineage, read_table


#: What the operators read; all else travels beside it in one column, so that no name of the input meets a name of theirs.
READ = ("doc_id", "text", "lang", "source")
CARRIED = "carried"


def _apart(docs: DataFrame) -> DataFrame:
    """The columns the operators read, and all columns but the text as one."""
    beside = [F.col(f"`{c}`").alias(c) for c in docs.columns if c != "text"]
    return docs.select(*[c for c in READ if c in docs.columns], F.struct(*beside).alias(CARRIED))


def _whole(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, those of ``changed`` with the values given."""
    own = {c: F.col("text") if c == "text" else F.col(CARRIED).getField(c) for c in docs.columns}
    return rows.select(*[(own | changed)[c].alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of rows that are not held out; rows of a score of 0.5 or more go."""
    labels = read_table(spark, sf_dir, "labels").where(~toxicity.held_out()).select("doc_id", "toxic")
    rows = _apart(docs)
    return _whole(toxicity.score(rows, toxicity.fit(rows, labels), into="toxicity").where("toxicity < 0.5"), docs)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules or the fences of their language and source reject go."""
    return _whole(quality_rules.quality_rules(_apart(docs)).where("kept"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest id stays, once if its row is repeated; of different texts with that id, one."""
    rows = _apart(docs)
    first = jaccard_join.jaccard_firsts(rows, words=5, percent=80).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & jaccard_join.text_hash().eqNullSafe(F.col("_hash"))
    return _whole(rows.join(first, same, "left_semi").dropDuplicates(["doc_id", "text"]), docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a 200-byte string that occurs more than once go from the texts; rows stay."""
    found = suffix_dedup.suffix_dedup(_apart(docs), as_text=True)
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col("kept"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long"))
    changed = {"n_chars": F.coalesce(n_chars, F.col(CARRIED).getField("n_chars"))} if "n_chars" in docs.columns else {}
    return _whole(found, docs, text=text, **changed)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_documents(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("jaccard_join", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("best_fit_packing", pack_sequences),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
