"""From raw documents to piece ids: five stages, each written and read again.

Each stage works on all rows its predecessor kept, and all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamwin.llm import mixing, near_duplicates, pieces, quality_cnn, substrings
from streamwin.llm.queries import documents, table, vocabulary
from streamwin.llm.text import importable, partitions, stored


def _with_text(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, with the length that follows from the text."""
    if "n_chars" in like.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return docs.select(*like.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out the documents that the network predicts to be bad.

    Null and empty texts are scored as empty, rows that repeat an id each for
    itself. Without labels of both classes all stay.
    """
    importable(spark)
    network = quality_cnn.learn(docs, table(spark, sf_dir, "labels"))
    return quality_cnn.keep_good(docs, network, threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave one document of each group of near-duplicates, that with the least id.

    Texts without words are linked with nothing and stay. Rows that repeat an
    id are one document: they stay or go together, null ids too.
    """
    importable(spark)
    kept = near_duplicates.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out passages that an earlier document has; a text of nothing else goes.

    Null and empty texts stay as empty ones. Earlier is a smaller id, so rows
    that repeat an id leave each other alone.
    """
    importable(spark)
    keep = tuple(name for name in docs.columns if name not in ("doc_id", "text"))
    left = substrings.remove_repeats(docs, keep=keep, tidy=False)
    left = left.where("n_removed = 0 or n_removed < n_words").drop("n_words", "n_removed")
    return _with_text(left.select("doc_id", "text", "kept.*") if keep else left, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source's documents, some twice, up to its target share of words.

    A null or empty text has no words and is never taken. Rows travel whole, so
    that columns named as those of the mix stay what they are.
    """
    importable(spark)
    whole = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), "doc_id", "text", "source")
    taken = mixing.repeated(mixing.mix(whole)).select("row.*", F.col("text").alias("text taken"))
    return _with_text(taken.drop("text").withColumnRenamed("text taken", "text"), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and the text they decode to.

    Blocks are three times finer than by default: a stage before may have left
    each document's text in few files, and a task holds a block whole.
    """
    importable(spark)
    model = vocabulary("piece_bpe_32k.model")
    keep = tuple(name for name in ("lang", "source") if name in docs.columns)
    encoded = pieces.decode(pieces.encode(docs, model, keep=keep, blocks=3 * partitions(spark)), model)
    columns = [F.col("doc_id"), *(F.col(f"kept.{name}") for name in keep)]
    return encoded.select(*columns, F.col("decoded").alias("text"), F.size("ids").alias("n_pieces"), "ids")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix", mix),
    ("encode", encode),
]

# A trained network decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
