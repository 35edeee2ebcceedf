"""From raw documents to training tokens in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read back as the next one's docs. All but the last return the
columns of documents, further ones included. Null texts and ids are kept unless a
stage says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lucrum.llm import bpe, jaccard, mixing, secrets, toxicity
from lucrum.llm.common import stored
from lucrum.llm.queries import fifth, table, vocabulary

ORACLE_SQL = None       # no stage but the third can be expressed in SQL


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic; all, if there is nothing
    to learn from."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", use=fifth() != 0)
    score = _free(docs, "toxicity")
    return toxicity.score(docs, model, score_col=score).where(F.col(score) < 0.5).select(*_columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (runs of five words, similarity
    0.8): that of the smallest id, those without an id last, then by a hash of id
    and text. Documents are told apart by that 64-bit hash, so copies under a
    repeated id or without one go like others; of rows equal in id and text one
    stays. Texts without words are near to nothing."""
    row = _free(docs, "row_key")
    keyed = docs.withColumn(row, F.xxhash64("doc_id", _text_hash()))
    groups = jaccard.similar(keyed, words=5, percent=80, id_col=row).select(F.col(row).alias("own"), F.col("component_id").alias("group")).distinct()
    named = keyed.select(F.col(row).alias("key"), "doc_id").join(groups, F.col("key") == F.col("own"))
    first = named.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))["key"].alias("first")).select("first")
    again = _free(keyed, "again")
    return (keyed.join(first, F.col(row) == F.col("first"), "left_semi")
            .withColumn(again, F.row_number().over(Window.partitionBy(row).orderBy(row)))
            .where(F.col(again) == 1).select(*_columns(docs)))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found replaced by a mask; n_chars is the
    new text's."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*_columns(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in order of training: whole documents, those of sources that weigh
    more up to twice, those beyond their source's target not at all. Rows equal in
    id, source and text count as often as they occur; one of them gives the other
    columns. Only texts that occur again are shuffled to tell such rows apart."""
    key, place, copy, taken = (_free(docs, n) for n in ("mix_key", "mix_place", "mix_copy", "mix_taken"))
    # a struct, because structs with null fields are equal
    allocated = mixing.allocate(docs, split=False, key=_text_hash()).select(
        F.struct("doc_id", "source", F.col("key").alias("hash")).alias(key), F.col("copies.position").alias(taken))
    rows = docs.withColumn(key, F.struct("doc_id", "source", _text_hash().alias("hash")))
    found = stored(spark, allocated.groupBy(key).agg(F.count("*").alias("n"), F.first(taken).alias(taken)), "mix-keys")
    mixed = rows.join(found.where((F.col("n") == 1) & (F.size(taken) > 0)).select(key, taken), key)
    again = found.where("n > 1").select(key)
    if not again.isEmpty():
        one = (rows.join(again, key, "left_semi").withColumn(place, F.row_number().over(Window.partitionBy(key).orderBy(key)))
               .where(F.col(place) == 1).drop(place))
        mixed = mixed.unionByName(one.join(allocated.where(F.size(taken) > 0).join(again, key, "left_semi"), key))
    copies = mixed.select(*_columns(docs), F.explode(taken).alias(copy))
    return copies.orderBy(copy).select(*_columns(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    rows = docs.select("doc_id", "source", "lang", "text", _text_hash().alias("hash"))
    tokens = bpe.encode(rows, vocabulary(), decoded_col="decoded")
    return tokens.select("doc_id", "source", "lang", "n_tokens", "ids", (F.xxhash64("decoded") == F.col("hash")).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each one's result written before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
