"""Corpus pipeline over ``documents``: quality rules, quality classifier,
near-duplicate join, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``; the last returns the packed pieces. Texts without
words that dedup leaves behind stay as empty documents. A verdict depends on a
row's text and language alone, so it holds for every row that has these, with
any doc_id or none. Dedup takes different texts that share a doc_id, and texts
without one, as documents of their own, which come after all others. Columns of
the table may have any names but ``__shared`` and ``__first``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockroom.llm import chosen_path, packing, quality_fm, quality_rules, substring_dedup
from stockroom.session import ensure_checkpoint_dir, scratch_path


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name += "_"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the digest of text and language, and that column's name."""
    key = _free(docs, "row_key__")
    lang, text = (F.coalesce(F.col(c), F.lit("")) for c in ("lang", "text"))
    return docs.withColumn(key, F.unhex(F.md5(F.concat(F.length(lang).cast("string"), F.lit(":"), lang, text)))), key


def _only(docs: DataFrame, key: str, rows: DataFrame, columns: list[str]) -> DataFrame:
    ensure_checkpoint_dir(docs.sparkSession)
    # Written first: the join then deals the keys out by itself, and Spark can
    # split the copies of one text among tasks.
    kept = rows.select(key).distinct().checkpoint()
    return docs.join(kept, key, "left_semi").select(columns)


def _own_ids(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with an own doc_id for each text, and the name of the column that
    keeps the given one: the given id, or, for texts without one and for further
    texts with the same one, a hash above all ids in use."""
    given = _free(docs, "given__")
    docs = docs.withColumn(given, F.col("doc_id"))
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    own = F.lit(1 << 62) + F.pmod(F.xxhash64(given, text), F.lit(1 << 62))
    shared = (docs.where("doc_id is not null").select("doc_id", text.alias("t")).groupBy("doc_id")
              .agg(F.min("t").alias("first"), F.max("t").alias("last")).where("first < last")
              .select(F.col("doc_id").alias("__shared"), F.col("first").alias("__first")).checkpoint())
    further = F.col("doc_id").isNull()
    if not shared.isEmpty():
        docs = docs.join(shared, F.col("doc_id") == F.col("__shared"), "left")
        further = further | (text != F.col("__first"))
    return docs.withColumn("doc_id", F.when(further, own).otherwise(F.col("doc_id"))).drop("__shared", "__first"), given


def _given_ids(docs: DataFrame, given: str, columns: list[str]) -> DataFrame:
    return docs.select(*(F.col(given).alias(c) if c == "doc_id" else F.col(c) for c in columns))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    keyed, key = _keyed(docs)
    verdicts = quality_rules.score_documents(spark, keyed, _labels(spark, sf_dir), (key,))
    return _only(keyed, key, verdicts.where("kept"), docs.columns)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    keyed, key = _keyed(docs)
    scores = quality_fm.classify(keyed, _labels(spark, sf_dir), (key,))
    return _only(keyed, key, scores.where("predicted = 1"), docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of near duplicates."""
    ensure_checkpoint_dir(spark)
    own, given = _own_ids(docs)
    classes = chosen_path.near_duplicates(spark, own)
    kept = own.dropDuplicates(["doc_id"]).join(classes.where("doc_id = class_id").select("doc_id"), "doc_id", "left_semi")
    return _given_ids(kept, given, docs.columns)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the word windows that a smaller document has."""
    ensure_checkpoint_dir(spark)
    own, given = _own_ids(docs)
    rest = _given_ids(substring_dedup.kept_documents(own), given, docs.columns)
    return rest.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences."""
    import public_tokenizers
    return packing.pack_documents(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substring_dedup", substring_dedup_stage),
    ("packing", packing_stage),
]

#: The classifier's training and the join's paths cannot be put into SQL; tests
#: hold the last three stages against brute force, and the first two against the
#: verdicts of their operators, which have brute force tests of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
