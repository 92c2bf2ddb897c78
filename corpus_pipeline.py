"""A corpus pipeline over ``documents``: one operator per stage, each stage's rows written and reread.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a frame. All but the
last return the columns of ``docs``, whatever they are called; every stage looks at all rows that
the one before kept.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featward.llm.bpe import encode_bpe
from featward.llm.decontaminate import match_benchmark
from featward.llm.jaccard import BROADCAST_IDS, jaccard_components
from featward.llm.langid import fit_languages, identify_languages
from featward.llm.queries import tokenizer, toxic_from
from featward.llm.toxicity import fit_severity, predict_severity
from featward.llm.workers import BATCH, prepare
from featward.session import new_scratch

MOST_UNKNOWN = 0.5  # share of a text that may be in none of the languages
BATCH_BYTES = 2 << 20  # of an Arrow batch: stages share workers and heap with those before them
MEMO_ENTRIES = 50_000  # pre-tokens a worker remembers: small, beside what earlier stages left it with
ROW = "__row"
KEY = "__key"  # a number of its own for every row


def _prepared(stage):
    """The stage in a session that is ready for the operators."""

    @wraps(stage)
    def prepared(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")
        return stage(spark, docs, sf_dir)

    return prepared


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def _beside(docs: DataFrame) -> DataFrame:
    """The row as one struct, whose columns no operator can clash with, and the text beside it."""
    return docs.select(F.struct(*_columns(docs)).alias(ROW), docs["text"])


def _kept(found: DataFrame, condition: Column | str) -> DataFrame:
    return found.filter(condition).select(f"{ROW}.*")


@_prepared
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model of the labelled ones. NULL and empty texts stay."""
    model = fit_severity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _kept(predict_severity(_beside(docs), model), F.col("p_toxic") < toxic_from(model))


@_prepared
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one or more of the languages that the documents name, however mixed. NULL and empty
    texts, texts without a letter, and texts mostly in another language or in none go."""
    found = identify_languages(_beside(docs), fit_languages(docs), unknown_col="unknown")
    return _kept(found, (F.col("lang_pred") != "und") & (F.col("unknown") <= MOST_UNKNOWN))


@_prepared
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id.

    Every row is judged by its own text, whatever other rows share its doc_id; of several rows of the smallest
    doc_id one stays. Rows with a NULL doc_id, and rows without words, stay.
    """
    path = new_scratch(spark, "numbered")
    _beside(docs).withColumn(KEY, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    own = F.when(F.col(f"{ROW}.doc_id").isNotNull(), F.col(KEY)).alias(KEY)
    path = new_scratch(spark, "duplicates")
    joined = jaccard_components(rows.select(own, "text"), id_col=KEY)
    joined.filter(F.col(KEY) != F.col("component_id")).select(KEY, "component_id").write.parquet(path)
    linked = spark.read.parquet(path)
    heads = linked.select(F.col("component_id").alias(KEY), "component_id").distinct()
    ids = rows.select(KEY, F.col(f"{ROW}.doc_id").alias("doc_id"))
    members = linked.unionByName(heads).join(ids, KEY)
    first = members.groupBy("component_id").agg(F.min(F.struct("doc_id", KEY))[KEY].alias(KEY)).select(KEY)
    path = new_scratch(spark, "others")
    members.select(KEY).join(first, KEY, "left_anti").write.parquet(path)
    others = spark.read.parquet(path)
    few = others.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(others) if few else others, KEY, "left_anti").select(f"{ROW}.*")


@_prepared
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _kept(match_benchmark(_beside(docs), items, into="found"), F.size("found") == 0)


@_prepared
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers), and ``exact``:
    do the ids decode to the very text?"""
    ranks, pattern = tokenizer()
    texts = docs.select("doc_id", "lang", "source", "text")
    return encode_bpe(texts, ranks, pattern, decoded_col="decoded", memo_entries=MEMO_ENTRIES).select(
        "doc_id",
        "lang",
        "source",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("exact"),
    )


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

ORACLE_SQL = None  # fitted models and byte-pair merges: tests/llm holds the rows against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
