"""A bounded, repeatable sample of labelled texts to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featward.session import new_scratch

SAMPLE_ROWS = 20_000  # labelled rows a classifier is fitted on, at most; half of each class


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = SAMPLE_ROWS,
) -> DataFrame:
    """``id``, ``text``, ``label`` (0 or 1) and ``weight`` of at most ``limit`` labelled documents.

    Up to half of ``limit`` rows of each class are taken by a hash of the id, whatever the size of
    the tables; ``weight`` is how many rows of its class a row stands for. Only the sampled ids are
    broadcast, so the texts are read once and not shuffled. The rows are written to the shared
    scratch folder. Labels other than 0 and 1, NULL ids and ids labelled both ways are left out. Where documents
    share an id, one text, the same each time, stands for them all, and their number raises its weight.
    """
    spark = docs.sparkSession
    clean = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .drop("other")
    )
    sizes = {r["label"]: r["count"] for r in clean.groupBy("label").count().collect()}
    want = limit // 2
    place = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30))
    picked, weight = F.lit(False), F.lit(1.0)
    for label, size in sizes.items():
        # somewhat under the share, so that chance hardly ever goes over the limit
        share = min(1.0, max(0.0, want - 4 * want**0.5) / size)
        picked = picked | ((F.col("label") == label) & (place < int(share * (1 << 30)) + (share == 1.0)))
        weight = F.when(F.col("label") == label, 1.0 / max(share, 1e-12)).otherwise(weight)
    ids = clean.filter(picked).withColumn("weight", weight)
    ids = F.broadcast(ids)  # at most ``limit``
    found = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(ids, "id")
    times = docs.select(F.col(id_col).alias("id")).join(ids, "id").groupBy("id").count()
    if not times.filter("count > 1").isEmpty():
        one = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
        found = found.groupBy("id", "label", "weight").agg(one, F.count("*").alias("rows"))
        found = found.select("id", "text", "label", (F.col("weight") * F.col("rows")).alias("weight"))
    path = new_scratch(spark, "labelled-sample")
    found.write.parquet(path)
    return spark.read.parquet(path)
