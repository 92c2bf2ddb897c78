"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featward.operators.align import align_columns
from featward.operators.diff import diff_cells, diff_flags, diff_report
from featward.operators.lookback import lookback_dates, lookback_select
from featward.operators.models import MlClassifier, load_model, save_model
from featward.operators.ordinal import with_ordinal
from featward.operators.positional import compare_csv, compare_positional
from featward.operators.quality import non_numeric_values
from featward.operators.rowmatch import frames_equal, match_rows, row_multiset_diff
from featward.operators.score import PROBA, assign_bin, class_id, score, scored_output
from featward.operators.segments import assign_segment_bin
from featward.plans.inputs import (
    LOGISTIC,
    RUN_DT,
    TREES,
    dated_files,
    dated_tree,
    drifting_files,
    many_trees,
    mixed_text,
    ordered_csv,
    original_orders,
    restated_orders,
    table,
)
from featward.session import new_scratch, new_table
from featward.sinks.delimited import write_delimited
from featward.sinks.tables import overwrite_table
from featward.sources.dated import ingest_dated_csv, list_dated_files, read_date_list
from featward.sources.delimited import read_delimited

LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return original_orders(spark, sf_dir), restated_orders(spark, sf_dir)


def _six_places(proba: Column) -> Column:
    """To six places in double arithmetic; ``round`` would go through decimals row by row."""
    return F.rint(proba * 1e6) / 1e6


def _rounded(scored: DataFrame) -> DataFrame:
    return scored.withColumn(PROBA, _six_places(F.col(PROBA)))


def q_ingest_dated_csv(spark, sf_dir):
    return ingest_dated_csv(spark, dated_files(spark, sf_dir) + "/file=feat_final_*.csv")


def q_ingest_drifting_headers(spark, sf_dir):
    """Dated files whose headers change over the days, every value under its name."""
    return ingest_dated_csv(spark, drifting_files(spark, sf_dir) + "/file=feat_final_*.csv", by_name=True)


def q_ingest_to_table(spark, sf_dir):
    """Dated files into a table partitioned by their date."""
    rows = ingest_dated_csv(spark, dated_files(spark, sf_dir) + "/file=feat_final_*.csv", strict_header=True)
    name = new_table("features")
    overwrite_table(rows, name, partition_by="prcsng_dt", path=new_scratch(spark, "table"), rebalance=True)
    return spark.table(name)


def q_list_dated_files(spark, sf_dir):
    root = dated_tree(spark, sf_dir)
    found = list_dated_files(spark, root, "name=feat_final.csv", part_files=True)
    return found.select("prcsng_dt").distinct()


def q_list_dated_file_sizes(spark, sf_dir):
    """Lines of a fixed length: the listed lengths add up to the events of each date."""
    root = new_scratch(spark, "sized-tree")
    events = table(spark, sf_dir, "events")
    line = F.lpad(F.col("event_id").cast("string"), 19, "0").alias("value")
    day = F.date_format("ts", "yyyyMMdd").alias("day")
    events.select(line, day, F.lit("feat_final.csv").alias("name")).hint("rebalance", "day").write.partitionBy(
        "day", "name"
    ).text(root)
    found = list_dated_files(spark, root, "name=feat_final.csv", part_files=True)
    in_path = F.regexp_extract("path", "day=([0-9]{8})/name=feat_final.csv/part-", 1) == F.col("prcsng_dt")
    new = F.col("modified") > F.lit("2020-01-01").cast("timestamp")
    return found.groupBy("prcsng_dt").agg(
        F.sum("length").alias("bytes"), F.bool_and(in_path & new).alias("as_expected")
    )


def q_read_date_list(spark, sf_dir):
    """Every date the listing finds, and one without a file."""
    root = dated_tree(spark, sf_dir)
    listed = list_dated_files(spark, root, "name=feat_final.csv", part_files=True)
    days = listed.select("prcsng_dt").distinct().collect()
    dates = ["19000101", *sorted(r.prcsng_dt for r in days)]
    return read_date_list(spark, root + "/day={date}/name=feat_final.csv", dates, on_missing="skip")


def q_align_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    a = orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("total-price"),
        F.col("o_orderpriority").alias("only_in_a"),
    )
    b = orders.select(
        F.col("o_custkey").alias("only-in-b"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("total_price"),
        F.col("o_orderkey").alias("id"),
    )
    left, right = align_columns(a, b)
    return left.withColumn("side", F.lit("a")).unionAll(right.withColumn("side", F.lit("b")))


def q_diff_cells(spark, sf_dir):
    return diff_cells(*_versions(spark, sf_dir), key="id")


def q_diff_cells_nullsafe(spark, sf_dir):
    return diff_cells(*_versions(spark, sf_dir), key="id", null_safe=True)


def q_diff_cells_conversations(spark, sf_dir):
    """Two-column key and whole texts: some turns edited, the system turns moved."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    edited = (F.col("role") == "assistant") & (F.col("turn") > 2)
    new = turns.select(
        "conv_id",
        F.when(F.col("role") == "system", F.col("turn") + 100).otherwise(F.col("turn")).alias("turn"),
        "role",
        F.when(edited, F.concat("text", F.lit(" (edited)"))).otherwise(F.col("text")).alias("text"),
    )
    return diff_cells(turns, new, key=["conv_id", "turn"], null_safe=True)


def q_diff_cells_repeated_keys(spark, sf_dir):
    """Every order against its lines: a key that repeats on the new side."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), "o_orderstatus", F.to_date("o_orderdate").alias("day")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 50 == 0, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("id"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.to_date("l_shipdate").alias("day"),
    )
    return diff_cells(orders, lines, key="id", null_safe=True)


def q_diff_cells_digest_first(spark, sf_dir):
    """Every document with its whole text, of which few change: only those are shuffled."""
    documents = table(spark, sf_dir, "documents")
    new = documents.select(
        F.when(F.col("doc_id") % 103 == 0, -F.col("doc_id") - 1).otherwise(F.col("doc_id")).alias("doc_id"),
        F.when(F.col("doc_id") % 29 == 0, F.concat("text", F.lit(" (edited)"))).otherwise(F.col("text")).alias("text"),
        F.when(F.col("doc_id") % 37 != 0, F.col("lang")).alias("lang"),
        "source",
        F.when(F.col("doc_id") % 41 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("n_chars"),
    )
    return diff_cells(documents, new, key="doc_id", null_safe=True, digest_first=True)


def q_diff_report_digest_first(spark, sf_dir):
    return diff_report(*_versions(spark, sf_dir), key="id", digest_first=True)


def q_diff_bucketed(spark, sf_dir):
    """Two tables in as many buckets: their diff shuffles nothing."""
    names = []
    for version in _versions(spark, sf_dir):
        names.append(new_table("bucketed"))
        overwrite_table(version, names[-1], bucket_by=(4, "id"), path=new_scratch(spark, "table"))
    return diff_cells(*[spark.table(n) for n in names], key="id")


def q_diff_flags_price(spark, sf_dir):
    return diff_flags(*_versions(spark, sf_dir), key="id", column="price")


def q_diff_report(spark, sf_dir):
    return diff_report(*_versions(spark, sf_dir), key="id")


def q_diff_report_nullsafe(spark, sf_dir):
    return diff_report(*_versions(spark, sf_dir), key="id", null_safe=True)


def q_diff_report_csv(spark, sf_dir):
    """The report without its key, written as CSV and read back."""
    path = new_scratch(spark, "report")
    report = diff_report(*_versions(spark, sf_dir), key="id", include_key=False)
    write_delimited(report, path, sep=",")
    return read_delimited(spark, path, sep=",", schema="differences string")


def q_match_rows(spark, sf_dir):
    return match_rows(*_versions(spark, sf_dir))


def q_match_rows_nullsafe(spark, sf_dir):
    return match_rows(*_versions(spark, sf_dir), null_safe=True)


def q_match_rows_unmatched(spark, sf_dir):
    return match_rows(*_versions(spark, sf_dir), unmatched_only=True)


def q_match_rows_unmatched_self(spark, sf_dir):
    original = original_orders(spark, sf_dir)
    return match_rows(original, original, unmatched_only=True)


def q_row_multiset_diff(spark, sf_dir):
    return row_multiset_diff(*_versions(spark, sf_dir))


def q_row_multiset_diff_copies(spark, sf_dir):
    """Rows with many copies: the lines' flags, before and after a status change."""
    lines = table(spark, sf_dir, "lineitem")
    flags = lines.select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))
    turned = lines.select(
        F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_quantity") < 10, "X").otherwise(F.col("l_linestatus")).alias("status"),
    )
    return row_multiset_diff(flags, turned)


def q_row_multiset_diff_documents(spark, sf_dir):
    """Whole texts with their copies; the documents of one source change their language."""
    documents = table(spark, sf_dir, "documents")
    lang = F.when(F.col("source") == "src3", "xx").otherwise(F.col("lang")).alias("lang")
    return row_multiset_diff(documents.select("lang", "text"), documents.select(lang, "text"))


def q_compare_positional(spark, sf_dir):
    original = original_orders(spark, sf_dir)
    restated = restated_orders(spark, sf_dir, rekeyed=False)
    return compare_positional(original, restated, order_by="id")


def q_compare_csv(spark, sf_dir):
    """Two CSVs of all orders, compared in the order of their lines."""
    a = ordered_csv(original_orders(spark, sf_dir), "id")
    b = ordered_csv(restated_orders(spark, sf_dir, rekeyed=False), "id")
    return compare_csv(spark, a, b, "id bigint, status string, price decimal(15,2)")


def q_compare_csv_inferred(spark, sf_dir):
    """Prices and keys written in other ways, and missing-value tokens: types settle what is equal."""
    orders = table(spark, sf_dir, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(15,2)")
    a = orders.select(
        key.alias("id"), price.cast("string").alias("price"), (key % 2 == 0).cast("string").alias("even"),
        F.when(key % 7 == 0, "NA").otherwise(F.col("o_orderstatus")).alias("status"),
    )
    b = orders.select(
        key.alias("id"),
        F.when(key % 11 == 0, price + 1).otherwise(price).cast("decimal(18,4)").cast("string").alias("price"),
        F.initcap((key % 2 == 0).cast("string")).alias("even"),
        F.when(key % 7 == 0, "null").when(key % 13 == 0, "x").otherwise(F.col("o_orderstatus")).alias("status"),
    )
    cells = compare_csv(spark, ordered_csv(a, "id"), ordered_csv(b, "id"))
    return cells.groupBy("column_name").agg(F.count("*").alias("cells"), F.sum("pos").alias("positions"))


def q_compare_csv_line_breaks(spark, sf_dir):
    """Whole texts, line breaks and quotes within them: two CSVs in the order of doc_id, read in pieces of 256 KB.

    Rows of one doc_id stay in the order of the input; each part file is written by a task of its own.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text", F.monotonically_increasing_id().alias("at"))
    edited = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit('\n"edited",\ntwice'))).otherwise(F.col("text"))
    paths = []
    for version in (documents, documents.withColumn("text", edited)):
        paths.append(new_scratch(spark, "texts-csv"))
        write_delimited(version.orderBy("doc_id", "at").drop("at"), paths[-1], ",", null_value="NA", escape='"')
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for name in before:
            spark.conf.set(name, "262144")
        return compare_csv(spark, *paths, "doc_id bigint, lang string, text string")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def q_frames_equal(spark, sf_dir):
    original, restated = _versions(spark, sf_dir)
    changed = frames_equal(original, restated).withColumn("pair", F.lit("original, restated"))
    same = frames_equal(original, original).withColumn("pair", F.lit("original, original"))
    return changed.unionAll(same)


def q_frames_equal_ordered(spark, sf_dir):
    original = original_orders(spark, sf_dir)
    restated = restated_orders(spark, sf_dir, rekeyed=False)
    changed = frames_equal(original, restated, "id").withColumn("pair", F.lit("original, restated"))
    same = frames_equal(original, original, "id").withColumn("pair", F.lit("original, original"))
    return changed.unionAll(same)


def q_ordinal(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return with_ordinal(orders, ["o_custkey", "o_orderkey"])


def q_score_logistic(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return _rounded(score(lines, LOGISTIC, keep=LINE_KEYS))


def q_score_trees(spark, sf_dir):
    """The ensemble after a trip through its JSON file, as generated code."""
    path = new_scratch(spark, "model")
    save_model(spark, TREES, path)
    lines = table(spark, sf_dir, "lineitem")
    return _rounded(score(lines, load_model(spark, path), keep=LINE_KEYS, engine="native"))


def q_score_trees_udf(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return _rounded(score(lines, TREES, keep=LINE_KEYS, engine="udf"))


def q_score_trees_missing(spark, sf_dir):
    """Missing features go down the branch that the tree names."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_discount", F.when(F.col("l_linenumber") % 2 == 0, F.col("l_discount"))
    )
    lines = lines.withColumn("l_tax", F.when(F.col("l_orderkey") % 3 != 0, F.col("l_tax")))
    return _rounded(score(lines, TREES, keep=LINE_KEYS, engine="udf"))


def q_score_trees_many(spark, sf_dir):
    """An ensemble of an ordinary size: 500 trees of depth 6."""
    return _rounded(score(table(spark, sf_dir, "lineitem"), many_trees(), keep=LINE_KEYS))


def q_score_classifier(spark, sf_dir):
    """A fitted classifier, here with the weights of the plain model."""
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.common import _py2java
    from pyspark.ml.linalg import Vectors

    weights = _py2java(spark.sparkContext, Vectors.dense(LOGISTIC.weights))
    fitted = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "plain", weights, LOGISTIC.intercept
    )
    model = MlClassifier(LOGISTIC.features, LogisticRegressionModel(fitted))
    return _rounded(score(table(spark, sf_dir, "lineitem"), model, keep=LINE_KEYS))


def q_assign_bin(spark, sf_dir):
    proba = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 1101) / F.lit(1000.0)
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, proba.alias(PROBA))
    return assign_bin(lines)


def q_assign_segment_bin(spark, sf_dir):
    """A hundred bins for every supplier but some, which overlap and leave gaps."""
    proba = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 1101) / F.lit(1000.0)
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_suppkey", proba.alias(PROBA))
    low = F.col("place") * 10 + F.col("s_suppkey") % 7
    bins = (
        table(spark, sf_dir, "supplier")
        .filter(F.col("s_suppkey") % 9 != 4)
        .select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("place"))
        .select(
            F.col("s_suppkey").alias("l_suppkey"),
            "place",
            (low / F.lit(1000.0)).alias("LOW_P"),
            ((low + 4 + F.col("place") * 5 % 17) / F.lit(1000.0)).alias("HIGH_P"),
            (F.col("place") * 37 % 100 + 2).alias("BIN"),
        )
    )
    return assign_segment_bin(lines, bins, "l_suppkey", order_by="place")


def q_class_id(spark, sf_dir):
    """Class ids over the whole line table; a line without a discount has a NULL bin."""
    proba = F.when(F.col("l_discount") > 0, F.col("l_discount") * 10)
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, _six_places(proba).alias(PROBA))
    return class_id(assign_bin(lines, default=F.lit(None).cast("int")))


def q_scored_output(spark, sf_dir):
    """Score, bin and shape every line: the flagship pipeline."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "line", F.concat_ws("-", "l_orderkey", "l_linenumber")
    )
    scored = _rounded(score(lines, LOGISTIC, keep="line"))
    return scored_output(assign_bin(scored), RUN_DT, cust_col="line")


def q_scored_output_csv(spark, sf_dir):
    """The scored output as separated text, read back: blanks come back as NULL."""
    path = new_scratch(spark, "scored")
    output = q_scored_output(spark, sf_dir)
    write_delimited(output, path)
    return read_delimited(spark, path, schema=output.schema)


def q_non_numeric_values(spark, sf_dir):
    return non_numeric_values(mixed_text(spark, sf_dir), "v")


def q_non_numeric_documents(spark, sf_dir):
    """The check over whole texts: every document whose text is not a number."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return non_numeric_values(documents, "text").drop("text")


def q_non_numeric_page_numbers(spark, sf_dir):
    """The last step of every page's path, of which some are numbers."""
    step = F.regexp_extract("url", r"([^/?#]*)/?(?:[?#].*)?$", 1)
    return non_numeric_values(table(spark, sf_dir, "pages").select("page_id", step.alias("step")), "step")


def q_delimited_roundtrip(spark, sf_dir):
    key = F.col("o_orderkey")
    text = (
        F.when(key % 3 == 0, "")
        .when(key % 5 == 0, F.lit(None))
        .when(key % 7 == 0, F.concat("o_orderpriority", F.lit("~"), "o_orderstatus"))
        .otherwise(F.col("o_orderpriority"))
    )
    rows = table(spark, sf_dir, "orders").select(key.alias("id"), text.alias("note"))
    path = new_scratch(spark, "delimited")
    write_delimited(rows, path, null_value="\\N")
    return read_delimited(spark, path, schema="id bigint, note string", null_value="\\N")


def q_overwrite_table(spark, sf_dir):
    """A table written with the original orders, then replaced by the restated ones."""
    original, restated = _versions(spark, sf_dir)
    name = new_table("orders")
    path = new_scratch(spark, "table")
    overwrite_table(original, name, path=path)
    overwrite_table(restated, name, partition_by="status", path=path, rebalance=True)
    return spark.table(name).select("id", "status", "price")


def q_lookback_select(spark, sf_dir):
    """Recent events of overdrawn customers, written as Parquet and read back."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    overdrawn = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0)
    recent = lookback_select(
        events, overdrawn, "2024-01-15", 7, date_col="ts", account_col="user_id", account_key="c_custkey"
    )
    path = new_scratch(spark, "lookback")
    recent.select("event_id", "user_id", "event_type").write.parquet(path)
    return spark.read.parquet(path)


def q_read_lookback_dates(spark, sf_dir):
    """The files of the seven days up to a run date, found by date alone."""
    root = dated_tree(spark, sf_dir)
    days = lookback_dates("2024-01-15", 7)
    return read_date_list(spark, root + "/day={date}/name=feat_final.csv", days, on_missing="skip")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name.removeprefix("q_"): query for name, query in list(globals().items()) if name.startswith("q_")
}
