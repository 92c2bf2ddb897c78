"""Feature-table care on Spark: dated ingest, version diffs, scoring and binning.

Every public function takes and returns a Spark DataFrame.
"""

from featward.operators.align import align_columns, sanitize_names
from featward.operators.diff import diff_cells, diff_flags, diff_report
from featward.operators.lookback import lookback_dates, lookback_select
from featward.operators.models import (
    LogisticModel,
    MlClassifier,
    TreeEnsemble,
    load_model,
    load_tree_dump,
    save_model,
)
from featward.operators.ordinal import with_ordinal
from featward.operators.positional import compare_csv, compare_positional
from featward.operators.quality import non_numeric_values
from featward.operators.rowmatch import frames_equal, match_rows, row_multiset_diff
from featward.operators.score import assign_bin, class_id, score, scored_output
from featward.operators.segments import assign_segment_bin
from featward.session import get_spark
from featward.sinks.delimited import write_delimited
from featward.sinks.tables import drop_table, overwrite_table, recover_table
from featward.sources.dated import ingest_dated_csv, list_dated_files, read_date_list
from featward.sources.delimited import read_delimited, read_file_ordered_csv

__all__ = [
    "LogisticModel",
    "MlClassifier",
    "TreeEnsemble",
    "align_columns",
    "assign_bin",
    "assign_segment_bin",
    "class_id",
    "compare_csv",
    "compare_positional",
    "diff_cells",
    "diff_flags",
    "diff_report",
    "drop_table",
    "frames_equal",
    "get_spark",
    "ingest_dated_csv",
    "list_dated_files",
    "load_model",
    "load_tree_dump",
    "lookback_dates",
    "lookback_select",
    "match_rows",
    "non_numeric_values",
    "overwrite_table",
    "read_date_list",
    "read_delimited",
    "read_file_ordered_csv",
    "recover_table",
    "row_multiset_diff",
    "sanitize_names",
    "save_model",
    "score",
    "scored_output",
    "with_ordinal",
    "write_delimited",
]
