"""The one-join and the split shape of the outer diffs give the same rows."""

import pytest

from featward import diff_cells, diff_flags, diff_report


@pytest.fixture
def versions(spark):
    schema = "k int, j string, n int, r struct<`a-b`:int>, m map<string,int>"
    original = [
        (1, "a", 1, (1,), {"x": 1}), (2, "a", None, None, None), (3, None, 3, (3,), None),
        (4, "d", 4, (4,), {"y": 2}), (None, "e", None, None, None),
    ]
    new = [
        (1, "a", 2, (1,), {"x": 1}), (2, "a", 5, (2,), {"z": 0}), (3, None, 3, (3,), None),
        (6, "f", None, None, {"q": 1}), (None, "e", 1, None, None),
    ]
    return spark.createDataFrame(original, schema), spark.createDataFrame(new, schema)


def test_same_rows(versions, rows):
    key = ["k", "j"]
    for make in (
        lambda **how: diff_cells(*versions, key, null_safe=True, **how),
        lambda **how: diff_report(*versions, key, null_safe=True, **how),
        lambda **how: diff_flags(*versions, key, "n", **how),
        lambda **how: diff_flags(*versions, key, "r", **how),
    ):
        joined, split = make(), make(duplicates="multiply")
        assert joined.dtypes == split.dtypes
        found = rows(joined)
        assert found == rows(split) and len(found) >= 7
