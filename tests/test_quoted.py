"""CSV records with line breaks in quoted fields, over splits of a few bytes, against one-file readers."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from featward import compare_csv
from featward.plans import queries
from featward.sources import quoted
from featward.sources.quoted import Records, header_names, line_states


def outcome(line, state, sep):
    """A plain automaton: is a quoted field open after the line?"""
    mode = "quoted" if state else "start"
    for c in line:
        if mode == "quoted":
            mode = "closing" if c == '"' else mode
        elif mode == "closing":
            mode = "quoted" if c == '"' else "start" if c == sep else "rest"
        elif c == sep:
            mode = "start"
        elif mode == "start":
            mode = "quoted" if c == '"' else "rest"
    return mode == "quoted"


@pytest.mark.parametrize("sep", [",", "~", "|", "\t"])
def test_line_states_equal_an_automaton(sep):
    draw = random.Random(3)
    patterns = line_states(sep)
    for _ in range(20_000):
        line = "".join(draw.choices(['"', '"', sep, "a", " ", "é"], k=draw.randint(0, 12)))
        for state, pattern in enumerate(patterns):
            assert bool(pattern.match(line)) == outcome(line, state, sep), (line, state)


def test_line_states_take_time_in_proportion():
    for line in ('"' * 200_000, '",' * 100_000, '""a' * 70_000, "a" * 300_000 + '"'):
        for pattern in line_states(","):
            pattern.match(line)


def spoiled(draw):
    parts = ["x", " ", ",", '"', '""', "\n", "\n\n", "\r\n", "é", "1", "long text " * draw.randint(0, 12)]
    return "".join(draw.choices(parts, k=draw.randint(0, 9)))


def written(path, rows, newline="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    csv.writer(out, lineterminator=newline, quoting=quoting).writerows(rows)
    path.write_bytes(out.getvalue().encode())


def read(spark, paths, columns):
    schema = ", ".join(f"{c} STRING" for c in columns)

    def parsed(text):
        fields = F.from_csv(text, F.lit(schema), {"escape": '"'})
        return [fields[c].alias(c) for c in columns]

    records = Records(spark, paths)
    rows = sorted(tuple(r)[0:1] + tuple(r)[2:] for r in records.rows(parsed).collect())
    return records, rows


@pytest.fixture(params=[40, 300, 1 << 20])
def split_bytes(request, setting):
    setting(spark__sql__files__maxPartitionBytes=str(request.param), spark__sql__files__openCostInBytes="1")
    return request.param


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_positions_equal_those_of_one_file_reading(spark, tmp_path, split_bytes, newline, monkeypatch):
    draw = random.Random(split_bytes)
    expected = []
    for side in range(2):
        rows = []
        for name in ("part-00002.csv", "part-00010.csv", "part-00001.csv"):
            lines = [["id", "text", "note"]] + [[str(i), spoiled(draw), spoiled(draw)] for i in range(draw.randint(0, 60))]
            path = tmp_path / str(side) / name
            path.parent.mkdir(exist_ok=True)
            written(path, lines, newline)
            rows.append((name, path))
        pos = 0
        for _, path in sorted(rows, key=lambda r: r[0]):
            table = spark.read.csv(str(path), header=True, multiLine=True, escape='"', lineSep=newline).coalesce(1)
            for row in table.collect():
                expected.append((side, pos, *row))
                pos += 1
    if split_bytes == 300:
        monkeypatch.setattr(quoted, "BROADCAST_SPLITS", 0)
    records, found = read(spark, [str(tmp_path / "0"), str(tmp_path / "1")], ["id", "text", "note"])
    assert found == sorted(expected, key=lambda r: r[:2])
    assert records.counts == [sum(r[0] == side for r in expected) for side in range(2)]
    if split_bytes == 40:
        assert records.n_splits > 50


def test_odd_files(spark, tmp_path, split_bytes):
    texts = {
        "a": 'h,k\n"' + "deep\n\n" * 200 + '",1\n',  # one record over many splits
        "b": 'h,k\n\n  \n"x\n',  # blank lines are no records; a quote left open at the end
        "c": 'h,k\n' + 'a"b,c"\n' * 20,  # quotes within fields that are not quoted
        "d": "\n\nh,k\n1,2",  # no line break at the end
        "e": "h,k\n",
    }
    expected = {"a": [("deep\n\n" * 200, "1")], "b": [("x", None)], "c": [('a"b', 'c"')] * 20, "d": [("1", "2")], "e": []}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    _, found = read(spark, [str(tmp_path / n) for n in texts], ["h", "k"])
    got = {name: [(r[2], r[3]) for r in found if r[0] == i] for i, name in enumerate(texts)}
    assert got["b"][0][0].strip() == "x"
    assert got | {"b": expected["b"]} == expected


def test_headers(spark, tmp_path):
    assert header_names('a,"b\nc",,A\r', ",") == ["a0", "b\nc", "_c2", "A3"]
    for name, text in (("x", "a,b\n1,2\n"), ("y", "b,a\n1,2\n"), ("z", "")):
        (tmp_path / name).write_text(text)
    with pytest.raises(ValueError, match="has the header"):
        compare_csv(spark, [str(tmp_path / "x"), str(tmp_path / "y")], str(tmp_path / "x"))
    with pytest.raises(ValueError, match="no file has a header"):
        compare_csv(spark, str(tmp_path / "x"), str(tmp_path / "z"))
    with pytest.raises(ValueError, match="differ in their columns"):
        compare_csv(spark, str(tmp_path / "x"), str(tmp_path / "y"))
    by_place = compare_csv(spark, str(tmp_path / "x"), str(tmp_path / "y"), "a int, b int", strict_header=False)
    assert by_place.collect() == []


def test_a_quoted_line_break_is_no_row(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('k,v\n1,"x\ny"\n2,b\n')
    (tmp_path / "b.csv").write_text('k,v\n1,"x\ny"\n2,c\n')
    assert rows(compare_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"))) == [(1, "v", "b", "c")]


def test_the_query_writes_its_texts_in_many_tasks(spark, tmp_path, setting, monkeypatch):
    """No part file holds much of the whole; rows of one doc_id, or of none, stay in the order of the input."""
    setting(spark__sql__adaptive__coalescePartitions__enabled="false")
    draw = random.Random(9)
    texts = [None if i % 31 == 0 else f'{i}\n"{"word " * draw.randrange(40)}",' for i in range(2000)]
    docs = [(None if i % 13 == 0 else i * 7 % 400, "en" if i % 3 else None, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    frame.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    paths = iter([tmp_path / "a", tmp_path / "b"])
    monkeypatch.setattr(queries, "new_scratch", lambda *_: str(next(paths)))
    found = queries.q_compare_csv_line_breaks(spark, str(tmp_path))
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    expected = [(i, "text", t, f'{t}\n"edited",\ntwice') for i, (d, _, t) in enumerate(ordered) if t and d is not None and d % 7 == 0]
    assert sorted(map(tuple, found.collect())) == expected
    for side in "ab":
        sizes = [f.stat().st_size for f in (tmp_path / side).glob("part-*")]
        assert max(sizes) < sum(sizes) / 3
