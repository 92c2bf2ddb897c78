"""The Merkle manifest against a plain one that keeps whole levels as lists."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from featward.llm import manifest
from featward.llm.manifest import merkle_manifest
from featward.llm.queries import ASCII_LOWER, ASCII_UPPER, op13_manifest

from .conftest import SF

LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, grp int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return digest("".join(map(written, (*row[:4], text))))


def tree(nodes):
    """The root, and for every leaf what stands before and after it at each level."""
    flanks, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, place in enumerate(at):
            run = place // 16 * 16
            flanks[leaf].append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + 16])))
        at = [place // 16 for place in at]
        nodes = [digest("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], flanks


def plain(rows):
    sources = defaultdict(list)
    for row in rows:
        doc_id, text = row[0], row[4]
        leaf = start = leaf_of(row, text)
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            start = leaf_of(row, text.translate(LOWER))
        sources[row[1]].append((doc_id is not None, doc_id or 0, leaf, start, doc_id))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([r[2] for r in sorted(sources[s])]) for s in order}
    root, upper = tree([trees[s][0] for s in order])
    found = []
    for source, above in zip(order, upper):
        subroot, flanks = trees[source]
        for (*_, leaf, folded, doc_id), own in zip(sorted(sources[source]), flanks):
            path = own + above
            for before, after in path:
                folded = digest(before + folded + after)
            proof = digest("".join(before + after for before, after in path))
            found.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return sorted(found, key=repr)


def built(df):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lower = {"text": F.translate("text", ASCII_UPPER, ASCII_LOWER)}
    rows = merkle_manifest(df, tampered=tampered, tampered_fields=lower).drop("source")
    return sorted(map(tuple, rows.collect()), key=repr)


@pytest.fixture(params=[1, 2, 3])
def levels(request, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", request.param)
    monkeypatch.setattr(manifest, "BLOCK", manifest.FAN**request.param)


def test_odd_rows_and_many_rounds(spark, levels):
    rows = [(None, None, None, None, None, "x", 1), (None, None, None, None, None, "y", 2)]  # equal leaves
    rows += [(5, "a", "en", 3, "ABC", "", 1)] * 2 + [(5, "a", "en", 3, "abd", "", 1), (7, "", "en", 0, "", "", 1)]
    rows += [(i, "ü", "de", 4, "TéXt", "", 0) for i in range(300)]
    rows += [(i, f"s{i}", "de", -4, "LONG " * 3000, "", 0) for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert built(df) == plain([r[:5] for r in rows])
    assert built(df.filter("n_chars = 0")) == plain([rows[5][:5]])  # a lone leaf is the root
    assert built(df.filter("source = 'a'")) == plain([r[:5] for r in rows[2:5]])
    assert built(df.filter("false")) == []


def test_a_changed_row_changes_the_root(spark):
    df = spark.createDataFrame([(i, "a", "en", 1, f"T{i}", "", 0) for i in range(40)], SCHEMA)
    changed = df.withColumn("text", F.when(F.col("doc_id") == 17, "other").otherwise(F.col("text")))
    (one,), (two,) = ({r[3] for r in built(frame)} for frame in (df, changed))
    assert one != two
    verified = {r[0]: r[6] for r in built(df)}
    assert verified == {i: zlib.crc32(str(i).encode()) % 5 != 0 for i in range(40)}


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    assert sorted(map(tuple, op13_manifest(spark, str(SF)).collect()), key=repr) == plain(map(tuple, docs.collect()))
