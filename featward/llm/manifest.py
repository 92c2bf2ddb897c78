"""A Merkle manifest of a table: leaves by row, a tree per group of rows, and a tree over the groups.

A level of an aligned block of nodes is one string: the nodes' hexadecimal digests one after the other. So the
parents are the hashes of substrings of a fixed width, and a node's siblings the substrings beside it. A block's
own root is a node of the next round, until one node remains. Everything is SQL over such strings; rows
are numbered by range partitions, and the largest value is a block's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featward.functions.names import named
from featward.operators.ordinal import number_rows
from featward.session import new_scratch

FAN = 16  # children of a node
LEVELS = 3  # levels of a block
BLOCK = FAN**LEVELS
HEX = 64  # characters of a digest
SIBLINGS = "array<struct<before:binary,after:binary>>"
NOTHING = f"CAST(array() AS {SIBLINGS})"


def field_text(column: Column) -> Column:
    """A value in a leaf: ``-`` for NULL, else its length in bytes of UTF-8, a colon, and its text."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = new_scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hash(data: str) -> str:
    return f"CAST(sha2({data}, 256) AS binary)"


def _parents(level: str) -> str:
    """The level above: every ``FAN`` digests, the last run of which may be shorter, become one."""
    width = FAN * HEX
    run = f"substring({level}, CAST(i * {width} + 1 AS INT), {width})"
    last = f"CAST((length({level}) + {width - 1}) DIV {width} - 1 AS INT)"
    return f"concat_ws('', transform(sequence(0, {last}), i -> sha2({run}, 256)))"


def _beside(level: str, node: str) -> str:
    """What flanks a node in its run, by its number in the level."""
    width = FAN * HEX
    run = f"({node} DIV {FAN}) * {width}"
    before = f"substring({level}, CAST({run} + 1 AS INT), CAST(({node} % {FAN}) * {HEX} AS INT))"
    after = (
        f"substring({level}, CAST(({node} + 1) * {HEX} + 1 AS INT), CAST({run} + {width} - ({node} + 1) * {HEX} AS INT))"
    )
    return f"named_struct('before', {before}, 'after', {after})"


def _blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of numbered nodes (grp, n, pos, node, item): grp, n, block, items, level0 to level3 and top.

    ``n`` counts the group's nodes. In a group of one block the levels end where one node remains;
    in a larger one every block has all levels.
    """
    block = f"CAST(pos DIV {BLOCK} AS BIGINT)"
    rows = (
        nodes.groupBy("grp", "n", F.expr(block).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "node", "item"))).alias("items"))
        .withColumn("level0", F.expr("CAST(concat_ws('', transform(items, x -> CAST(x.node AS STRING))) AS binary)"))
    )
    for level in range(LEVELS):
        more = f"n > {FAN**level}"
        rows = rows.withColumn(
            f"level{level + 1}", F.expr(f"IF({more}, CAST({_parents(f'level{level}')} AS binary), NULL)")
        )
    tops = ", ".join(f"level{level}" for level in range(LEVELS, -1, -1))
    return rows.withColumn("top", F.expr(f"coalesce({tops})"))


def _path(number: str) -> str:
    """The siblings of a node of a block, level by level."""
    steps, node = [], number
    for level in range(LEVELS):
        steps.append(f"IF(level{level + 1} IS NULL, NULL, {_beside(f'level{level}', node)})")
        node = f"({node} DIV {FAN})"
    return f"filter(array({', '.join(steps)}), s -> s IS NOT NULL)"


def _climb(nodes: DataFrame, most: int, label: str) -> tuple[DataFrame, DataFrame]:
    """The blocks of ``nodes`` with ``root`` and ``path``, the siblings from a block's top up to the root of its
    group; and grp, root. ``most`` is the largest number of nodes of a group."""
    blocks = _stored(_blocks(nodes), label)
    done = blocks.filter(f"n <= {BLOCK}").withColumn("root", F.col("top")).withColumn("path", F.expr(NOTHING))
    roots = done.select("grp", "root")
    if most <= BLOCK:
        return done, roots
    many = blocks.filter(f"n > {BLOCK}")
    fewer = many.selectExpr(
        "grp", f"(n + {BLOCK - 1}) DIV {BLOCK} AS n", "block AS pos", "top AS node", "CAST(NULL AS STRING) AS item"
    )
    above, above_roots = _climb(fewer, -(-most // BLOCK), label)
    number = f"x.pos % {BLOCK}"
    upper = above.selectExpr(
        "grp AS up_grp", "root", "path", f"inline(transform(items, x -> struct(x.pos AS up, {_path(number)} AS own)))"
    ).selectExpr("up_grp", "up", "root", f"CAST(concat(own, path) AS {SIBLINGS}) AS path")
    same = many["grp"].eqNullSafe(F.col("up_grp")) & (many["block"] == F.col("up"))
    return done.unionByName(many.join(upper, same).drop("up_grp", "up")), roots.unionByName(above_roots)


def _numbered(df: DataFrame, names: list[str], order: list[str]) -> DataFrame:
    numbered, _ = number_rows(df.select(*names), order)
    return numbered.toDF(*names, "pos")


def merkle_manifest(
    df: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "source",
    order_col: str = "doc_id",
    tampered: Column | None = None,
    tampered_fields: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: order_col, leaf, subroot, root, proof_sha256, folded_root, verified; and group_col.

    A leaf is the SHA-256 of the row's fields in their order, each as :func:`field_text` writes it; it and all nodes are
    lower-case hexadecimal text. The rows of a group ascend by ``order_col``, NULL first, those that tie by
    their leaves, so copies stand beside each other; while more than one node remains, every 16 consecutive
    ones become the hash of their concatenation. The groups' roots, in the order of the groups (NULL first,
    then by bytes), make the root in the same way. ``proof_sha256`` hashes a leaf's siblings,
    from its own run up to the root. ``folded_root`` folds the leaf with them again; for rows
    where ``tampered`` is true it begins with the leaf of ``tampered_fields``, which replace fields of
    the row. ``verified`` tells whether that is the root. NULL counts as not tampered.

    An empty table gives no rows. Other columns, whatever their names, are not looked at. Texts of any
    length are hashed as a whole. Two writes, one of them sorted, then one grouping per round by blocks of
    4,096 nodes of one group; so a group may hold most rows. The driver holds counts of range
    partitions only.
    """
    changed = tampered_fields or {}

    def leaf(replaced: dict[str, Column]) -> Column:
        return F.sha2(F.concat(*[field_text(replaced.get(f, named(f))) for f in fields]), 256)

    other = F.when(tampered, leaf(changed)) if tampered is not None else F.lit(None).cast("string")
    leaves = df.select(named(group_col).alias("grp"), named(order_col).alias("id"), leaf({}).alias("leaf"), other.alias("other"))
    leaves = _stored(leaves, "manifest-leaves")
    rows = _stored(_numbered(leaves, ["grp", "id", "leaf", "other"], ["grp", "id", "leaf"]), "manifest-rows")
    groups = _stored(rows.groupBy("grp").agg(F.min("pos").alias("start"), F.count("*").alias("n")), "manifest-groups")
    most = groups.agg(F.max("n")).first()[0]
    first = groups.withColumnRenamed("grp", "g")
    nodes = rows.join(first, F.col("grp").eqNullSafe(F.col("g"))).select(
        "grp",
        "n",
        (F.col("pos") - F.col("start")).alias("pos"),
        F.col("leaf").cast("binary").alias("node"),
        F.struct("id", "other").alias("item"),
    )
    if most is None:
        text = F.lit("")
        empty = [text.alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
        return df.filter("false").select(
            named(order_col).alias(order_col), *empty, F.lit(True).alias("verified"), named(group_col).alias(group_col)
        )
    blocks, subroots = _climb(nodes, most, "manifest-blocks")
    tops = _numbered(subroots, ["grp", "root"], ["grp"])
    count = groups.count()
    tops = tops.selectExpr(
        "0 AS grp", f"CAST({count} AS BIGINT) AS n", "pos", "root AS node", "struct(grp AS of) AS item"
    )
    upper, _ = _climb(tops, count, "manifest-roots")
    number = f"x.pos % {BLOCK}"
    upper = upper.selectExpr(
        "root AS all_root",
        "path AS last",
        f"inline(transform(items, x -> struct(x.item.of AS of, {_path(number)} AS own)))",
    ).selectExpr("of", "all_root", f"CAST(concat(own, last) AS {SIBLINGS}) AS last")
    joined = blocks.join(upper, F.col("grp").eqNullSafe(F.col("of")))
    whole = f"concat({_path(number)}, path, last)"
    fold = f"aggregate(p, CAST(coalesce(x.item.other, CAST(x.node AS STRING)) AS binary), (a, s) -> {_hash('concat(s.before, a, s.after)')})"
    proof = "sha2(aggregate(p, CAST('' AS binary), (a, s) -> concat(a, s.before, s.after)), 256)"
    with_path = f"transform(items, x -> transform(array({whole}), p -> struct(x.item.id AS id, CAST(x.node AS STRING) AS leaf, {proof} AS proof_sha256, CAST({fold} AS STRING) AS folded_root))[0])"
    found = joined.selectExpr(
        "grp", "CAST(root AS STRING) AS subroot", "CAST(all_root AS STRING) AS root", f"inline({with_path})"
    )
    return found.select(
        F.col("id").alias(order_col),
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
        F.col("grp").alias(group_col),
    )
