"""Shards by a hierarchical weighted hash tree.

A row descends from the root over regions and racks to a shard. At each node every child
draws ``-ln(u) / weight`` with u hashed from key and child; the smallest draw wins, so a
child gets a share in proportion to its weight and draws of other nodes do not matter.
If a weight changes, rows move only between that child and its siblings, level by level.

A shard added later hangs under the root in a region of its own (``grown``), so that no
weight of the founding tree changes and rows move into the new shard only.

Everything is column expressions; nothing but ids, sizes and checksums is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limpid.llm.layout import cut

HEX_DIGITS = 13


@dataclass(frozen=True)
class Node:
    """A named subtree; a leaf holds a shard."""

    name: str
    weight: float = 1.0
    shard: int | None = None
    children: tuple[Node, ...] = field(default=())


def inner(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), None, tuple(children))


def shard_tree(shards: int, founding: int = 24, per_rack: int = 4, racks: int = 2) -> Node:
    """Regions of racks of shards; shards beyond the founding ones stand in own regions.

    Fewer shards than the founding ones would be another tree, and one more shard would move
    rows between old ones: such a count needs a smaller ``founding`` from its start.
    """
    if not 0 < founding <= shards:
        raise ValueError(f"{shards} shards cannot grow from {founding} founding ones")
    leaves = [Node(f"s{i}", 1.0, i) for i in range(min(shards, founding))]
    rack = [inner(f"k{i // per_rack}", leaves[i : i + per_rack]) for i in range(0, len(leaves), per_rack)]
    regions = [inner(f"r{i // racks}", rack[i : i + racks]) for i in range(0, len(rack), racks)]
    tree = inner("root", regions)
    for i in range(founding, shards):
        tree = grown(tree, i)
    return tree


def grown(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard that takes rows only into itself."""
    leaf = Node(f"s{shard}", weight, shard)
    return inner(tree.name, [*tree.children, inner(f"r-{leaf.name}", [inner(f"k-{leaf.name}", [leaf])])])


def _nodes(tree: Node) -> list[Node]:
    """All nodes, the root first."""
    found = [tree]
    for node in found:
        found.extend(node.children)
    return found


def _depth(node: Node) -> int:
    return 1 + max(map(_depth, node.children)) if node.children else 0


def shard_of(key: Column, tree: Node) -> Column:
    """The shard of a key, a level at a time; a null key is a key of its own."""
    key = F.coalesce(key.cast("string"), F.lit("null"))
    nodes = _nodes(tree)
    number = {n.name: i for i, n in enumerate(nodes)}
    names = F.array(*(F.lit(n.name) for n in nodes))
    weights = F.array(*(F.lit(float(n.weight)) for n in nodes))
    # A leaf is its own only child, so that it stays when others descend further.
    below = F.array(*(
        F.array(*(F.lit(number[c.name]) for c in n.children or (n,))) for n in nodes
    ))

    def draw(child: Column) -> Column:
        """52 bits of a digest of key and child as an exponential draw of the child's rate."""
        digest = F.md5(F.concat(key, F.lit("/"), F.get(names, child)).cast("binary"))
        digits = F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint").cast("double")
        drawn = -F.log((digits + 0.5) / float(16**HEX_DIGITS)) / F.get(weights, child)
        return F.struct(drawn.alias("draw"), child.alias("child"))

    at = F.lit(0)
    for _ in range(_depth(tree)):
        at = F.array_min(F.transform(F.get(below, at), draw))["child"]
    return F.get(F.array(*(F.lit(-1 if n.shard is None else n.shard) for n in nodes)), at)


def _sql_draw(child: Node) -> str:
    digits = f"substr(md5(k || '/{child.name}'), 1, {HEX_DIGITS})"
    return f"-ln((('0x' || {digits})::BIGINT::DOUBLE + 0.5) / {float(16**HEX_DIGITS)!r}) / {child.weight!r}"


def shard_sql(tree: Node) -> str:
    """The same choice as DuckDB SQL over a text column ``k``."""
    if tree.shard is not None:
        return str(tree.shard)
    if len(tree.children) == 1:
        return shard_sql(tree.children[0])
    draws = ", ".join(_sql_draw(c) for c in tree.children)
    options = " ".join(f"WHEN {i} THEN {shard_sql(c)}" for i, c in enumerate(tree.children, 1))
    return f"CASE list_position([{draws}], list_min([{draws}])) {options} END"


def slots(rows: DataFrame, key: str, shard: str, order: list[str]) -> DataFrame:
    """``rows`` with ``slot``: gapless from 0 within each shard, ordered by key and ``order``.

    Distinct rows are range-partitioned by shard, key and ``order`` and written with their
    slice, so many rows of one key, or without one, are still split by what else tells them
    apart. A slice numbers its own rows and starts after the counts of the slices before it
    in its shard. Rows alike in all columns were counted first: one row until the end.
    """
    columns = rows.columns
    by = [F.col(key).asc_nulls_first(), *(F.col(c) for c in order)]
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    spread = counted.repartitionByRange(F.col(shard), *by)
    placed = cut(spread.withColumn("_slice", F.spark_partition_id()), "shard-slices")
    before = Window.partitionBy(shard).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(shard, "_slice").agg(F.sum("_copies").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(shard, "_slice", "_start")
    )
    within = (
        Window.partitionBy(shard, "_slice").orderBy(*by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    numbered = placed.withColumn("_upto", F.sum("_copies").over(within)).join(starts, [shard, "_slice"])
    first = F.col("_start") + F.col("_upto") - F.col("_copies")
    return numbered.select(
        *columns, F.explode(F.sequence(first, F.col("_start") + F.col("_upto") - 1)).alias("slot")
    )


def sharded(
    docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text",
    tree: Node | None = None, founding: int = 24,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``.

    Law ``key``: doc_id and the tree alone decide. ``size`` is the UTF-8 bytes of the text
    and 8; a null text is empty. ``slot`` counts a shard's rows by doc_id from 0, null
    first. Rows of one id share a shard, repeated rows have a slot each. Other columns
    play no part; an empty table gives an empty one.
    """
    tree = tree or shard_tree(shards, founding)
    raw = F.coalesce(F.col(text), F.lit(""))
    doc_id = F.col(key).cast("bigint")
    rows = docs.select(
        doc_id.alias("doc_id"),
        (F.octet_length(raw) + 8).cast("bigint").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        shard_of(doc_id, tree).alias("shard"),
        shard_of(doc_id, grown(tree, shards)).alias("grown_shard"),
    )
    rows = cut(rows, "sharded")
    found = slots(rows, "doc_id", "shard", ["size", "text_crc32"])
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def oracle_sql(shards: int = 24) -> str:
    tree = shard_tree(shards)
    # DuckDB has no checksum of its own: a table by rule, then a fold over the bytes.
    return f"""
    WITH RECURSIVE bits(i, c, n) AS (
      SELECT range, range, 0 FROM range(256)
      UNION ALL
      SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1
      FROM bits WHERE n < 8
    ), crc AS (
      SELECT list(c ORDER BY i) AS steps FROM bits WHERE n = 8
    ), placed AS (
      SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 8 AS size,
             coalesce(doc_id::VARCHAR, 'null') AS k,
             list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                            lambda x: ('0x' || x)::BIGINT) AS bytes
      FROM documents
    ), chosen AS (
      SELECT *, {shard_sql(tree)} AS shard, {shard_sql(grown(tree, shards))} AS grown_shard,
             xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes),
                 lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS text_crc32
      FROM placed, crc
    )
    SELECT doc_id, size, text_crc32, shard, grown_shard, 'key' AS law,
           row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot
    FROM chosen"""
