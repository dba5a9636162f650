"""Sharding by a hierarchical weighted hash tree.

A key descends region, rack and shard. At each level every child draws -ln(u) / weight with u from a hash of
key and child, and the least draw wins, so that a child gets keys in proportion to its weight and a changed
weight moves keys only into or out of that child's subtree. The first 16 shards stand in 4 regions of 2 racks
of 2 shards. Each further shard stands in a region of its own with weight 1: all older draws stay as they are,
and a key moves only if the new region wins, which means into the new shard. So the law is `key`: doc_id and
the number of shards decide. Below 16 shards the tree has fewer racks and regions, so one more shard changes weights
inside a rack and moves keys within it as well. Draws that are equal go to the first child.

Null texts have no bytes and the crc32 of the empty text. Rows with a null doc_id have one key, that of the
text `null`. Repeated rows go to the same shard and get slots of their own. Slots number the rows of a shard
from 0 by (doc_id, crc, size), nulls first. An empty table gives no rows. Texts of any
length count with all their bytes. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import with_position

BASE = (4, 2, 2)


@dataclass(frozen=True)
class Node:
    """A subtree: its name (what draws are made from), its weight, and its children or its shard."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def tree(shards: int, weights: dict[int, float] | None = None) -> tuple[Node, ...]:
    """The regions of a tree of so many shards; weights: of shards, 1 by default, 0 empties one."""
    weights = weights or {}
    per_rack, per_region = BASE[2], BASE[1] * BASE[2]
    leaf = lambda s: Node(f"s{s}", float(weights.get(s, 1.0)), (), s)

    def inner(name: str, children: list[Node]) -> Node:
        return Node(name, sum(c.weight for c in children), tuple(children))

    regions = []
    base = min(shards, BASE[0] * per_region)
    for g in range(0, base, per_region):
        racks = [inner(f"k{r // per_rack}", [leaf(s) for s in range(r, min(r + per_rack, base))]) for r in range(g, min(g + per_region, base), per_rack)]
        regions.append(inner(f"g{g // per_region}", racks))
    for s in range(base, shards):
        regions.append(inner(f"x{s}", [inner(f"y{s}", [leaf(s)])]))
    return tuple(n for n in regions if n.weight > 0)


def draw(key: Column, node: Node) -> Column:
    """-ln(u) / weight, u in (0, 1) from 52 bits of an MD5."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(node.name + ":"), key)), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(2.0**52)) / F.lit(node.weight)


def place(key: Column, nodes: tuple[Node, ...]) -> Column:
    """The shard that a key descends to."""
    nodes = tuple(n for n in nodes if n.weight > 0)
    if not nodes:
        raise ValueError("no child has weight")
    inside = [F.lit(n.shard) if n.shard is not None else place(key, n.children) for n in nodes]
    if len(nodes) == 1:
        return inside[0]
    draws = F.array(*[draw(key, n) for n in nodes])
    return _choose(draws, inside)


def _choose(draws: Column, inside: list[Column]) -> Column:
    """inside at the least draw, the first of equal ones; the draws are worked out once, as a lambda's variable."""
    at = F.transform(F.array(draws), lambda d: F.array_position(d, F.array_min(d)))[0]
    out = inside[-1]
    for i in range(len(inside) - 2, -1, -1):
        out = F.when(at == i + 1, inside[i]).otherwise(out)
    return out


def shard_documents(documents: DataFrame, shards: int = 16, grow: bool = True) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (with one more shard; null unless grow)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    placed = rows.withColumns({"shard": place(key, tree(shards)).cast("int"), "grown_shard": place(key, tree(shards + 1)).cast("int") if grow else F.lit(None).cast("int")})
    ranked = with_position(placed, ["shard"], ["doc_id", "text_crc32", "size"], "shards")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("_pos").cast("long").alias("slot"), "grown_shard")


def _sql_place(nodes: tuple[Node, ...]) -> str:
    """place() in DuckDB's SQL."""
    if len(nodes) == 1:
        return str(nodes[0].shard) if nodes[0].shard is not None else _sql_place(nodes[0].children)
    draws = ", ".join(f"-ln((CAST('0x' || substr(md5('{n.name}:' || k), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) / {n.weight}" for n in nodes)
    arms = " ".join(f"WHEN {i + 1} THEN {n.shard if n.shard is not None else _sql_place(n.children)}" for i, n in enumerate(nodes))
    return f"CASE list_position([{draws}], list_min([{draws}])) {arms} END"


def oracle(shards: int = 16) -> str:
    """shard_documents() in DuckDB's SQL. It has no crc32: that is folded from the bytes by a table of 256 steps."""
    return f"""
WITH steps AS (SELECT list(v ORDER BY i) AS step FROM (
    SELECT i, list_reduce([CAST(i AS UBIGINT)] || [CAST(0 AS UBIGINT) FOR k IN range(8)], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v FROM (SELECT unnest(range(256)) AS i))),
r AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, size, {_sql_place(tree(shards))} AS shard, {_sql_place(tree(shards + 1))} AS grown_shard,
             CAST(xor(list_reduce([CAST(4294967295 AS UBIGINT)] || list_transform(regexp_extract_all(h, '..'), lambda x: CAST('0x' || x AS UBIGINT)),
                 lambda a, b: xor(a // 256, step[CAST(xor(a, b) % 256 AS BIGINT) + 1])), 4294967295) AS BIGINT) AS text_crc32 FROM r, steps)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard FROM p"""
