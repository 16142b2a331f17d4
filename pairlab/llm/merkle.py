"""Merkle manifest of a table: an append log of tree nodes in postorder, and proofs read from it by position.

Rows are leaves, in order within their group; every ``FANOUT`` consecutive nodes become one node of the next level until
one is left, the group's subroot; subroots in group order become the root in the same way. Aligned builders, one per
block of FANOUT^LEVELS nodes, write their nodes in the order of completion: children before parents. Subtree sizes give
each node's place in its group's log in closed form, so a sibling is addressed without a search.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from pairlab.llm.arrow import stored

FANOUT = 8
LEVELS = 4
BLOCK = FANOUT**LEVELS
# Powers of the fanout as far as a count of rows can reach.
POWERS = [FANOUT**k for k in range(21)]
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def height(n: int) -> int:
    """Levels above the leaves of a tree with ``n`` leaves."""
    return next(k for k, size in enumerate(POWERS) if size >= n)


def position(level: int, index, n: int):
    """Place (from 0) of a node in the postorder of a tree with ``n`` leaves.

    Up to the node's last leaf, a level at or below its own has all its nodes that end there complete, the levels above
    only those that ended before.
    """
    end = np.minimum((index + 1) * POWERS[level], n)
    below = sum(-(-end // POWERS[k]) for k in range(level + 1))
    above = sum((end - 1) // POWERS[k] for k in range(level + 1, height(n) + 1))
    return below + above - 1


def position_column(level: str, index: str, n: str) -> Column:
    """The same of columns."""
    end = f"least(({index} + 1) * {_power(level)}, {n})"
    terms = [
        f"CASE WHEN {k} <= {level} THEN ({end} + {p - 1}L) div {p}L WHEN {POWERS[max(k - 1, 0)]}L < {n} THEN ({end} - 1) div {p}L"
        " ELSE 0L END"
        for k, p in enumerate(POWERS)
    ]
    return F.expr(" + ".join(terms) + " - 1")


def _power(level: str) -> str:
    return f"element_at(array({', '.join(f'{p}L' for p in POWERS)}), {level} + 1)"


def joined_hash(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hash of the fields, each ``-`` if null, else its length in bytes, a colon and its text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]), 256)


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows (g, id, leaf, salt, ...) with their index in their group, in the order of (id, leaf), and the group's size n.

    Rows are dealt by range, numbered in a stream within their partition, and moved up by what the partitions before hold:
    one count per partition and group. Equal rows are told apart by ``salt`` only to spread them.
    """
    order = ["g", "id", "leaf", "salt"]
    schema = rows.select("*", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("local")).schema
    names = [f.name for f in schema]
    at = names.index("g")

    def number(batches):
        part, before, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(at).to_numpy(zero_copy_only=False)
            fresh = np.concatenate([[groups[0] != before], groups[1:] != groups[:-1]])
            index = np.arange(len(groups))
            local = index - np.maximum.accumulate(np.where(fresh, index, -count))
            before, count = groups[-1], int(local[-1]) + 1
            added = [pa.array(np.full(len(groups), part)), pa.array(local)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, schema), "leaves")
    counts = placed.groupBy("g", "part").agg((F.max("local") + 1).alias("size")).selectExpr(
        "g", "part", "sum(size) OVER (PARTITION BY g ORDER BY part) - size AS start", "sum(size) OVER (PARTITION BY g) AS n"
    )
    return placed.join(stored(counts, "starts"), ["g", "part"]).selectExpr(
        *[n for n in names if n not in ("part", "local", "salt")], "start + local AS index", "n"
    )


NODE = "g string, level int, index long, position long, digest string, n long"


def _build(level: int):
    """The builder of a block of nodes of ``level``: all nodes above them, as far as the block reaches."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("index")
        g, n = table.column("g")[0].as_py(), table.column("n")[0].as_py()
        nodes, first = table.column("digest").to_pylist(), table.column("index")[0].as_py()
        rows: list[tuple] = []
        for k in range(level + 1, min(level + LEVELS, height(n)) + 1):
            nodes = [joined_hash(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
            first //= FANOUT
            index = first + np.arange(len(nodes))
            rows += zip([k] * len(nodes), index.tolist(), position(k, index, n).tolist(), nodes)
        rows.sort(key=lambda r: r[2])
        levels, indexes, places, digests = zip(*rows) if rows else ((),) * 4
        return pa.table({
            "g": pa.array([g] * len(rows), pa.string()), "level": pa.array(levels, pa.int32()),
            "index": pa.array(indexes, pa.int64()), "position": pa.array(places, pa.int64()),
            "digest": pa.array(digests, pa.string()), "n": pa.array([n] * len(rows), pa.int64()),
        })

    return build


def _height_column(n: str = "n") -> Column:
    return F.expr(" + ".join(f"int({n} > {p}L)" for p in POWERS))


def append_log(leaves: DataFrame) -> DataFrame:
    """Inner nodes (g, level, index, position, digest, n) of the trees over numbered leaves (g, index, leaf, n).

    Each round builds LEVELS levels, one builder per block, and hands the blocks' last nodes to the next: as many rounds
    as the largest group's height needs, each over FANOUT^LEVELS times fewer nodes.
    """
    level, rounds = 0, []
    nodes = leaves.select("g", "index", F.col("leaf").alias("digest"), "n")
    while True:
        block = F.expr(f"index div {BLOCK}").alias("block")
        made = stored(nodes.select("*", block).groupBy("g", "block").applyInArrow(_build(level), NODE), "merkle-nodes")
        rounds.append(made)
        level += LEVELS
        nodes = made.where((F.col("level") == level) & (_height_column() > level)).select("g", "index", "digest", "n")
        if not nodes.take(1):
            break
    log = rounds[0]
    for more in rounds[1:]:
        log = log.unionAll(more)
    return log


def _subroots(leaves: DataFrame, log: DataFrame) -> DataFrame:
    """(g, subroot, n)."""
    lone = leaves.where("n = 1").select("g", F.col("leaf").alias("subroot"), "n")
    return log.where(F.col("level") == _height_column()).select("g", F.col("digest").alias("subroot"), "n").unionAll(lone)


def _siblings(starts: DataFrame, nodes: DataFrame, level: int) -> DataFrame:
    """(g, start, level, index, after, digest) of the siblings on the way up from the nodes (g, start, n) of ``level``:
    ``start`` is their index, ``after`` tells on which side of the way a sibling stands. ``nodes`` are addressed by
    position."""
    levels = F.expr(f"explode(filter(sequence({level}, {len(POWERS) - 2}), k -> k < _height)) AS level")
    ways = starts.withColumn("_height", _height_column()).where(f"_height > {level}").select("*", levels)
    ways = ways.withColumn("own", F.expr(f"start div {_power(f'level - {level}')}"))
    last = f"(n - 1) div {_power('level')}"
    run = F.expr(f"sequence(own div {FANOUT} * {FANOUT}, least(own div {FANOUT} * {FANOUT} + {FANOUT - 1}, {last}))")
    asked = ways.select("*", F.explode(run).alias("index")).where("index <> own")
    asked = asked.select(
        "g", "start", "level", "index", F.expr("index > own").alias("after"), position_column("level", "index", "n").alias("position")
    )
    return asked.join(nodes.select("g", "position", "digest"), ["g", "position"])


def _ways(siblings: DataFrame) -> DataFrame:
    """(g, start, way): per level with siblings their digests before and after the way, joined."""
    found = F.array_sort(F.collect_list(F.struct("index", "after", "digest")))  # at most FANOUT - 1
    sides = siblings.groupBy("g", "start", "level").agg(found.alias("found"))

    def side(after: bool) -> Column:
        return F.array_join(F.transform(F.filter("found", lambda x: x["after"] == after), lambda x: x["digest"]), "")

    # At most one entry per level.
    entries = F.collect_list(F.struct("level", side(False).alias("before"), side(True).alias("after")))
    return sides.groupBy("g", "start").agg(entries.alias("way"))


_TEXT = ("string", pa.string())
WAY = "array<struct<level:int,before:string,after:string>>"


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (g, id, leaf, changed, index, n), ``log`` (inner nodes of all groups) and ``tops`` (g, subroot, root, the
    levels between them, the way up)."""

    leaves: DataFrame
    log: DataFrame
    tops: DataFrame


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, id_column: str = "doc_id", group_column: str = "lang",
          changed: Column | None = None) -> Manifest:
    """The trees over ``docs``. ``changed`` may give a leaf digest to hold against the tree later (null: the row's own).

    Leaves ascend by id within their group, null ids first, equal ids by their digest; equal rows are leaves each. A null
    group is a group and comes first, the others in the order of their bytes. An empty table has no trees. Only the
    named columns are read.
    """
    group = F.col(group_column).cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("g"),
        F.col(id_column).alias("id"),
        leaf_digest([F.col(f) for f in fields]).alias("leaf"),
        (F.lit(None).cast("string") if changed is None else changed).alias("changed"),
        F.monotonically_increasing_id().alias("salt"),
    )
    leaves = stored(_numbered(rows), "numbered-leaves")
    log = append_log(leaves)
    subroots = stored(_subroots(leaves, log), "subroots")
    # The subroots are the leaves of one more tree.
    upper = stored(
        _numbered(subroots.selectExpr("'' AS g", "g AS id", "subroot AS leaf", "0L AS salt")), "numbered-subroots"
    )
    above = append_log(upper)
    nodes = above.select("g", "position", "digest").unionAll(
        upper.select("g", position_column("0", "index", "n").alias("position"), F.col("leaf").alias("digest"))
    )
    ways = _ways(_siblings(upper.selectExpr("g", "index AS start", "n"), nodes, 0))
    root = _subroots(upper, above).select("subroot").scalar()
    tops = upper.withColumn("levels", _height_column()).selectExpr("id AS g", "leaf AS subroot", "levels", "index AS start")
    tops = tops.join(ways.select("start", "way"), "start", "left").select("g", "subroot", "levels", "way", root.alias("root"))
    return Manifest(leaves, log, stored(tops, "tops"))


def _entries(way: list[dict] | None, levels: Sequence[int]) -> list[tuple[str, str]]:
    found = {e["level"]: (e["before"], e["after"]) for e in way or ()}
    return [found.get(k, ("", "")) for k in levels]


def _proved(manifest: Manifest, emit, id_column: str, fields: dict[str, tuple[str, pa.DataType]]) -> DataFrame:
    """The id and ``emit(row, way, subroot, root)`` for every leaf, block by block: the siblings inside a block come from its part of
    the log, those outside are the same for the whole block and are read from the log once."""
    block = F.expr(f"index div {BLOCK}").alias("block")
    inside = manifest.log.where(F.col("level") < LEVELS).select(
        "g", F.expr(f"index div {_power(f'{LEVELS} - level')}").alias("block"), "position", "digest"
    )
    blocks = manifest.leaves.where(f"index % {BLOCK} = 0").select("g", F.expr(f"index div {BLOCK}").alias("start"), "n")
    outside = _ways(_siblings(blocks, manifest.log, LEVELS))
    context = blocks.select("g", "start").join(outside, ["g", "start"], "left").join(
        manifest.tops.withColumnRenamed("way", "upper"), "g"
    )
    names = ["g", "block", "position", "digest", "subroot", "root", "levels", "way", "upper"]
    kinds = ["string", "long", "long", "string", "string", "string", "int", WAY, WAY]
    right = context.withColumnRenamed("start", "block").withColumns(
        {"position": F.lit(None).cast("long"), "digest": F.lit(None).cast("string")}
    ).select(names).unionAll(
        inside.select([F.col(n) if n in inside.columns else F.lit(None).cast(k).alias(n) for n, k in zip(names, kinds)])
    )
    kind = manifest.leaves.schema["id"].dataType.simpleString()
    schema = ", ".join([f"`{id_column}` {kind}", *(f"{name} {sql}" for name, (sql, _) in fields.items())])

    def prove(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("index")
        n, first = left.column("n")[0].as_py(), left.column("index")[0].as_py()
        levels = height(n)
        rows = right.to_pylist()
        about = next(r for r in rows if r["position"] is None)
        at = {r["position"]: r["digest"] for r in rows}
        leaves = left.column("leaf").to_pylist()
        at.update(zip(position(0, first + np.arange(len(leaves)), n).tolist(), leaves))
        inner: list[list[tuple[str, str]]] = []
        count = len(leaves)
        for k in range(min(LEVELS, levels)):
            places = position(k, first // POWERS[k] + np.arange(count), n).tolist()
            runs = [[at[p] for p in places[i : i + FANOUT]] for i in range(0, count, FANOUT)]
            inner.append([("".join(run[:i]), "".join(run[i + 1 :])) for run in runs for i in range(len(run))])
            count = len(runs)
        rest = _entries(about["way"], range(LEVELS, levels)) + _entries(about["upper"], range(about["levels"]))
        made = [
            emit(row, [side[i // POWERS[k]] for k, side in enumerate(inner)] + rest, about["subroot"], about["root"])
            for i, row in enumerate(left.select(["leaf", "changed"]).to_pylist())
        ]
        columns = [pa.array(c, kind) for c, (_, kind) in zip(zip(*made), fields.values())]
        return pa.Table.from_arrays([left.column("id"), *columns], names=[id_column, *fields])

    leaves = manifest.leaves.select("*", block).groupBy("g", "block")
    right = right.withColumnsRenamed({"g": "_g", "block": "_block"})
    return leaves.cogroup(right.groupBy("_g", "_block")).applyInArrow(prove, schema)


def folded(digest: str, way: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf digest leads to with these siblings."""
    for before, after in way:
        digest = joined_hash((before, digest, after))
    return digest


def proofs(manifest: Manifest, id_column: str = "doc_id") -> DataFrame:
    """(id, leaf, root, way) per leaf: the siblings' digests before and after the way, from the leaf's level to the root."""

    def emit(row, way, subroot, root):
        return row["leaf"], root, [{"before": b, "after": a} for b, a in way]

    way = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    fields = {"leaf": _TEXT, "root": _TEXT, "way": ("array<struct<before:string,after:string>>", way)}
    return _proved(manifest, emit, id_column, fields)


def audit(docs: DataFrame, fields: Sequence[str] = FIELDS, id_column: str = "doc_id", group_column: str = "lang",
          changed: Column | None = None) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) per row: the proof of each leaf, and whether the
    changed digest (or the leaf's own, where that is null) still leads to the root. Edge cases: see ``build``."""
    manifest = build(docs, fields, id_column, group_column, changed)

    def emit(row, way, subroot, root):
        found = folded(row["changed"] or row["leaf"], way)
        return row["leaf"], subroot, root, joined_hash([side for pair in way for side in pair]), found, found == root

    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    return _proved(manifest, emit, id_column, dict.fromkeys(names, _TEXT) | {"verified": ("boolean", pa.bool_())})


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_cased_third(fields: Sequence[str] = FIELDS, id_column: str = "doc_id", text_column: str = "text") -> Column:
    """Leaf digests of rows whose text somebody put in lower case (A-Z): those where 3 divides the checksum of the id. A row
    without an id is never changed."""
    lowered = F.translate(F.col(text_column).cast("string"), UPPER, LOWER)
    digest = leaf_digest([lowered if f == text_column else F.col(f) for f in fields])
    return F.when(F.crc32(F.col(id_column).cast("string")) % 3 == 0, digest)
