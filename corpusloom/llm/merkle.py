"""Merkle manifest of a dataset as a persistent tree.

Leaves are hashes of rows.  Within a group (``lang``) they stand by id, and eight
neighbours become one node until one is left, the subroot; the subroots become
the root in the same way.

1. Placing.  Only hashes are shuffled.  They are range-partitioned by group, id,
   leaf and row number, so a group of any size, or one id repeated any number of
   times, is spread over tasks; each task numbers its own rows and the counts of
   the tasks before it are added.
2. Blocks.  ``8 ** 4`` neighbouring leaves are an aligned block, which one task
   folds to its top node.  The tops are the leaves of the next, smaller tree.
3. Paths.  From the root down, every block learns the siblings above its top.
4. Versions.  A changed leaf makes a version of the tree: the ancestors within its
   block are copied, all other nodes are shared with the untouched tree, and the
   copy goes on through the siblings above the block, wherever those were made,
   up to a root of its own.

Rows sent for one leaf: two digests and a few numbers, whatever the text's size.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import staged

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 8
LEVELS = 4                      # of a block
BLOCK = FANOUT**LEVELS
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

RESULT = (
    "row long, doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "changed boolean, folded_root string, verified boolean, copied array<string>"
)


def leaf_hash(columns: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the fields, each ``-`` or byte count, colon and value."""
    parts = []
    for column in columns:
        value = column.cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def group_key(column: Column) -> Column:
    """Never null; null sorts first, other values by their bytes."""
    return F.coalesce(F.concat(F.lit("v"), column.cast("string")), F.lit("n"))


def placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows (grp, ...)`` with ``pos``, the place of a row within its group."""
    keys = [F.col("grp"), *order]

    def number(batches):
        task = TaskContext.get().partitionId()
        group, run, at = None, -1, 0
        for batch in batches:
            runs, places = [], []
            for value in batch.column("grp").to_pylist():
                if value != group:
                    group, run, at = value, run + 1, 0
                runs.append(run)
                places.append(at)
                at += 1
            added = [pa.array([task] * len(runs), pa.int32()), pa.array(runs, pa.int64()),
                     pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], names=[*batch.schema.names, "task", "run", "at"]
            )

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    numbered = staged(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .mapInArrow(number, f"{types}, task int, run long, at long"),
        "numbered",
    )
    earlier = Window.partitionBy("grp").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # a group that began in an earlier task can only be the first run of this one:
    # at most one row a task
    begun = (
        numbered.groupBy("grp", "task", "run").agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(earlier))
        .filter("run = 0 and before > 0")
        .select(F.col("task").alias("in_task"), "before")
    )
    return (
        numbered.join(
            F.broadcast(begun), (F.col("task") == F.col("in_task")) & (F.col("run") == 0), "left"
        )
        .withColumn("pos", F.col("at") + F.coalesce("before", F.lit(0)))
        .drop("task", "run", "at", "in_task", "before")
    )


def digest(text: str) -> str:
    return sha256(text.encode("ascii")).hexdigest()


def block_levels(nodes: list[str], block: int) -> list[list[str]]:
    """All levels of a block, its leaves first, its top last.

    A group's only block ends with its one remaining node.  Any other block is
    folded all the way, because neighbours stand beside it on each level.
    """
    levels = [nodes]
    alone = block == 0 and len(nodes) < BLOCK
    while len(levels) <= LEVELS and not (alone and len(levels[-1]) == 1):
        last = levels[-1]
        levels.append(
            [digest("".join(last[i : i + FANOUT])) for i in range(0, len(last), FANOUT)]
        )
    return levels


def siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What stands left and right of a leaf's ancestors in their runs, bottom first."""
    found = []
    for level in levels[:-1]:
        begin = at - at % FANOUT
        found.append(("".join(level[begin:at]), "".join(level[at + 1 : begin + FANOUT])))
        at //= FANOUT
    return found


def fold_blocks(nodes: DataFrame) -> DataFrame:
    """``grp, block, top`` of ``nodes (grp, pos, node)``."""

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        block = table.column("block")[0].as_py()
        top = block_levels(table.column("node").to_pylist(), block)[-1][0]
        return pa.table({"grp": table.column("grp")[:1], "block": [block], "top": [top]})

    return (
        nodes.select("grp", "pos", "node", F.floor(F.col("pos") / BLOCK).alias("block"))
        .groupBy("grp", "block").applyInArrow(fold, "grp string, block long, top string")
    )


PATH = "array<struct<before: string, after: string>>"


def lower_paths(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``grp, pos, path``: siblings of each node from its own level up to the root.

    ``above (grp, block, upper)`` holds the paths of the blocks' tops.
    """

    def extend(table: pa.Table, over: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        levels = block_levels(table.column("node").to_pylist(), table.column("block")[0].as_py())
        rest = over.column("upper")[0].as_py()
        paths = [
            [{"before": x, "after": y} for x, y in siblings(levels, i)] + rest
            for i in range(table.num_rows)
        ]
        kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        return pa.table(
            {"grp": table.column("grp"), "pos": table.column("pos"), "path": pa.array(paths, kind)}
        )

    return (
        nodes.select("grp", "pos", "node", F.floor(F.col("pos") / BLOCK).alias("block"))
        .groupBy("grp", "block").cogroup(above.groupBy("grp", "block"))
        .applyInArrow(extend, f"grp string, pos long, path {PATH}")
    )


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Trees of ``nodes (grp, pos, node)``, smallest last: its nodes are the groups' tops."""
    floors = []
    while True:
        floors.append(nodes)
        tops = staged(fold_blocks(nodes), "tops")
        nodes = tops.select("grp", F.col("block").alias("pos"), F.col("top").alias("node"))
        if tops.filter("block > 0").limit(1).count() == 0:
            return [*floors, nodes]


def descend(floors: list[DataFrame], path: DataFrame) -> DataFrame:
    """Paths of the blocks of the lowest floor, from ``path (grp, path)`` of the tops."""
    known = path.select("grp", F.lit(0).cast("long").alias("block"), F.col("path").alias("upper"))
    for nodes in reversed(floors[1:-1]):
        known = staged(
            lower_paths(nodes, known).select(
                "grp", F.col("pos").alias("block"), F.col("path").alias("upper")
            ),
            "paths",
        )
    return known


def merkle_manifest(
    docs: DataFrame,
    changes: dict[str, Column] | None = None,
    changed: Column | None = None,
    columns: tuple[str, ...] = COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    keep_copies: bool = True,
) -> DataFrame:
    """One row per row: leaf, subroot, root, proof and the version its change makes.

    ``changes`` names new values of columns and ``changed`` the rows they are made
    in; each such row makes a version of its own.  Returns ``doc_id, leaf, subroot,
    root, proof_sha256`` of the untouched tree, ``changed``, ``folded_root`` (the
    version's root), ``verified`` (whether that is the root) and ``copied``: the
    nodes a version does not share, bottom first (empty without a change).

    Leaves of a group ascend by id, null ids last; rows with one id by their leaf;
    equal rows have equal leaves, and each has its own place.  A null group is a
    group, before all others.  Null fields are hashed as ``-``, empty and long texts
    whole.  An empty table gives no rows.  Columns not named are not read, whatever
    their names.
    """
    if changed is None:
        changed = F.lit(False)
    changed = F.coalesce(changed, F.lit(False))
    old = leaf_hash([F.col(c) for c in columns])
    new = leaf_hash([(changes or {}).get(c, F.col(c)) for c in columns])
    leaves = staged(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("doc_id"),
            group_key(F.col(group_col)).alias("grp"),
            F.unhex(old).alias("leaf"),
            F.unhex(F.when(changed, new)).alias("fresh"),
        ),
        "leaves",
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("leaf"), F.col("row")]
    rows = staged(placed(leaves, order), "placed")
    node = F.lower(F.hex("leaf"))
    floors = climb(rows.select("grp", "pos", node.alias("node")))
    subroots = floors[-1].select("grp", "node")
    # the groups are the leaves of one more tree
    listed = staged(
        placed(
            subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node"),
            [F.col("name")],
        ),
        "groups",
    )
    groups = climb(listed.select("grp", "pos", "node"))
    root = groups[-1].select("grp", F.col("node").alias("root"))
    whole = groups[-1].select("grp", F.array().cast(PATH).alias("path"))
    over = lower_paths(groups[0], descend(groups, whole))
    tops = staged(
        listed.select("grp", "pos", "name", F.col("node").alias("subroot"))
        .join(over.select("pos", "path"), "pos")
        .join(F.broadcast(root), "grp")             # one row
        .select(F.col("name").alias("grp"), "subroot", "root", "path"),
        "subroots",
    )
    paths = descend(floors, tops.select("grp", "path"))
    blocks = (
        paths.join(tops.select(F.col("grp").alias("name"), "subroot", "root"), F.col("grp") == F.col("name"))
        .drop("name")
    )

    def versions(table: pa.Table, above: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        block = table.column("block")[0].as_py()
        nodes = [x.hex() for x in table.column("leaf").to_pylist()]
        levels = block_levels(nodes, block)
        shared = [(x["before"], x["after"]) for x in above.column("upper")[0].as_py()]
        above_proof = "".join(x + y for x, y in shared)
        subroot, root = (above.column(c)[0].as_py() for c in ("subroot", "root"))
        proofs, folded, copies = [], [], []
        for at, fresh in enumerate(table.column("fresh").to_pylist()):
            path = siblings(levels, at)
            proofs.append(digest("".join(x + y for x, y in path) + above_proof))
            value, made = nodes[at] if fresh is None else fresh.hex(), []
            if value == nodes[at]:
                value = root            # nothing copied: the version is the tree itself
            else:
                for before, after in (*path, *shared):
                    value = digest(before + value + after)
                    made.append(value)
            folded.append(value)
            copies.append(made if keep_copies else [])
        size = len(nodes)
        return pa.table({
            "row": table.column("row"), "doc_id": table.column("doc_id"),
            "leaf": pa.array(nodes, pa.string()), "subroot": pa.array([subroot] * size, pa.string()),
            "root": pa.array([root] * size, pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
            "changed": pa.array([x is not None for x in table.column("fresh").to_pylist()], pa.bool_()),
            "folded_root": pa.array(folded, pa.string()),
            "verified": pa.array([x == root for x in folded], pa.bool_()),
            "copied": pa.array(copies, pa.list_(pa.string())),
        })

    return (
        rows.withColumn("block", F.floor(F.col("pos") / BLOCK))
        .groupBy("grp", "block").cogroup(blocks.groupBy("grp", "block"))
        .applyInArrow(versions, RESULT).drop("row")
    )


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())
