"""Merkle manifest of a table: one tree for each group, one over the groups' roots, and proofs that fold from kept hash states.

A node over up to `RUN` children keeps a copy of its hash state before each child's slot. To replace a child, the copy at its slot goes on
with the replacement and the siblings to its right; what lies to the left is never hashed again.

Trees are built in blocks of `RUN ** LEVELS` neighbouring leaves, one task call a block, and the block roots are the leaves of the next round: a
group of any size needs a few rounds, and no task sees more than a block. Then paths travel down: the root's block tells each
block below the siblings above it, until every leaf folds its own path. Only digests move; texts are hashed where they are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rangehaul.llm.ranking import placed
from rangehaul.llm.store import written

RUN = 8
LEVELS = 4
_RUN_BITS = 3
_DIGEST = 64


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Hash of values in order: `-` for null, else byte count, colon and value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def height(leaves: int) -> int:
    """Levels above so many leaves; a lone leaf has none."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // RUN), levels + 1
    return levels


class Level(NamedTuple):
    """Nodes of one level, the states that their parents keep before each of them, and the siblings on their right and all around."""

    digests: list[bytes]
    states: list
    right: list[bytes]
    others: list[bytes]


def levels(digests: list[bytes], count: int) -> tuple[list[Level], list[bytes]]:
    """`count` levels from the given nodes up, and the nodes above them."""
    found = []
    for _ in range(count):
        level, parents = Level(digests, [], [], []), []
        for low in range(0, len(digests), RUN):
            run, state = digests[low : low + RUN], sha256()
            for slot, child in enumerate(run):
                level.states.append(state.copy())
                level.right.append(b"".join(run[slot + 1 :]))
                level.others.append(b"".join(run[:slot]) + level.right[-1])
                state.update(child)
            parents.append(state.hexdigest().encode())
        found.append(level)
        digests = parents
    return found, digests


class Step(NamedTuple):
    """A level above a block: the parent's state before the slot, the siblings on the right, and all siblings."""

    state: object
    right: bytes
    others: bytes


def resumed(digest: bytes, state, right: bytes) -> bytes:
    state = state.copy()
    state.update(digest)
    state.update(right)
    return state.hexdigest().encode()


def _packed(path: list[tuple[int, bytes]]) -> bytes:
    """Siblings of each level as raw digests, behind their number on the left and in all."""
    return b"".join(bytes([left, len(others) // _DIGEST]) + bytes.fromhex(others.decode()) for left, others in path)


def _path(packed: bytes) -> list[tuple[int, bytes]]:
    at, path = 0, []
    while at < len(packed):
        left, count = packed[at], packed[at + 1]
        at += 2 + 32 * count
        path.append((left, packed[at - 32 * count : at].hex().encode()))
    return path


def _steps(packed: bytes) -> list[Step]:
    return [Step(sha256(others[: left * _DIGEST]), others[left * _DIGEST :], others) for left, others in _path(packed)]


def _ordered(table: pa.Table, most: int) -> tuple[pa.Table, list[bytes], int]:
    table = table.sort_by("at")
    return table, [d.encode() for d in table.column("digest").to_pylist()], min(most, height(table.column("size")[0].as_py()))


def _lifted(group: str, most: int):
    """A block's root: the node of the next round."""

    def run(table: pa.Table) -> pa.Table:
        table, digests, count = _ordered(table, most)
        _, (top,) = levels(digests, count)
        at, size = (table.column(c)[0].as_py() for c in ("at", "size"))
        own = [table.column(group).slice(0, 1).combine_chunks(), pa.array([at // RUN**most], pa.int64()), pa.array([-(-size // RUN**most)], pa.int64()), pa.array([top.decode()])]
        return pa.table(own, names=[group, "at", "size", "digest"])

    return run


def _lowered(group: str, most: int):
    """Paths of a block's nodes: their own siblings, then the block's path."""

    def run(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, digests, count = _ordered(nodes, most)
        found, _ = levels(digests, count)
        rest = above.column("path")[0].as_py()
        first, paths = nodes.column("at")[0].as_py(), []
        for i in range(len(digests)):
            own, at = [], i
            for level in found:
                own.append((at % RUN, level.others[at]))
                at //= RUN
            paths.append(_packed(own) + rest)
        columns = [pa.array(range(first, first + len(digests)), pa.int64()), pa.array(paths, pa.binary())]
        return pa.table([nodes.column(group), *columns, *(pa.repeat(above.column(c)[0], len(digests)) for c in ("subroot", "root"))], names=[group, "at", "path", "subroot", "root"])

    return run


def _proven(schema: pa.Schema, most: int):
    """What each leaf of a block proves, folded from the states that its ancestors keep."""

    def run(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, digests, count = _ordered(nodes, most)
        found, _ = levels(digests, count)
        steps = _steps(above.column("path")[0].as_py())
        upper = b"".join(s.others for s in steps)
        subroot, root = (above.column(c)[0].as_py() for c in ("subroot", "root"))
        folded, proofs = [], []
        for i, changed in enumerate(nodes.column("changed").to_pylist()):
            digest, proof, at = digests[i] if changed is None else changed.encode(), sha256(), i
            for level in found:
                proof.update(level.others[at])
                digest = resumed(digest, level.states[at], level.right[at])
                at //= RUN
            for step in steps:
                digest = resumed(digest, step.state, step.right)
            proof.update(upper)
            folded.append(digest.decode())
            proofs.append(proof.hexdigest())
        size = len(digests)
        own = {"leaf": nodes.column("digest"), "subroot": pa.repeat(pa.scalar(subroot), size), "root": pa.repeat(pa.scalar(root), size), "proof_sha256": pa.array(proofs), "folded_root": pa.array(folded), "verified": pa.array([f == root for f in folded])}
        return pa.table([own[f.name] if f.name in own else nodes.column(f.name).cast(f.type) for f in schema], schema=schema)

    return run


def _block(group: str, most: int) -> list[Column]:
    return [F.col(group), F.shiftright("at", _RUN_BITS * most).alias("block")]


def _rounds(nodes: DataFrame, group: str, name: str, most: int) -> list[DataFrame]:
    """The nodes of each round, from the given leaves to one node a group."""
    kind = nodes.schema[group].dataType.simpleString()
    size = nodes.agg(F.max("size").alias("n")).first()["n"] or 1
    found = [nodes]
    for k in range(-(-height(size) // most)):
        up = found[-1].select(group, "at", "size", "digest").groupBy(*_block(group, most)).applyInArrow(_lifted(group, most), f"{group} {kind}, at long, size long, digest string")
        found.append(written(up, f"{name}-{k + 1}"))
    return found


def _down(rounds: list[DataFrame], top: DataFrame, group: str, most: int) -> DataFrame:
    """Paths for the nodes of the first of these rounds, from those of the nodes above the last (`group`, `at`, `path`, `subroot`, `root`)."""
    kind = top.schema[group].dataType.simpleString()
    for nodes in reversed(rounds):
        below = nodes.select(group, "at", "size", "digest").groupBy(*_block(group, most))
        top = below.cogroup(top.groupBy(group, F.col("at").alias("block"))).applyInArrow(_lowered(group, most), f"{group} {kind}, at long, path binary, subroot string, root string")
    return top


def merkle_manifest(rows: DataFrame, key: str, group: str, leaf: Column, changed: Column | None = None, block_levels: int = LEVELS) -> DataFrame:
    """Roots and proofs of all rows: `key`, `leaf`, `subroot` (of the row's group), `root`, `proof_sha256`, `folded_root`, `verified`.

    `leaf` is the hex digest of a row; where `changed` is not null it takes the leaf's place when the row's path is folded, so that
    `verified` tells whether the row is still what the manifest says. Leaves stand by `key` inside a group; groups in byte order.
    `block_levels` is how many levels one task call builds. A run of nodes hashes the hex digests of its children, even if it has one; a lone leaf is its group's root, and a lone group's root the root.

    - null keys come first in their group, and null is a group of its own, before all others;
    - rows of one key stand by their leaf; equal rows take neighbouring places, each with its own proof;
    - nulls in hashed columns are told from empty texts by `leaf_digest`; long texts are hashed where they are read;
    - an empty table gives an empty result; other columns are ignored.
    """
    leaves = rows.select(F.col(key).alias("key"), F.col(group).alias("grp"), leaf.alias("digest"), (changed if changed is not None else F.lit(None).cast("string")).alias("changed"))
    trees = _rounds(placed(leaves, "grp", ["key", "digest"], "leaves"), "grp", "tree", block_levels)
    subroots = trees[-1].select(F.lit(0).alias("crown"), F.col("grp"), "digest")
    crown = _rounds(placed(subroots, "crown", ["grp"], "subroots"), "crown", "crown", block_levels)
    root = crown[-1].select("crown", "at", F.lit(b"").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    paths = _down(crown[:-1], root, "crown", block_levels).withColumnRenamed("at", "seat")
    tops = crown[0].join(paths, F.col("at") == F.col("seat")).select("grp", F.lit(0).cast("long").alias("at"), "path", F.col("digest").alias("subroot"), "root")
    above = _down(trees[1:-1], tops, "grp", block_levels)
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = T.StructType([T.StructField("key", rows.schema[key].dataType), *(T.StructField(n, T.StringType()) for n in names), T.StructField("verified", T.BooleanType())])
    nodes = trees[0].select("key", "grp", "at", "size", "digest", "changed").groupBy(*_block("grp", block_levels))
    found = nodes.cogroup(above.groupBy("grp", F.col("at").alias("block"))).applyInArrow(_proven(to_arrow_schema(schema), block_levels), schema)
    return found.withColumnRenamed("key", key)
