"""Merkle manifest of a table in van Emde Boas layout.

Every row is a leaf digest.  The leaves of a group (a language) are put in
order and cut into aligned blocks of BRANCH ** BLOCK_LEVELS leaves; a block is
a subtree that one task builds and stores as one array.  Inside the array a
tree of h levels is split at half its height: the top tree comes first, then
the bottom trees in order, each laid out likewise.  ``address`` is that
layout's arithmetic for a node's depth and index; construction and the
retrieval of siblings use nothing else, so a path from a leaf upwards stays in
few neighbouring pieces whatever the size of a cache line or page.  The roots
of the blocks are the leaves of the next tier of blocks, until a group has one
root (``subroot``); the subroots of all groups are the leaves of a last tree,
which gives ``root``.

A leaf's proof is the digests of its siblings, level by level up to the root.
What lies above a block is the same for all of its leaves, so that part
travels once a block, not once a leaf.

Blocks bound every task; the number of a leaf comes from ranges of the order
(``common.numbered``), so a language with most rows is spread over its blocks.
Only the root, 64 characters, reaches the driver.

Defined results: null fields are `-` in a leaf, a null group comes first; rows
of one id are ordered by leaf digest, null ids first, and every repeated row
is a leaf of its own; a leaf without siblings has the digest of the empty text
as its proof; extra columns are ignored; an empty table gives no rows; very
long texts are hashed where they lie and never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import sql
from footfall.llm.common import ascii_lower, field_text, numbered, stored, table

BRANCH = 8
BLOCK_LEVELS = 4              # levels of edges in a block: 4,096 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WIDTH = 64                    # hex digits of a digest


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


# --- the layout -------------------------------------------------------------

def nodes_in(levels: int, branch: int = BRANCH) -> int:
    """Nodes of a full tree with that many levels of nodes."""
    return (branch ** levels - 1) // (branch - 1)


def address(levels: int, depth: int, index: np.ndarray, branch: int = BRANCH) -> np.ndarray:
    """Places of the nodes ``index`` of a depth (the root has 0) in the layout
    of a tree of ``levels`` levels of nodes."""
    if levels == 1:
        return np.zeros(len(index), np.int64)
    top = levels // 2
    if depth < top:
        return address(top, depth, index, branch)
    span = branch ** (depth - top)
    below = levels - top
    return (nodes_in(top, branch) + index // span * nodes_in(below, branch)
            + address(below, depth - top, index % span, branch))


@lru_cache(maxsize=64)
def _level(levels: int, depth: int, count: int, branch: int) -> np.ndarray:
    return address(levels, depth, np.arange(count), branch)


@dataclass
class Block:
    """One subtree: ``nodes`` in van Emde Boas layout, ``leaves`` of them at
    depth ``levels - 1``."""
    levels: int
    leaves: int
    nodes: np.ndarray
    branch: int = BRANCH

    @classmethod
    def build(cls, leaves: np.ndarray, levels: int, branch: int = BRANCH) -> Block:
        m = len(leaves)
        nodes = np.zeros(nodes_in(levels, branch), f"S{WIDTH}")
        nodes[_level(levels, levels - 1, m, branch)] = leaves
        block = cls(levels, m, nodes, branch)
        for depth in range(levels - 2, -1, -1):
            raw = nodes[_level(levels, depth + 1, block.count(depth + 1), branch)].tobytes()
            run = WIDTH * branch
            nodes[_level(levels, depth, block.count(depth), branch)] = [
                digest(raw[a:a + run]) for a in range(0, len(raw), run)]
        return block

    @classmethod
    def load(cls, levels: int, leaves: int, data: bytes, branch: int = BRANCH) -> Block:
        nodes = np.zeros(nodes_in(levels, branch), f"S{WIDTH}")
        used = np.frombuffer(data, f"S{WIDTH}")
        nodes[:len(used)] = used
        return cls(levels, leaves, nodes, branch)

    def dump(self) -> bytes:
        """The array up to its last used place."""
        return self.nodes[:int(np.flatnonzero(self.nodes != b"")[-1]) + 1].tobytes()

    @property
    def root(self) -> bytes:
        return bytes(self.nodes[0])

    def count(self, depth: int) -> int:
        return -(-self.leaves // self.branch ** (self.levels - 1 - depth))

    def siblings(self, depth: int) -> list[tuple[bytes, bytes]]:
        """For every node of a depth the siblings before it and after it in
        its run, concatenated."""
        raw = self.nodes[_level(self.levels, depth, self.count(depth), self.branch)].tobytes()
        run = WIDTH * self.branch
        return [(raw[at - at % run:at], raw[at + WIDTH:at - at % run + run]) for at in range(0, len(raw), WIDTH)]

    def paths(self, above: list[tuple[bytes, bytes]]) -> Iterator[tuple[int, list[tuple[bytes, bytes]]]]:
        """(first leaf, steps above its run) for every run of leaves, the
        steps ``above`` the block included; the leaf's own step comes before."""
        steps: list[list[tuple[bytes, bytes]]] = [above]
        for depth in range(1, self.levels - 1):
            steps = [[s, *steps[i // self.branch]] for i, s in enumerate(self.siblings(depth))]
        for run in range(0, self.leaves, self.branch):
            yield run, steps[run // self.branch if self.levels > 1 else 0]


def levels_of(total: int, block_levels: int, branch: int) -> int:
    """Levels of nodes of a group's blocks: full ones, unless the group's
    nodes fit in one block, which ends where a single node remains."""
    levels = 1
    while total > 1 and levels <= block_levels:
        total, levels = -(-total // branch), levels + 1
    return levels


# --- the tree in Spark ------------------------------------------------------

def _blocked(rows: DataFrame, size: int) -> DataFrame:
    """Numbered rows (g, start, n, total, ...) as rows inside one block each:
    block, first leaf there, leaves there (n)."""
    cut = rows.withColumn("block", F.explode(F.expr(f"sequence(start div {size}, (start + n - 1) div {size})")))
    return (cut.withColumn("first", F.greatest(F.col("start"), F.col("block") * size) - F.col("block") * size)
            .withColumn("n", F.least(F.col("start") + F.col("n"), (F.col("block") + 1) * size)
                        - F.col("block") * size - F.col("first")).drop("start"))


def _build_blocks(leaves: DataFrame, block_levels: int, branch: int) -> DataFrame:
    """One row a block of (g, block, first, n, total, leaf) rows."""

    def build(rows: pa.Table) -> pa.Table:
        first, n = rows["first"].to_numpy(), rows["n"].to_numpy()
        order = np.argsort(first, kind="stable")
        digests = np.repeat(np.array(rows["leaf"].to_pylist(), f"S{WIDTH}")[order], n[order])
        total = rows["total"][0].as_py()
        block = Block.build(digests, levels_of(total, block_levels, branch), branch)
        return pa.table({"g": rows["g"].slice(0, 1), "block": rows["block"].slice(0, 1), "total": pa.array([total], pa.int64()),
                         "leaves": pa.array([block.leaves], pa.int32()), "nodes": pa.array([block.dump()], pa.binary()),
                         "root": pa.array([block.root.decode()])})

    return (leaves.select("g", "block", "first", "n", "total", "leaf").groupBy("g", "block")
            .applyInArrow(build, "g string, block bigint, total bigint, leaves int, nodes binary, root string"))


def _tiers(leaves: DataFrame, block_levels: int, branch: int) -> list[DataFrame]:
    """Tables of blocks, from the leaves' tier to the one where every group
    that still has several nodes ends in one block."""
    size = branch ** block_levels
    tiers = [stored(_build_blocks(leaves, block_levels, branch), "merkle-blocks")]
    most = tiers[0].agg(F.max("total")).first()[0] or 0
    while most > size:
        most = -(-most // size)
        up = tiers[-1].where(F.col("total") > size).select(
            "g", F.col("block").alias("start"), F.lit(1).cast("bigint").alias("n"),
            F.expr(f"(total + {size - 1}) div {size}").alias("total"), F.col("root").alias("leaf"))
        tiers.append(stored(_build_blocks(_blocked(up, size), block_levels, branch), "merkle-blocks"))
    return tiers


def _tops(tiers: list[DataFrame], size: int) -> DataFrame:
    """(g, root) of the groups."""
    tops = [t.where(F.col("total") <= size).select("g", "root") for t in tiers]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


STEPS = "lefts array<binary>, rights array<binary>"


def _block_of(blocks: pa.Table, row: int, block_levels: int, branch: int) -> tuple[Block, list[tuple[bytes, bytes]]]:
    get = lambda name: blocks[name][row].as_py()
    block = Block.load(levels_of(get("total"), block_levels, branch), get("leaves"), get("nodes"), branch)
    return block, list(zip(get("lefts"), get("rights")))


def _steps_below(blocks: DataFrame, block_levels: int, branch: int) -> DataFrame:
    """(g, block, lefts, rights): for every leaf of blocks (with the steps
    above them) all steps up to the root; leaves are numbered in their group."""
    size = branch ** block_levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.table(batch)
            for k in range(rows.num_rows):
                block, above = _block_of(rows, k, block_levels, branch)
                first = rows["block"][k].as_py() * size
                own = block.siblings(block.levels - 1) if block.levels > 1 else None
                for run_, upper in block.paths(above):
                    at = range(run_, min(run_ + branch, block.leaves))
                    steps = [upper if own is None else [own[i], *upper] for i in at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rows["g"][k].as_py()] * len(steps), pa.string()), pa.array([first + i for i in at], pa.int64()),
                         pa.array([[x for x, _ in s] for s in steps], pa.list_(pa.binary())),
                         pa.array([[x for _, x in s] for s in steps], pa.list_(pa.binary()))],
                        names=["g", "block", "lefts", "rights"])

    return blocks.select("g", "block", "total", "leaves", "nodes", "lefts", "rights").mapInArrow(
        run, f"g string, block bigint, {STEPS}")


def _with_steps(tiers: list[DataFrame], above: DataFrame, block_levels: int, branch: int) -> DataFrame:
    """The lowest tier's blocks with all steps above them; ``above`` has those
    above each group's root (g, lefts, rights)."""
    size = branch ** block_levels
    below = None
    for tier in reversed(tiers):
        top = tier.where(F.col("total") <= size).join(above, "g")
        if below is not None:
            lower = tier.where(F.col("total") > size).join(below, ["g", "block"])
            top = top.unionByName(lower)
        if tier is tiers[0]:
            return top
        below = stored(_steps_below(top, block_levels, branch), "merkle-steps")


@dataclass
class Manifest:
    """The stored tree: ``leaves`` by block, ``tiers`` of blocks with their
    arrays, ``groups`` (g, subroot, steps above the subroot) and the root."""
    leaves: DataFrame
    tiers: list[DataFrame]
    groups: DataFrame
    root: str | None
    block_levels: int
    branch: int

    def blocks(self) -> DataFrame:
        """The lowest blocks with the steps above them and their subroot."""
        rows = _with_steps(self.tiers, self.groups.select("g", "lefts", "rights"), self.block_levels, self.branch)
        return rows.join(self.groups.select("g", "subroot"), "g")


def manifest(leaves: DataFrame, group: str, order: list[str], block_levels: int = BLOCK_LEVELS,
             branch: int = BRANCH) -> Manifest:
    """Tree over ``leaves`` (column ``leaf``, ``n`` for the rows that an equal
    row stands for, any others): ``group`` gives the subtrees, ``order`` and
    then the digest the place in them."""
    size = branch ** block_levels
    g = F.when(F.col(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    placed = numbered(leaves.withColumn("g", g), ["g"], [*order, "leaf"], "merkle-leaves")
    placed = stored(_blocked(placed, size), "merkle-leaves")
    tiers = _tiers(placed, block_levels, branch)
    one = _tops(tiers, size).select(F.lit("").alias("all"), F.col("g").alias("of"), F.col("root").alias("leaf"),
                                    F.lit(1).cast("bigint").alias("n"))
    tops = numbered(one.withColumnRenamed("all", "g"), ["g"], ["of"], "merkle-subroots")
    tops = stored(_blocked(tops, size), "merkle-subroots")
    upper = _tiers(tops, block_levels, branch)
    root = _tops(upper, size).first()
    none = _tops(upper, size).select("g", F.expr("from_json('[]', 'array<binary>')").alias("lefts"),
                                     F.expr("from_json('[]', 'array<binary>')").alias("rights"))
    steps = _steps_below(_with_steps(upper, none, block_levels, branch), block_levels, branch)
    groups = tops.select(F.col("of"), (F.col("block") * size + F.col("first")).alias("block"), F.col("leaf").alias("subroot"))
    groups = stored(groups.join(steps.drop("g"), "block").select(F.col("of").alias("g"), "subroot", "lefts", "rights"), "merkle-groups")
    return Manifest(placed, tiers, groups, root["root"] if root else None, block_levels, branch)


def proofs(tree: Manifest, id_col: str, changed_col: str) -> DataFrame:
    """One row a leaf with the digest of its proof and the root that folding
    ``changed_col`` (the digest as found now) with the proof gives."""
    block_levels, branch, root = tree.block_levels, tree.branch, tree.root
    kind = tree.leaves.schema[id_col].dataType.simpleString()
    own_columns = tree.leaves.select("g", "block", "first", "n", F.col(id_col).alias("doc_id"), "leaf",
                                     F.col(changed_col).alias("changed"))

    def check(rows: pa.Table, blocks: pa.Table) -> pa.Table:
        block, above = _block_of(blocks, 0, block_levels, branch)
        subroot = blocks["subroot"][0].as_py()
        first, n = rows["first"].to_numpy(), rows["n"].to_numpy()
        order = np.argsort(first, kind="stable")
        rows = rows.take(pa.array(np.repeat(order, n[order])))
        changed = rows["changed"].to_pylist()
        own = block.siblings(block.levels - 1) if block.levels > 1 else None
        found, folded = [], []
        for run, upper in block.paths(above):
            rest = b"".join(a + b for a, b in upper)
            for i in range(run, min(run + branch, block.leaves)):
                steps = upper if own is None else [own[i], *upper]
                found.append(hashlib.sha256(b"" if own is None else own[i][0] + own[i][1]))
                found[-1].update(rest)
                h = changed[i].encode()
                for a, b in steps:
                    h = digest(a + h + b)
                folded.append(h.decode())
        return pa.table({"doc_id": rows["doc_id"], "leaf": rows["leaf"], "subroot": pa.array([subroot] * len(folded)),
                         "root": pa.array([root] * len(folded)), "proof_sha256": pa.array([x.hexdigest() for x in found]),
                         "folded_root": pa.array(folded), "verified": pa.array([x == root for x in folded])})

    return (own_columns.groupBy("g", "block").cogroup(tree.blocks().groupBy("g", "block"))
            .applyInArrow(check, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                                 "folded_root string, verified boolean"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaf digests of ``documents`` rows, equal rows counted: ``leaf`` and
    ``changed``, the digest of the row as tampering leaves it."""
    def leaf(d: DataFrame) -> DataFrame:
        return d.withColumn("_leaf", F.sha2(F.concat(*[field_text(c) for c in FIELDS]).cast("binary"), 256))

    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = leaf(docs.select(*FIELDS)).withColumnRenamed("_leaf", "leaf")
    rows = leaf(rows.withColumn("_hit", F.coalesce(picked, F.lit(False)))
                .withColumn("text", F.when(F.col("_hit"), ascii_lower(F.col("text"))).otherwise(F.col("text"))))
    rows = rows.select("doc_id", "lang", "leaf", F.when(F.col("_hit"), F.col("_leaf")).otherwise(F.col("leaf")).alias("changed"))
    return rows.groupBy("doc_id", "lang", "leaf", "changed").agg(F.count("*").alias("n"))


def query(spark, sf_dir):
    tree = manifest(document_leaves(table(spark, sf_dir, "documents")), "lang", ["doc_id"])
    return proofs(tree, "doc_id", "changed")


# --- the same in SQL --------------------------------------------------------

SQL_LEVELS = 8                # 8 ** 8 leaves a language, and as many languages


def _climb(prefix: str, leaves: str, levels: int) -> str:
    """CTEs {prefix}0 ... with (g, i, h, total) by level: while several nodes
    of g remain, runs of 8 become one."""
    out = [f"{prefix}0 AS (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS total FROM {leaves})"]
    for k in range(levels):
        out.append(f"""{prefix}{k + 1} AS (
    SELECT g, i // 8 AS i, CASE WHEN any_value(total) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h,
           (any_value(total) + 7) // 8 AS total FROM {prefix}{k} GROUP BY g, i // 8)""")
    return ",\n".join(out)


def _fold(prefix: str, rows: str, levels: int) -> str:
    """CTEs {prefix}f1 ... that add a level's siblings to proof and fold."""
    out = []
    for k in range(levels):
        out.append(f"""{prefix}s{k} AS (
    SELECT g, i, total, coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
           coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
    FROM {prefix}{k}),
{prefix}f{k + 1} AS (
    SELECT f.* REPLACE (f.i // 8 AS i, CASE WHEN s.total > 1 THEN proof || s.a || s.b ELSE proof END AS proof,
                        CASE WHEN s.total > 1 THEN sha256(s.a || now || s.b) ELSE now END AS now)
    FROM {rows if k == 0 else f"{prefix}f{k}"} f JOIN {prefix}s{k} s ON s.g = f.g AND s.i = f.i)""")
    return ",\n".join(out)


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"({sql.field(c if c != 'text' else text)})" for c in FIELDS) + ")"


ORACLE = f"""
WITH RECURSIVE {sql.CRC_TABLE},
docs AS (
    SELECT *, coalesce({sql.crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0, false) AS hit FROM documents, crc_table),
hashed AS (
    SELECT doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS g, {_leaf_sql("text")} AS h,
           CASE WHEN hit THEN {_leaf_sql(sql.ascii_lower("text"))} END AS changed
    FROM docs),
rows_ AS (
    SELECT doc_id, g, h AS leaf, h, coalesce(changed, h) AS now, '' AS proof,
           row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i
    FROM hashed),
{_climb("n", "rows_", SQL_LEVELS)},
subroots AS (SELECT '' AS g, g AS of_g, h, row_number() OVER (ORDER BY encode(g)) - 1 AS i FROM n{SQL_LEVELS}),
{_fold("n", "rows_", SQL_LEVELS)},
{_climb("t", "subroots", SQL_LEVELS)},
lifted AS (
    SELECT f.doc_id, f.leaf, f.proof, f.now, s.h AS subroot, s.g, s.i FROM nf{SQL_LEVELS} f JOIN subroots s ON s.of_g = f.g),
{_fold("t", "lifted", SQL_LEVELS)}
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = r.h AS verified
FROM tf{SQL_LEVELS}, t{SQL_LEVELS} r
"""
