"""Near-duplicate documents: a similarity join on word shingles.

Two texts are linked when the Jaccard similarity of their sets of five-word
shingles is 0.8 or more; a class is a connected component of the links.

1. A document becomes the hash of its shingle set (its node) and a MinHash
   signature; documents with one set are one node, whatever their number.
2. LSH forest: each tree orders the nodes by a label of DEPTH values of the
   signature, a prefix trie.  Two nodes are candidates if, in some tree, they
   share a prefix of the least depth; that depth is the one at which the
   forest reaches the target recall for the least similarity.
3. Deep prefixes come first.  Each node takes one partner: the first node of
   the deepest prefix it shares with an earlier one, shortened until there is
   one.  Pairs are verified exactly; links are joined to components.
4. Then only candidates in different components are left.  In each prefix
   group the first nodes of the components are paired with the group's first
   node.  In groups that still hold several components all nodes of different
   ones are compared inside tasks, by signature and then exactly; only links
   are written.  So no candidate pair that could join two components is left
   out, while copies that are linked already are never compared again.
5. Links are counted once the components are known: a link never leaves its
   component, so all pairs of each are compared in cells like those above, each
   pair in one cell: products of 0/1 columns give the shingles in common of all
   pairs of a cell, and only counts leave it.
6. Before texts are fetched, a pair whose whole signatures agree in too few
   places is dropped (four standard deviations below the least similarity,
   one pair in 30,000 at that similarity).

Recall of a pair at the least similarity is the target recall; components
have further ways to meet.  ``n_links`` counts the different texts of the class
that a document's text is linked to, and its own copies.

Defined results: a text of one to four words is one shingle; a null, empty or
blank text has no shingles, links to nothing and is a class of its own;
repeated rows are copies; a class is named by its smallest doc_id (null if
all are null); extra columns are ignored or kept; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import id_text, keyed, probable_owners, stored, table

SHINGLE = 5
SIMILARITY = 0.8
TREES, DEPTH = 20, 8
RECALL = 0.9995
CELL = 4096                   # nodes of a prefix group that are compared in one piece
WORD = "[^\\x20\\x09-\\x0D]"     # a text without one has no shingles
COUNT_CELL = 2048             # nodes of a component whose links are counted in one piece
COUNT_BYTES = 8 << 20         # bytes of text of such a piece
DENSE = 128                   # sets of a piece that must have a shingle to make it a column
COLUMNS = 1024                # columns that are multiplied at once
DEVIATIONS = 4                # a pair's signature may fall this far short of the least similarity

_U32 = np.uint32


def least_depth(similarity: float = SIMILARITY, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair of this similarity meets in some
    tree with the target recall: the full depth, shortened until it holds."""
    while depth > 1 and 1 - (1 - similarity ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.encode().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        n = max(1, len(h) - size + 1)
        out = np.zeros(n, np.uint64)
        for k in range(min(size, len(h))):
            out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + h[k:k + n]
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        out += np.uint64(min(size, len(h)))
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


_RNG = np.random.default_rng(20)
_MULTIPLY = (_RNG.integers(0, 2 ** 31, TREES * DEPTH, dtype=np.int64) * 2 + 1).astype(_U32)
_ADD = _RNG.integers(0, 2 ** 32, TREES * DEPTH, dtype=np.int64).astype(_U32)


def signature(sets: np.ndarray) -> bytes:
    """Least value of the set under each of TREES * DEPTH hash functions, 16
    bits of it each."""
    low, high = sets.astype(_U32), (sets >> np.uint64(32)).astype(_U32)
    least = np.full(TREES * DEPTH, 0xFFFFFFFF, _U32)
    with np.errstate(over="ignore"):
        for a in range(0, len(sets), 1024):
            x = low[a:a + 1024, None] * _MULTIPLY + _ADD
            x ^= x >> _U32(15)
            x = (x ^ high[a:a + 1024, None]) * _U32(0x9E3779B1)
            np.minimum(least, x.min(axis=0), out=least)
        least = (least ^ (least >> _U32(16))) * _U32(0x85EBCA6B)
    return (least >> _U32(16)).astype("<u2").tobytes()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    if not len(a) or not len(b):
        return 0.0
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return both / (len(a) + len(b) - both)


def sketches(texts: DataFrame) -> DataFrame:
    """(doc_id, th, node, sig) of (doc_id, text, th); node is null for a text
    without words."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sigs = [], []
            for t in batch.column(1):
                s = shingles(t.as_py())
                nodes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(nodes, pa.binary()),
                                              pa.array(sigs, pa.binary())], names=["doc_id", "th", "node", "sig"])

    return texts.select("doc_id", "text", "th").mapInArrow(run, f"doc_id {kind}, th binary, node binary, sig binary")


def _prefix_keys(sig: str, depth: int) -> str:
    """SQL: for each tree the hash of the first ``depth`` label values."""
    width = 2 * DEPTH
    return f"transform(sequence(0, {TREES - 1}), t -> xxhash64({depth}, t, substring({sig}, t * {width} + 1, {2 * depth})))"


def _agreement(least: float) -> int:
    """Places of a signature that must agree for a pair to be verified."""
    n = TREES * DEPTH
    return int(n * least - DEVIATIONS * (n * least * (1 - least)) ** 0.5)


def likely(pairs: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    """Pairs whose signatures agree in enough places for the similarity."""
    n, need = TREES * DEPTH, _agreement(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, n) for k in (2, 3))
            yield batch.filter(pa.array((a == b).sum(axis=1) >= need)).select(["u", "v"])

    own = sigs.select(F.col("node").alias("u"), F.col("sig").alias("a"))
    other = sigs.select(F.col("node").alias("v"), F.col("sig").alias("b"))
    return pairs.join(own, "u").join(other, "v").select("u", "v", "a", "b").mapInArrow(run, "u binary, v binary")


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs (u, v) of nodes whose texts have the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit, name, own = [], None, None
            for u, a, b in zip(batch.column(0), batch.column(2), batch.column(3), strict=True):
                if u != name:                        # pairs of one node come in a row
                    name, own = u, shingles(a.as_py())
                hit.append(similarity(own, shingles(b.as_py())) >= least)
            yield batch.filter(pa.array(hit, pa.bool_())).select(["u", "v"])

    own = texts.select(F.col("node").alias("u"), F.col("text").alias("a"))
    other = texts.select(F.col("node").alias("v"), F.col("text").alias("b"))
    return pairs.join(other, "v").join(own, "u").select("u", "v", "a", "b").mapInArrow(run, "u binary, v binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of the nodes on the edges (u, v); comp is the least node.

    Alternating stars: every node hands its larger neighbours its least one,
    then its smaller neighbours, until nothing changes.  Only joins and
    minima, so a node with very many neighbours is never one group."""
    def both(e):
        return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    e = stored(edges.select("u", "v").distinct(), "edges")
    while True:
        sym = both(e)
        least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(sym.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .where("u != v").distinct(), "edges")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        after = stored(small.select("x.*").where("u != v").distinct(), "edges")
        # stars only, and the same as before: done
        same = after.join(e, ["u", "v"], "left_anti").isEmpty() and e.join(after, ["u", "v"], "left_anti").isEmpty()
        e = after
        if same:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _relabelled(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links (u, v)."""
    ends = links.join(comp.select(F.col("node").alias("u"), F.col("comp").alias("a")), "u").join(
        comp.select(F.col("node").alias("v"), F.col("comp").alias("b")), "v")
    top = components(ends.where("a != b").select(F.col("a").alias("u"), F.col("b").alias("v")))
    return comp.join(top.select(F.col("node").alias("comp"), F.col("comp").alias("top")), "comp", "left").select(
        "node", F.coalesce("top", "comp").alias("comp"))


def _by_cell(batches: Iterator[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
    """``work`` over the rows of each cell; a partition is sorted by cell, the
    first three columns."""
    cell, name = [], None
    for batch in batches:
        key = np.column_stack([batch.column(k).to_numpy() for k in range(3)])
        edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
        for a, b in zip(edges, edges[1:]):
            if a < b:
                if name is not None and name != tuple(key[a].tolist()):
                    yield from work(pa.Table.from_batches(cell))
                    cell = []
                name = tuple(key[a].tolist())
                cell.append(batch.slice(a, b - a))
    if cell:
        yield from work(pa.Table.from_batches(cell))


def _sides(cell: pa.Table) -> tuple[np.ndarray, np.ndarray, bool, np.ndarray]:
    """(left rows, right rows, whether they are the same, component numbers)."""
    i, j, block = cell.column("i")[0].as_py(), cell.column("j")[0].as_py(), cell.column("block").to_numpy()
    comp = np.unique(np.array([x.hex() for x in cell.column("comp").to_pylist()]), return_inverse=True)[1]
    left = np.flatnonzero(block == i)
    return left, left if i == j else np.flatnonzero(block == j), i == j, comp


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, shingles) of (node, text)."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([shingles(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())],
            names=["node", "shingles"])


def _shingled_beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, shingles, ...) of (node, text, ...)."""
    for batch in batches:
        sets = pa.array([shingles(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), sets, *batch.columns[2:]],
                                         names=["node", "shingles", *batch.schema.names[2:]])


def _rest(placed: DataFrame, near: DataFrame, texts: DataFrame, depth: int, least: float) -> DataFrame:
    """Links (u, v) between all candidates in different components.

    Groups of one component are done.  Another group is compared in cells: a
    group of up to CELL nodes is one cell, a larger one is dealt into blocks,
    and each pair of blocks is a cell.  First signatures are compared; a node
    that looks similar enough to one of another component, which it has not
    met in an earlier tree, stays in its cell.  Then the shingle sets of those
    that stayed are fetched and compared exactly.  Rows are nodes in cells and
    links, never pairs."""
    n, need = TREES * DEPTH, _agreement(least)
    cells = ["key", "i", "j"]
    groups = placed.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("a"), F.max("comp").alias("b"))
    blocks = F.ceil(F.col("n") / CELL).cast("int")
    rows = (placed.join(groups.where("a != b").select("key", blocks.alias("blocks")), "key").join(
        near.select("node", "sig"), "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"),
                "block", "node", "comp", "tree", "sig"))

    def similar(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        left, right, same, comp = _sides(cell)
        sig = np.frombuffer(b"".join(cell.column("sig").to_pylist()), "<u2").reshape(-1, n)
        tree, stays = cell.column("tree")[0].as_py(), np.zeros(len(sig), bool)
        for at, x in enumerate(left):
            other = right[at + 1:] if same else right
            other = other[comp[other] != comp[x]]
            agree = sig[other] == sig[x]
            likely_ = agree.sum(axis=1) >= need
            other, agree = other[likely_], agree[likely_]
            if len(other):
                meet = agree.reshape(-1, TREES, DEPTH)[:, :, :depth].all(axis=2)
                other = other[meet.argmax(axis=1) == tree]
                stays[other] = True
                stays[x] |= len(other) > 0
        if stays.any():
            yield from cell.select([*cells, "block", "node", "comp"]).filter(pa.array(stays)).to_batches()

    def linked(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        left, right, same, comp = _sides(cell)
        sets = [np.frombuffer(x, np.uint64) for x in cell.column("shingles").to_pylist()]
        size = np.array([len(x) for x in sets])
        place = np.unique(np.concatenate(sets), return_inverse=True)[1]
        start = np.cumsum(size) - size
        mark, us, vs = np.zeros(int(place.max()) + 1, bool), [], []
        for at, x in enumerate(left):
            other = right[at + 1:] if same else right
            other = other[(comp[other] != comp[x]) & (np.minimum(size[other], size[x]) >= least * np.maximum(size[other], size[x]))]
            if not len(other):
                continue
            own = place[start[x]:start[x] + size[x]]
            mark[own] = True
            ends = np.cumsum(size[other])
            flat = np.repeat(start[other] - (ends - size[other]), size[other]) + np.arange(int(ends[-1]))
            both = np.add.reduceat(mark[place[flat]], ends - size[other], dtype=np.int64)
            mark[own] = False
            hit = other[both >= least * (size[other] + size[x] - both) - 1e-9]
            us.append(np.full(len(hit), x)), vs.append(hit)
        if us:
            node = cell.column("node")
            yield pa.RecordBatch.from_arrays(
                [node.take(pa.array(np.concatenate(c))).combine_chunks() for c in (us, vs)], names=["u", "v"])

    dealt = rows.repartition(*cells).sortWithinPartitions(*cells)
    stay = stored(dealt.mapInArrow(lambda b: _by_cell(b, similar),
                                   "key bigint, i int, j int, block int, node binary, comp binary"), "cells")
    wanted = texts.join(stay.select("node").distinct(), "node").select("node", "text")
    sets = wanted.mapInArrow(_shingled, "node binary, shingles binary")
    fetched = stay.join(sets, "node").select(*cells, "block", "node", "comp", "shingles")
    return fetched.repartition(*cells).sortWithinPartitions(*cells).mapInArrow(
        lambda b: _by_cell(b, linked), "u binary, v binary").distinct()


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shingles that each left set shares with each right one.

    A shingle of one set alone adds nothing.  One that DENSE sets or more have
    is a column of 0 and 1, and the columns are multiplied in slices; for the
    others the pairs of sets that have one are counted."""
    size = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), size)
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    out = np.zeros((len(left), len(right)), np.float32)

    column = np.cumsum(times >= DENSE) - 1
    often = times[place] >= DENSE
    r, c = row[often], column[place[often]]
    order = np.argsort(c, kind="stable")
    r, c = r[order], c[order]
    for first in range(0, int(c[-1]) + 1 if len(c) else 0, COLUMNS):
        a, b = np.searchsorted(c, [first, first + COLUMNS])
        slice_ = np.zeros((len(sets), COLUMNS), np.float32)
        slice_[r[a:b], c[a:b] - first] = 1
        out += slice_[left] @ slice_[right].T

    at_left, at_right = np.full(len(sets), -1), np.full(len(sets), -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    some = ~often & (times[place] > 1)
    r, c = row[some], place[some]
    order = np.argsort(c, kind="stable")
    r, c, flat, apart = r[order], c[order], out.reshape(-1), 1
    keep = np.arange(len(r))
    while len(keep):
        keep = keep[keep + apart < len(r)]
        keep = keep[c[keep] == c[keep + apart]]
        for x, y in ((r[keep], r[keep + apart]), (r[keep + apart], r[keep])):
            here = (at_left[x] >= 0) & (at_right[y] >= 0)
            np.add.at(flat, at_left[x[here]] * len(right) + at_right[y[here]], np.float32(1))
        apart += 1
    return out


def _degrees(comp: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(node, degree): links of each node to the others of its component.

    A component of up to COUNT_CELL nodes and COUNT_BYTES of text is one cell,
    a larger one is dealt into blocks whose pairs are cells, so each pair of
    nodes is in one cell, where the shingles of all pairs in common are counted
    at once.  Rows are nodes in cells; only counts leave a cell."""
    cells = ["key", "i", "j"]
    own = comp.join(texts.select("node", "text"), "node")
    sizes = own.groupBy("comp").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).where("n > 1")
    blocks = F.greatest(F.ceil(F.col("n") / COUNT_CELL), F.ceil(F.col("bytes") / COUNT_BYTES)).cast("int")
    sets = (own.join(sizes.select("comp", blocks.alias("blocks")), "comp")
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .select("node", "text", F.xxhash64("comp").alias("key"), "comp", "blocks", "block").mapInArrow(
                _shingled_beside, "node binary, shingles binary, key bigint, comp binary, blocks int, block int"))
    rows = (sets.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"),
                    "block", "node", "comp", "shingles"))

    def count(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        left, right, same, comp = _sides(cell)
        sets = [np.frombuffer(x, np.uint64) for x in cell.column("shingles").to_pylist()]
        size, degree = np.array([len(x) for x in sets]), np.zeros(len(sets), np.int64)
        both = _common(sets, left, right)
        for a in range(0, len(left), 256):                        # a slice of the matrix at a time
            x = left[a:a + 256]
            hit = both[a:a + 256] * (1 + least) >= least * (size[x][:, None] + size[right][None, :]) - 1e-9
            hit &= comp[x][:, None] == comp[right][None, :]       # components whose names have one hash share a cell
            if same:
                hit[np.arange(len(x)), a + np.arange(len(x))] = False
            else:
                degree[right] += hit.sum(axis=0)
            degree[x] += hit.sum(axis=1)
        yield pa.RecordBatch.from_arrays([cell.column("node").combine_chunks(), pa.array(degree)], names=["node", "degree"])

    counted = rows.repartition(*cells).sortWithinPartitions(*cells).mapInArrow(
        lambda b: _by_cell(b, count), "node binary, degree bigint")
    return counted.groupBy("node").agg(F.sum("degree").alias("degree"))


def join(docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, class_id, n_links, class_size."""
    texts = keyed(id_text(docs, id_col, text_col))
    rows, classes = _classes(texts, least)
    alone = F.col("node").isNull()
    found = rows.where(~alone).join(classes, "node").select(
        "doc_id", F.col("class.doc_id").alias("class_id"), F.col("n_links").cast("long"), F.col("class_size").cast("long"))
    return found.unionByName(rows.where(alone).select("doc_id", F.col("doc_id").alias("class_id"),
                                                      F.lit(0).cast("long").alias("n_links"),
                                                      F.lit(1).cast("long").alias("class_size")))


def _classes(texts: DataFrame, least: float, count_links: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, th, node) and nodes (node, class, n_links, class_size);
    class is the smallest (doc_id is null, doc_id, th) of the class.  Without
    ``count_links`` n_links is null."""
    rows = stored(sketches(texts), "sketches")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    nodes = stored(rows.where("node is not null").groupBy("node").agg(
        F.count("*").alias("copies"), F.min(own).alias("own"), F.min("sig").alias("sig")), "nodes")
    depth = least_depth(least)

    keys = nodes.select("node", F.posexplode(F.expr(_prefix_keys("sig", depth))).alias("tree", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = stored(keys.join(shared, "key"), "prefixes")

    near = stored(members.select("node").distinct().join(nodes, "node").select("node", "sig", "own"), "near-nodes")
    owners = near.select("own.doc_id", "own.th", "node")
    found = probable_owners(texts, owners.select("doc_id", "th"))
    fetched = found.alias("t").join(owners.alias("o"), F.col("t.doc_id").eqNullSafe(F.col("o.doc_id"))
                                    & (F.col("t.th") == F.col("o.th"))).select("o.node", "t.text")
    near_texts = stored(fetched.dropDuplicates(["node"]), "near-texts")

    def check(pairs: DataFrame) -> DataFrame:
        return stored(verified(likely(pairs.distinct(), near, least), near_texts, least), "links")

    # the deepest prefix that a node shares with an earlier one
    deep = None
    for d in range(DEPTH, depth - 1, -1):
        k = near.select("node", F.explode(F.expr(_prefix_keys("sig", d))).alias("key"), F.lit(d).alias("d"))
        deep = k if deep is None else deep.unionByName(k)
    first = deep.groupBy("key").agg(F.min("node").alias("v"), F.count("*").alias("n")).where("n > 1").select("key", "v")
    partner = deep.join(first, "key").where("v < node").groupBy("node").agg(
        F.max(F.struct("d", "v")).alias("best")).select(F.col("node").alias("u"), F.col("best.v").alias("v"))
    comp = components(check(partner))
    comp = stored(near.select("node").join(comp, "node", "left").select(
        "node", F.coalesce("comp", "node").alias("comp")), "components")

    # first nodes of the components in each prefix group
    placed = members.join(comp, "node")
    heads = placed.groupBy("key", "comp").agg(F.min("node").alias("u"))
    lead = heads.groupBy("key").agg(F.min("u").alias("v"), F.count("*").alias("n")).where("n > 1").select("key", "v")
    more = check(heads.join(lead, "key").where("u != v").select("u", "v"))
    comp = stored(_relabelled(comp, more), "components")

    # every pair of candidates in different components that is left
    more = stored(_rest(members.join(comp, "node"), near, near_texts, depth, least), "links")
    comp = stored(_relabelled(comp, more), "components")

    if count_links:
        degree = _degrees(comp, near_texts, least)
        n_links = F.coalesce("degree", F.lit(0)) + F.col("copies") - 1
    else:
        degree, n_links = nodes.limit(0).select("node"), F.lit(None).cast("long")
    labelled = nodes.select("node", "copies", "own").join(comp, "node", "left").join(degree, "node", "left").select(
        "node", "copies", "own", F.coalesce("comp", "node").alias("comp"), n_links.alias("n_links"))
    labelled = stored(labelled, "labelled")
    named = labelled.groupBy("comp").agg(F.min("own").alias("class"), F.sum("copies").alias("class_size"))
    return rows.select("doc_id", "th", "node"), labelled.join(named, "comp").select(
        "node", "class", "n_links", "class_size")


def keep_one(docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, the one that names it; documents
    without words all stay.  Columns are unchanged."""
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = keyed(packed)
    classes = _classes(texts.select("doc_id", "text", "th"), least, count_links=False)[1]
    keep = classes.select(F.col("class.doc_id").alias("_id"), F.col("class.th").alias("_th")).distinct()
    joined = texts.select("row", "doc_id", "th").join(
        keep, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
    # rows with one id and text are alike: any of them, chosen before the shuffle
    one = joined.groupBy("doc_id", "th").agg(F.first("row").alias("row"))
    return one.select("row.*").unionByName(packed.where(~F.col("text").rlike(WORD)).select("row.*"))


def query(spark, sf_dir):
    return join(table(spark, sf_dir, "documents"))
