"""A Merkle manifest of a dataset, grown by appends, with a witness for each record.

Records are the leaves of one tree for each source, in ascending order of their ids. Every
16 consecutive nodes (the last run: fewer, even one) have a parent, until one node is left:
the source's root. The roots of all sources, in the order of the sources, are the leaves of
the tree above, whose root stands for the dataset.

A tree is built by appending. ``Growing`` holds what is open: at each level the run that
has no parent yet. When the last sibling of a run arrives, or the tree ends, each node of
the run gets its step (its place and its siblings), which extends the witnesses of all
leaves below it. Leaves are worked on in aligned blocks of BLOCK, each by one task; the
roots of the blocks are the next tier's appends, block by block again, until one block is
left. A witness is the steps of a leaf inside its block, then those of the block's root.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farebox.llm.common import column, new_folder, stored

FANOUT = 16
# Aligned blocks span this many levels of a tree.
BLOCK_LEVELS = 2
BLOCK = FANOUT**BLOCK_LEVELS
DIGEST = 32
# The columns of a record that its digest covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ---- Trees ----------------------------------------------------------------------------


def hashed(digests: Iterable[bytes]) -> bytes:
    """The digest of some digests, which are hashed as lower-case hex."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def height(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FANOUT), levels + 1
    return levels


class Growing:
    """A tree that grows by appends, and the partial witnesses of all that was appended."""

    def __init__(self) -> None:
        self.digests: list[bytes] = []
        self.parents: list[int] = []
        self.steps: list[bytes] = []
        self.open: list[list[int]] = [[]]

    def append(self, digest: bytes, level: int = 0) -> int:
        """Add the next node of a level; a run that is full with it gets its parent."""
        node = len(self.digests)
        self.digests.append(digest)
        self.parents.append(-1)
        self.steps.append(b"")
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == FANOUT:
            self._complete(level)
        return node

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        parts = [self.digests[node] for node in run]
        parent = self.append(hashed(parts), level + 1)
        for place, node in enumerate(run):
            self.parents[node] = parent
            self.steps[node] = step(place, parts[:place] + parts[place + 1 :])

    def finish(self, levels: int) -> bytes:
        """Complete the open runs below a level, and give its only node."""
        for level in range(levels):
            if self.open[level]:
                self._complete(level)
        (root,) = self.open[levels]
        return self.digests[root]

    def witness(self, node: int) -> bytes:
        """The steps of a node up to the highest complete run."""
        found = []
        while node >= 0:
            found.append(self.steps[node])
            node = self.parents[node]
        return b"".join(found)


def step(place: int, siblings: list[bytes]) -> bytes:
    """A level of a witness: the node's place in its run, the number of siblings, and these."""
    return bytes([place, len(siblings)]) + b"".join(siblings)


def steps(witness: bytes) -> Iterator[tuple[int, bytes]]:
    """The place and the siblings' digests at each level of a witness."""
    at = 0
    while at < len(witness):
        place, end = witness[at], at + 2 + DIGEST * witness[at + 1]
        yield place, witness[at + 2 : end]
        at = end


def folded(digest: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for place, siblings in steps(witness):
        cut = DIGEST * place
        digest = hashed([siblings[:cut], digest, siblings[cut:]])
    return digest


def proof_digest(witness: bytes) -> bytes:
    """The digest of all siblings of a witness."""
    return hashed(siblings for _, siblings in steps(witness))


# ---- Records --------------------------------------------------------------------------


def record_digest(values: Iterable[Column]) -> Column:
    """The digest of a record, as lower-case hex.

    Covers each value as the number of its UTF-8 bytes, a colon and the value; nulls as -.
    """
    texts = [value.cast("string") for value in values]
    parts = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(part, F.lit("-")) for part in parts]), 256)


def records(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """(tree, id, leaf, claimed) of every row: the leaves of the sources' trees.

    ``tree`` is the source with an "s" before it, or empty without a source, so that its
    order is that of the sources, null first. ``claimed`` (hex; default: the leaf itself) is
    the digest that somebody else has of the record and that ``proofs`` verifies.
    """
    leaf = record_digest([column(docs, name) for name in FIELDS])
    return docs.select(
        F.coalesce(
            F.concat(F.lit("s"), column(docs, "source").cast("string")), F.lit("")
        ).alias("tree"),
        column(docs, "doc_id").cast("long").alias("id"),
        F.unhex(leaf).alias("leaf"),
        F.unhex(leaf if claimed is None else claimed).alias("claimed"),
    )


def ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with ``pos``, their place in their tree, and ``total``, the tree's size.

    The whole table is sorted by tree and ``order``, nulls first; a tree may span any number
    of tasks, and copies of one row too. A task's rows are counted by tree, and only these
    counts, one row for each task and tree, are added up along a tree.
    """
    fixed = stored(leaves.withColumn("copy", F.monotonically_increasing_id()), "leaves")
    by = [F.col("tree"), *[F.col(name).asc_nulls_first() for name in order], F.col("copy")]
    in_place = stored(
        fixed.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("part", F.spark_partition_id())
        # The low 33 bits count the rows of the partition.
        .withColumn("rank", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
        .drop("copy"),
        "ranked",
    )
    counts = in_place.groupBy("part", "tree").agg(
        F.min("rank").alias("first"), F.count(F.lit(1)).alias("rows")
    )
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(
        "part",
        "tree",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(tree).alias("total"),
    )
    return in_place.join(placed, ["part", "tree"]).select(
        "tree", (F.col("shift") + F.col("rank")).alias("pos"), "total", *leaves.drop("tree").columns
    )


# ---- Blocks ---------------------------------------------------------------------------

# A piece is a run of leaves of one block that were appended together; ``size`` and
# ``digest`` are the block's once they are there.
PIECES = (
    "tree string, block long, total long, size int, first int, "
    "ids array<bigint>, nodes binary, claimed binary, digest binary"
)
PIECE_TYPES = [
    pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(),
    pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(),
]
PIECE_NAMES = [field.split()[0] for field in PIECES.split(", ")]


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each block, from rows sorted by tree and place."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        trees = batch.column("tree").dictionary_encode()
        codes = trees.indices.to_numpy()
        blocks = batch.column("block").to_numpy()
        edges = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for lo, hi in itertools.pairwise([0, *edges.tolist(), batch.num_rows]):
            if lo == hi:
                continue
            name = (trees.dictionary[int(codes[lo])].as_py(), int(blocks[lo]))
            if held and name != last:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            last = name
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The new leaves of each block, and the block's root as it is with them."""
    out: list[tuple] = []
    for rows in _blocks(batches):
        total = rows.column("total")[0].as_py()
        tree = Growing()
        leaves = rows.column("leaf").to_pylist()
        for leaf in leaves:
            tree.append(leaf)
        # A block that is its whole tree ends where one node is left.
        digest = tree.finish(height(len(leaves)) if total <= BLOCK else BLOCK_LEVELS)
        old = int(np.count_nonzero(rows.column("old").to_numpy(zero_copy_only=False)))
        claims = rows.column("claimed")[old:]
        out.append(
            (
                rows.column("tree")[0].as_py(),
                rows.column("block")[0].as_py(),
                total,
                len(leaves),
                old,
                rows.column("id")[old:].to_pylist(),
                b"".join(leaves[old:]),
                b"".join(claims.to_pylist()) if claims.null_count == 0 else None,
                digest,
            )
        )
        if len(out) * BLOCK >= 1 << 16:
            yield _batch(out, PIECE_TYPES, PIECE_NAMES)
            out = []
    yield _batch(out, PIECE_TYPES, PIECE_NAMES)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _in_blocks(rows: DataFrame) -> DataFrame:
    """(tree, pos, total, id, leaf, claimed, old), each block in one task, in its order."""
    return (
        rows.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
        .repartition("tree", "block")
        .sortWithinPartitions("tree", "pos")
    )


def _block_roots(pieces: DataFrame) -> DataFrame:
    """(tree, block, size, digest) of every block, as its newest piece has them."""
    newest = F.max(F.struct("size", "digest")).alias("newest")
    return pieces.groupBy("tree", "block").agg(newest).select("tree", "block", "newest.*")


# ---- The manifest ---------------------------------------------------------------------


class Manifest:
    """The leaves of a dataset in a folder, one subfolder for each append.

    A block that is full is never read again by an append; of all other leaves an append
    reads those of the last block of each source that it touches.
    """

    def __init__(self, spark: SparkSession, folder: str, appends: tuple[str, ...] = ()):
        self.spark = spark
        self.folder = folder
        self.appends = appends

    def pieces(self) -> DataFrame:
        paths = [f"{self.folder}/{name}" for name in self.appends]
        if not paths:
            return self.spark.createDataFrame([], PIECES)
        return self.spark.read.schema(PIECES).parquet(*paths)

    def append(self, leaves: DataFrame) -> Manifest:
        """The manifest with further ``records``, which come after those it has.

        Within a source, all ids must be greater than those appended before; it is an error
        if they are not. A null id comes first of all, so only with a source's first append.
        """
        placed = ranked(leaves, ["id", "leaf", "claimed"]).withColumn("old", F.lit(False))
        if self.appends:
            placed = self._after(placed)
        name = f"append-{len(self.appends):06d}"
        _in_blocks(placed).mapInArrow(_pieces, PIECES).write.parquet(f"{self.folder}/{name}")
        return Manifest(self.spark, self.folder, (*self.appends, name))

    def _after(self, placed: DataFrame) -> DataFrame:
        """New leaves in their places after the old, with the leaves of the open blocks."""
        pieces = self.pieces()
        last = pieces.groupBy("tree").agg(
            F.max(F.col("block") * BLOCK + F.col("size")).alias("before"),
            F.max(F.array_max("ids")).alias("last_id"),
        )
        smallest = placed.groupBy("tree").agg(
            F.min("id").alias("first_id"),
            F.max("total").alias("fresh"),
            F.count_if(F.col("id").isNull()).alias("unnamed"),
        )
        fits = (F.col("first_id") > F.col("last_id")) & (F.col("unnamed") == 0)
        # The new leaves of a source whose ids do not go on fail the job.
        grown = smallest.join(last, "tree").filter(
            F.assert_true(
                F.coalesce(fits, F.lit(False)), "an append has ids that do not come last"
            ).isNull()
        )
        grown = grown.select("tree", "before", (F.col("before") + F.col("fresh")).alias("grown"))
        moved = placed.join(grown, "tree", "left").select(
            "tree",
            (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"),
            F.coalesce("grown", "total").alias("total"),
            "id",
            "leaf",
            "claimed",
            "old",
        )
        reopened = (
            pieces.join(grown, "tree")
            .filter(F.col("block") == F.floor(F.col("before") / BLOCK))
            .select("tree", "block", "first", "grown", F.posexplode("ids").alias("at", "id"), "nodes")
            .select(
                "tree",
                (F.col("block") * BLOCK + F.col("first") + F.col("at")).alias("pos"),
                F.col("grown").alias("total"),
                "id",
                F.substring("nodes", F.col("at") * DIGEST + 1, F.lit(DIGEST)).alias("leaf"),
                F.lit(None).cast("binary").alias("claimed"),
                F.lit(True).alias("old"),
            )
        )
        return moved.unionByName(reopened)

    def trees(self) -> Trees:
        return Trees(self.pieces())


class Trees:
    """The tiers of blocks above the leaves, and what is read from them."""

    def __init__(self, pieces: DataFrame):
        self.pieces = pieces
        self.tiers = self._climbed(_block_roots(pieces))
        roots = stored(self._finished(self.tiers), "subroots")
        self.sources = roots
        # The sources are the leaves of a single tree.
        leaves = roots.select(
            F.lit("").alias("tree"),
            F.col("tree").alias("name"),
            F.col("digest").alias("leaf"),
        )
        placed = ranked(leaves, ["name"])
        names = placed.select(F.col("pos"), F.col("name"))
        self.names = names
        nodes = placed.select("tree", F.col("pos").alias("block"), F.col("leaf").alias("digest"))
        self.top = self._climbed(nodes)

    @staticmethod
    def _climbed(nodes: DataFrame) -> list[DataFrame]:
        """The tiers of blocks over (tree, block, digest), one node for each block.

        Each tier takes the roots of the one below as appends, until no tree has more than
        one block. The first entry is the nodes themselves.
        """
        nodes = nodes.select("tree", F.col("block").alias("pos"), "digest")
        tiers = [nodes]
        while True:
            sizes = nodes.groupBy("tree").agg(F.max("pos").alias("most"))
            if (sizes.agg(F.max("most")).first()[0] or 0) == 0:
                return tiers
            grown = sizes.filter(F.col("most") > 0)
            rows = nodes.join(grown, "tree").select(
                "tree",
                "pos",
                (F.col("most") + 1).alias("total"),
                F.lit(None).cast("long").alias("id"),
                F.col("digest").alias("leaf"),
                F.lit(None).cast("binary").alias("claimed"),
                F.lit(False).alias("old"),
            )
            blocks = stored(_in_blocks(rows).mapInArrow(_pieces, PIECES), "blocks")
            tiers.append(blocks)
            nodes = blocks.select("tree", F.col("block").alias("pos"), "digest")

    @staticmethod
    def _finished(tiers: list[DataFrame]) -> DataFrame:
        """(tree, tier, digest) of the root of each tree: its only node of the last tier."""
        found = []
        for number, tier in enumerate(tiers):
            at = "pos" if number == 0 else "block"
            rows = tier.groupBy("tree").agg(
                F.max(at).alias("most"), F.min_by("digest", at).alias("digest")
            )
            alone = rows.filter(F.col("most") == 0)
            found.append(alone.select("tree", F.lit(number).alias("tier"), "digest"))
        whole = found[0]
        for rows in found[1:]:
            whole = whole.unionByName(rows)
        return whole

    def roots(self) -> DataFrame:
        """(source, root) of every source."""
        return self.sources.select(source_of("tree").alias("source"), F.col("digest").alias("root"))

    def _descended(self, tiers: list[DataFrame], ends: DataFrame) -> DataFrame:
        """(tree, block, witness, heads) of the nodes of the lowest tier.

        ``ends`` has, for each tree, the tier it ends in and the witness of its root.
        """
        outer = None
        for number in range(len(tiers) - 1, -1, -1):
            own = ends.filter(F.col("tier") == number).select(
                "tree", F.lit(0).cast("long").alias("block"), "witness", "heads"
            )
            outer = own if outer is None else outer.unionByName(own)
            if number:
                rows = tiers[number].select("tree", "block", "total", "nodes")
                outer = rows.join(outer, ["tree", "block"]).mapInArrow(
                    _node_witnesses, "tree string, block long, witness binary, heads binary"
                )
        return outer

    def proofs(self) -> DataFrame:
        """(source, id, leaf, claimed, witness, subroot, root) of every leaf.

        Digests are binary; ``witness`` leads from the leaf to the root.
        """
        root = self._finished(self.top).select(
            "tree",
            "tier",
            F.lit(b"").alias("witness"),
            F.col("digest").alias("heads"),
        )
        above = self._descended(self.top, root)
        named = above.join(self.names, above["block"] == self.names["pos"]).select(
            F.col("name").alias("tree"), "witness", F.col("heads").alias("root")
        )
        ends = self.sources.join(named, "tree").select(
            "tree", "tier", "witness", F.concat("digest", "root").alias("heads")
        )
        outer = stored(self._descended(self.tiers, ends), "witnesses")
        # At most BLOCK leaves, and as many pieces, make a block.
        parts = F.sort_array(F.collect_list(F.struct("first", "total", "ids", "nodes", "claimed")))
        blocks = self.pieces.groupBy("tree", "block").agg(parts.alias("pieces"))
        return (
            blocks.join(outer, ["tree", "block"])
            .mapInArrow(_leaf_witnesses, LEAVES)
            .withColumn("tree", source_of("tree"))
            .withColumnRenamed("tree", "source")
        )


def source_of(tree: str) -> Column:
    return F.when(F.col(tree) != "", F.substring(tree, 2, 2**31 - 1))


LEAVES = (
    "tree string, id long, leaf binary, claimed binary, witness binary, subroot binary, root binary"
)


def _cut(digests: bytes) -> list[bytes]:
    return [digests[at : at + DIGEST] for at in range(0, len(digests), DIGEST)]


def _witnesses(nodes: bytes, alone: bool, outer: bytes) -> Iterator[bytes]:
    """The witnesses of a block's nodes: their steps in the block, then the block's own."""
    tree = Growing()
    members = [tree.append(digest) for digest in _cut(nodes)]
    tree.finish(height(len(members)) if alone else BLOCK_LEVELS)
    # The members of a run share all but their own step.
    rest = {node: tree.witness(node) + outer for node in {tree.parents[m] for m in members}}
    for member in members:
        yield tree.steps[member] + rest[tree.parents[member]]


def _node_witnesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
    names = ["tree", "block", "witness", "heads"]
    for batch in batches:
        for row in _rows(batch):
            found = _witnesses(row["nodes"], row["total"] <= BLOCK, row["witness"])
            first = row["block"] * BLOCK
            yield _batch(
                [(row["tree"], first + n, w, row["heads"]) for n, w in enumerate(found)],
                kinds,
                names,
            )


def _leaf_witnesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), *[pa.binary()] * 5]
    names = [field.split()[0] for field in LEAVES.split(", ")]
    for batch in batches:
        for row in _rows(batch):
            pieces = row["pieces"]
            ids = list(itertools.chain.from_iterable(p["ids"] for p in pieces))
            nodes = b"".join(p["nodes"] for p in pieces)
            claims = _cut(b"".join(p["claimed"] or p["nodes"] for p in pieces))
            alone = row["block"] == 0 and max(p["total"] for p in pieces) <= BLOCK
            found = _witnesses(nodes, alone, row["witness"])
            subroot, root = _cut(row["heads"])
            yield _batch(
                [
                    (row["tree"], *leaf, subroot, root)
                    for leaf in zip(ids, _cut(nodes), claims, found, strict=True)
                ],
                kinds,
                names,
            )


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


def verified(proofs: DataFrame) -> DataFrame:
    """``proofs`` with their digests as hex, and each claim folded up to a root.

    Adds ``proof_sha256``, the digest of a witness's siblings, ``folded_root``, where the
    claimed digest leads, and ``verified``, whether that is the root.
    """
    kept = ["id", "leaf", "subroot", "root"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            claims, found = batch.column("claimed").to_pylist(), batch.column("witness").to_pylist()
            ends = [folded(c, w) for c, w in zip(claims, found, strict=True)]
            roots = batch.column("root").to_pylist()
            columns = [batch.column("id")] + [
                pa.array([d.hex() for d in batch.column(name).to_pylist()], pa.string())
                for name in kept[1:]
            ]
            columns += [
                pa.array([proof_digest(w).hex() for w in found], pa.string()),
                pa.array([d.hex() for d in ends], pa.string()),
                pa.array([a == b for a, b in zip(ends, roots, strict=True)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, [*kept, "proof_sha256", "folded_root", "verified"]
            )

    return proofs.select(*kept, "claimed", "witness").mapInArrow(
        check,
        "id long, leaf string, subroot string, root string, "
        "proof_sha256 string, folded_root string, verified boolean",
    )


def manifest(docs: DataFrame, claimed: Column | None = None) -> Manifest:
    """The manifest of a whole table of documents.

    Leaves of a source ascend by doc_id, null first, then by digest; rows that are equal in
    every covered column take neighbouring places, in any order. A row without a source
    belongs to the tree of null. An empty table has no tree, no root and no proof. A text of
    any length is hashed where it is and moved nowhere. Columns beyond FIELDS are not covered.
    """
    spark = docs.sparkSession
    return Manifest(spark, new_folder(spark, "manifest")).append(records(docs, claimed))
