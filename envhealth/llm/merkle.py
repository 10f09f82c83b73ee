"""Merkle manifest of a dataset, with a proof for every row.

Each group of rows (a language) has a tree of SHA-256 nodes over its leaves in order of doc_id,
and the groups' roots, in order of the group's name, are the leaves of the last tree.

No leaf is sorted to find its place. The ids of a group are a bitmap of 64-bit words, of which
only those with a bit are rows, merged from all tasks. A directory holds the number of leaves
before each word, so a leaf's coordinate is that number plus the bits below its own. Leaves are
then gathered into arrays of SLOTS by coordinate, each of which is reduced by ten levels at once,
and so on with the nodes that are left.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import prefix_sums
from .scratch import saved, small_batches

WORD_BITS = 6
#: Levels that one array of slots is reduced by.
LEVELS = 10
SLOTS = 1 << LEVELS
#: Word of a null id, below that of any other.
NO_ID = -(1 << 57) - 1
#: How a node's run holds its sibling: none (a lone node), to the right, to the left.
LONE, RIGHT, LEFT = 0, 1, 2
DIGEST = 32


def leaf_hash(*columns: Column) -> Column:
    """Hex SHA-256 of the values: `-` for a null, else the UTF-8 byte count, `:` and the value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def combined(*nodes: str) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def levels(nodes: list[str], depth: int) -> list[list[str]]:
    """The nodes of `depth` levels and of the one above them; a last single node is hashed alone."""
    out = [nodes]
    for _ in range(depth):
        below = out[-1]
        out.append([combined(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return out


def siblings(tree: list[list[str]], slot: int) -> bytes:
    """What a node needs to rebuild the last level: a side and, unless it is alone, a digest per level."""
    path = bytearray()
    for nodes in tree[:-1]:
        other = slot ^ 1
        if other >= len(nodes):
            path.append(LONE)
        else:
            path.append(RIGHT if other > slot else LEFT)
            path += bytes.fromhex(nodes[other])
        slot >>= 1
    return bytes(path)


def steps(path: bytes) -> Iterator[tuple[int, str]]:
    """Side and sibling of each level of a path."""
    at = 0
    while at < len(path):
        side, end = path[at], at + 1 + (DIGEST if path[at] != LONE else 0)
        yield side, path[at + 1 : end].hex()
        at = end


def folded(leaf: str, path: bytes) -> str:
    """The root that a leaf leads to along its path."""
    for side, other in steps(path):
        leaf = combined(other, leaf) if side == LEFT else combined(leaf, other)
    return leaf


def proof_hash(path: bytes) -> str:
    return combined(*[other for _, other in steps(path)])


def _depth(chunk: int, size: int) -> int:
    """Levels to reduce an array by; only the single array of a tree may need fewer than all."""
    return LEVELS if chunk else (size - 1).bit_length()


def _array(slots: list[dict]) -> list[dict]:
    out: list[dict] = [{}] * len(slots)
    for entry in slots:
        out[entry["slot"]] = entry
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`(tree, node, hash)`: what each array of slots is reduced to."""
    for row in _rows(batches):
        nodes = [entry["hash"].hex() for entry in _array(row["slots"])]
        top = levels(nodes, _depth(row["chunk"], len(nodes)))[-1]
        columns = [[row["tree"]], [row["chunk"]], [bytes.fromhex(top[0])]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["tree", "node", "hash"])


def _descended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`(tree, node, path)` of the nodes in each array, given the array's own path."""
    for row in _rows(batches):
        nodes = [entry["hash"].hex() for entry in _array(row["slots"])]
        tree = levels(nodes, _depth(row["chunk"], len(nodes)))
        paths = [siblings(tree, slot) + row["path"] for slot in range(len(nodes))]
        places = [row["chunk"] * SLOTS + slot for slot in range(len(nodes))]
        columns = [pa.array([row["tree"]] * len(nodes)), pa.array(places), pa.array(paths, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["tree", "node", "path"])


def _proved(batches: Iterator[pa.RecordBatch], id_type: pa.DataType, root: str) -> Iterator[pa.RecordBatch]:
    """The manifest rows of the leaves in each array, given its path."""
    for row in _rows(batches):
        entries = _array(row["slots"])
        tree = levels([entry["hash"].hex() for entry in entries], _depth(row["chunk"], len(entries)))
        out: list[list] = [[], [], [], [], []]
        for slot, entry in enumerate(entries):
            path = siblings(tree, slot) + row["path"]
            found = folded((entry["claim"] or entry["hash"]).hex(), path)
            values = (entry["doc_id"], entry["hash"].hex(), proof_hash(path), found, found == root)
            for column, value in zip(out, values, strict=True):
                column.append(value)
        n = len(entries)
        subroot = folded(tree[0][0], siblings(tree, 0) + row["within"])
        columns = [
            pa.array(out[0], id_type), pa.array(out[1]), pa.array([subroot] * n), pa.array([root] * n),
            pa.array(out[2]), pa.array(out[3]), pa.array(out[4]),
            pa.array([row["chunk"] * SLOTS + slot for slot in range(n)]),
        ]
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "place"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def coordinates(leaves: DataFrame) -> DataFrame:
    """`leaves(tree, doc_id, hash, claim, row)` with `place`, the leaf's place in its tree.

    Rows of one tree that share an id, or have none, cannot share a bit: the words that hold
    such ids are crowded, and their rows (no others) are ordered by id, nulls first, hash, claim
    and row, in ranges of that order. A hot id is split by `row`, and in the join by Spark's
    handling of skew.
    """
    word = F.coalesce(F.shiftright("doc_id", WORD_BITS), F.lit(NO_ID))
    bit = F.col("doc_id").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    placed = leaves.withColumn("word", word).withColumn("bit", bit)
    one, ones = F.lit(1).cast("long"), F.lit(-1).cast("long")
    words = placed.groupBy("tree", "word").agg(
        F.bit_or(F.call_function("shiftleft", one, F.col("bit"))).alias("bits"), F.count(F.lit(1)).alias("n")
    )
    crowded = F.coalesce(F.bit_count("bits") < F.col("n"), F.lit(True))
    words = words.withColumn("crowded", crowded)
    directory = prefix_sums(
        words, [F.col("tree"), F.col("word")], before=F.col("n"), aside=F.when(F.col("crowded"), F.col("n")).otherwise(0)
    )
    starts = directory.groupBy("tree").agg(F.min("before").alias("start"))
    directory = saved(directory.join(starts, "tree").withColumn("before", F.col("before") - F.col("start")).drop("start", "n"), "directory")
    found = placed.join(directory, ["tree", "word"])
    below = F.col("bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", ones, F.col("bit"))))
    columns = ["tree", "doc_id", "hash", "claim"]
    plain = found.where(~F.col("crowded")).select(*columns, (F.col("before") + F.bit_count(below)).alias("place"))
    if directory.where("crowded").isEmpty():
        return plain
    order = [F.col("tree"), F.asc_nulls_first("doc_id"), F.col("hash"), F.col("claim"), F.col("row")]
    ordered = prefix_sums(found.where("crowded"), order, among=F.lit(1))
    place = F.col("before") + F.col("among") - F.col("aside")
    return plain.union(ordered.select(*columns, place.alias("place")))


def _arrays(nodes: DataFrame, place: str, *entry: str) -> DataFrame:
    """`(tree, chunk, slots)`: nodes gathered by the array that their place falls into."""
    chunk = F.shiftright(place, LEVELS).alias("chunk")
    slot = F.col(place).bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")
    grouped = nodes.groupBy("tree", chunk).agg(F.collect_list(F.struct(slot, *entry)).alias("slots"))
    return saved(grouped, "slots")


def _climbed(arrays: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Arrays of all rounds above `arrays`, and the single node `(tree, node, hash)` of each tree."""
    rounds = []
    while True:
        nodes = saved(arrays.mapInArrow(_reduced, "tree string, node long, hash binary"), "nodes")
        if not nodes.agg(F.max("node")).first()[0]:
            return rounds, nodes
        arrays = _arrays(nodes, "node", "hash")
        rounds.append(arrays)


def _paths(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    """`(tree, node, path)` of the lowest arrays, from the path of each tree's top."""
    for arrays in reversed(rounds):
        above = arrays.join(paths.withColumnRenamed("node", "chunk"), ["tree", "chunk"])
        paths = saved(above.select("tree", "chunk", "slots", "path").mapInArrow(_descended, "tree string, node long, path binary"), "paths")
    return paths


def manifest(leaves: DataFrame) -> DataFrame:
    """`(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, place)`, one row per leaf.

    `leaves(group, doc_id, leaf, claim)` has an integer id, the leaf's hex digest, and the digest that
    the row has when it is checked (null: unchanged). `subroot` and `root` are those of the group and of
    all groups, `proof_sha256` is the hash of the siblings on the way, `folded_root` the root that the
    claim leads to along them, and `verified` says whether it is `root`. `place` counts the group's
    leaves from 0. A null group is a group, the first one. Null ids come first; rows of one id are ordered
    by leaf, then claim, and rows alike in all have neighbouring places of which it is not said whose is
    which. Other columns are ignored; no rows, no result rows. A group with a single leaf has it as its
    subroot, a single group's subroot is the root.
    """
    spark = leaves.sparkSession
    small_batches(spark)
    id_type = leaves.schema["doc_id"].dataType
    # Names that keep the order of the groups and leave null and empty apart.
    tree = F.coalesce(F.concat(F.lit("="), F.col("group").cast("string")), F.lit("")).alias("tree")
    digests = [F.unhex("leaf").alias("hash"), F.unhex("claim").alias("claim"), F.monotonically_increasing_id().alias("row")]
    rows = saved(leaves.select(tree, F.col("doc_id").cast("long").alias("doc_id"), *digests), "leaves")
    lowest = _arrays(coordinates(rows), "place", "doc_id", "hash", "claim")
    rounds, tops = _climbed(lowest)
    groups = saved(prefix_sums(tops.select("tree", "hash"), [F.col("tree")], place=F.lit(1)), "groups")
    all_groups = groups.select(F.lit("").alias("tree"), "place", "hash")
    lowest_groups = _arrays(all_groups, "place", "hash")
    upper, top = _climbed(lowest_groups)
    root = top.first()
    empty = F.lit(b"").alias("path")
    over = _paths([lowest_groups, *upper], top.select("tree", "node", empty))
    group_paths = groups.join(over.select(F.col("node").alias("place"), "path"), "place")
    # Paths within a group first; those above it are the same for all its leaves.
    within = _paths(rounds, tops.select("tree", "node", empty)).withColumnRenamed("path", "within")
    known = within.join(group_paths.select("tree", "path"), "tree")
    known = known.select("tree", F.col("node").alias("chunk"), "within", F.concat("within", "path").alias("path"))
    joined = lowest.join(known, ["tree", "chunk"]).select("tree", "chunk", "slots", "within", "path")
    value = root["hash"].hex() if root else ""
    schema = (
        f"doc_id {id_type.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean, place long"
    )
    arrow_type = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[id_type.simpleString()]

    def proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _proved(batches, arrow_type, value)

    return joined.mapInArrow(proved, schema)


def audited(docs: DataFrame, changed: dict[str, Column] | None = None) -> DataFrame:
    """The manifest of `docs(doc_id, source, lang, n_chars, text)`, with rows claimed as `changed` says.

    `changed` gives new values of columns, over those of `docs`; without it all rows are as they were.
    """
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = leaf_hash(*[F.col(name) for name in names])
    replaced = changed or {}
    differs = F.lit(False)
    for name, value in replaced.items():
        differs = differs | ~F.col(name).eqNullSafe(value)
    claim = F.when(differs, leaf_hash(*[replaced.get(name, F.col(name)) for name in names]))
    return manifest(docs.select(F.col("lang").alias("group"), "doc_id", leaf.alias("leaf"), claim.alias("claim")))
