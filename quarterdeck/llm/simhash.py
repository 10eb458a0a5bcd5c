"""SimHash near-duplicates by vantage-point trees.

Fingerprints are partitioned by their Hamming distance from vantage points.  A node
sends a fingerprint inward when it is nearer than the node's radius and outward when
it is not; by the triangle inequality only those less than the link distance inside
the radius can have a partner outside, and they go to both sides.  So each pair within
the link distance meets in some shard.  A shard finds its exact pairs by a tree of its
own and gives back its components as stars, never its pairs; the stars are joined into
components by rounds of Spark joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.shared import free_name, stored, text_or_empty

SHINGLE = 3
MAX_BITS = 2
SEED = 42

SHARD_ROWS = 4096  # fingerprints a shard is meant to hold
SAMPLE_PER_SHARD = 32  # sampled fingerprints the tree is built on, for each shard
MAX_SHARDS = 1 << 14
LEAF_ROWS = 256  # compared one with another inside a shard


# ---- fingerprints


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words of the text with A-Z in lower case, as UTF-8; blank, tab, line and page breaks part them."""
    return text.encode().translate(LOWER).split()


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """A bit is set when more than half of the shingles' hashes have it; no word gives zero."""
    words = words_of(text)
    if not words:
        return 0
    hash_of, seed = xxhash.xxh64_intdigest, SEED
    if len(words) <= shingle:
        return hash_of(b" ".join(words), seed)
    runs = zip(*(words[i:] for i in range(shingle)))
    hashes = np.array([hash_of(b" ".join(run), seed) for run in runs], "<u8")
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 14):
        part = hashes[start : start + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    """(id, key, fp) of every row; fp holds the 64 bits as a signed integer, key is a hash of the text."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found.view(np.int64))], schema=schema)

    text = text_or_empty(text_column)
    asked = df.select(F.col(id_column).cast("bigint").alias("id"), text_key(text).alias("key"), text.alias("text"))
    return asked.mapInArrow(run, "id bigint, key bigint, fp bigint")


def text_key(text: Column) -> Column:
    """Tells apart the texts of rows that share an id."""
    return F.xxhash64(text)


# ---- vantage-point trees


@dataclass
class Node:
    """``inside`` holds distances below ``radius`` from the vantage point, ``outside`` the others; a leaf has a number."""

    vantage: int = 0
    radius: int = 0
    inside: Node | None = None
    outside: Node | None = None
    leaf: int = -1


def distances(points: np.ndarray, vantage: int) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(vantage))


def choose_split(points: np.ndarray, reach: int, tries: int = 8) -> tuple[int, int] | None:
    """Vantage point and radius that leave the larger side smallest, what goes to both sides counted; None when no
    split makes both sides clearly smaller."""
    best, found = 0.85 * len(points), None
    for place in np.linspace(0, len(points) - 1, tries).astype(int):
        vantage = int(points[place])
        counts = np.bincount(distances(points, vantage), minlength=65)
        below = np.concatenate([[0], np.cumsum(counts)])  # below[r]: nearer than r
        for radius in range(1, 65):
            larger = max(below[radius], len(points) - below[max(0, radius - reach)])
            if 0 < below[radius] and larger < best:
                best, found = larger, (vantage, radius)
    return found


def build_tree(points: np.ndarray, leaves: int, reach: int) -> tuple[Node, int]:
    """A tree over sampled points with up to ``leaves`` leaves; also their number."""
    counter = 0

    def grow(part: np.ndarray, wanted: int) -> Node:
        nonlocal counter
        split = choose_split(part, reach) if wanted > 1 and len(part) >= 16 else None
        if split is None:
            counter += 1
            return Node(leaf=counter - 1)
        far = distances(part, split[0])
        inside, outside = part[far < split[1]], part[far >= split[1] - reach]
        half = max(1, round(wanted * len(inside) / (len(inside) + len(outside))))
        return Node(*split, grow(inside, half), grow(outside, max(1, wanted - half)))

    return grow(points, leaves), counter


def route(node: Node, points: np.ndarray, reach: int, rows: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, places of the points that go there); a point near a radius from inside goes both ways."""
    rows = np.arange(len(points)) if rows is None else rows
    if not len(rows):
        return
    if node.leaf >= 0:
        yield node.leaf, rows
        return
    far = distances(points[rows], node.vantage)
    yield from route(node.inside, points, reach, rows[far < node.radius])
    yield from route(node.outside, points, reach, rows[far >= node.radius - reach])


class Roots:
    """Union-find over places 0..n-1; the smallest place of a set is its root."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, place: int) -> int:
        parent = self.parent
        while parent[place] != place:
            parent[place] = parent[parent[place]]
            place = parent[place]
        return place

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def link_shard(points: np.ndarray, reach: int, roots: Roots, rows: np.ndarray | None = None) -> None:
    """Joins all places within ``reach`` bits of each other, by splitting down to small parts."""
    rows = np.arange(len(points)) if rows is None else rows
    split = choose_split(points[rows], reach) if len(rows) > LEAF_ROWS else None
    if split is not None:
        far = distances(points[rows], split[0])
        link_shard(points, reach, roots, rows[far < split[1]])
        link_shard(points, reach, roots, rows[far >= split[1] - reach])
        return
    part, label = points[rows], np.arange(len(rows))
    for start in range(0, len(rows), LEAF_ROWS):
        block = part[start : start + LEAF_ROWS]
        near = np.triu(np.bitwise_count(block[:, None] ^ part[None, start:]) <= reach, 1)
        for a in np.flatnonzero(near.any(axis=1)).tolist():
            # All places near one other become one set at once; pairs are never listed.
            met = np.flatnonzero(near[a]) + start
            sets = np.unique(np.append(label[met], label[start + a]))
            if len(sets) > 1:
                label[np.isin(label, sets)] = sets[0]
    for place in np.flatnonzero(label != np.arange(len(rows))).tolist():
        roots.join(int(rows[place]), int(rows[label[place]]))


# ---- the operator


def shard_links(unique: DataFrame, reach: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(node, root) stars of every shard over distinct fingerprints (fp, node); ``node`` tells fingerprints apart.

    The tree is built on a bounded sample, never more than an eighth of the rows; every
    row is sent through it.
    """
    rows = unique.count()
    shards = max(1, min(MAX_SHARDS, rows // shard_rows))
    share = min(SAMPLE_PER_SHARD * shards / max(rows, 1), 1 / 8)
    chosen = F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20))
    sample = [r[0] for r in unique.filter(chosen).select("fp").orderBy("fp").collect()] if shards > 1 else []
    tree, leaves = build_tree(np.array(sample, np.int64).view(np.uint64), shards, reach)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column("fp").to_numpy().view(np.uint64)
            for leaf, places in route(tree, points, reach):
                shard = pa.array(np.full(len(places), leaf, np.int32))
                picked = batch.take(pa.array(places))
                yield pa.RecordBatch.from_arrays([shard, *picked.columns], ["shard", "fp", "node"])

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        points = table.column("fp").to_numpy().view(np.uint64)
        nodes = table.column("node").to_numpy()
        roots = Roots(len(points))
        link_shard(points, reach, roots)
        root = np.array([roots.find(i) for i in range(len(points))], np.int64)
        linked = np.flatnonzero(root != np.arange(len(points)))
        return pa.table({"node": nodes[linked], "root": nodes[root[linked]]})

    sent = unique.select("fp", "node").mapInArrow(send, "shard int, fp bigint, node bigint")
    return sent.groupBy("shard").applyInArrow(link, "node bigint, root bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (node, root) but the roots: the smallest node it reaches.

    Rounds of two steps: every node tells its larger neighbours the smallest it knows,
    then its smaller ones.  The links become stars; the rounds end when nothing changes.
    Each round is a stored table.
    """
    edges = stored(links.distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
        large = both.join(least, "node").filter("root > node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        large = stored(large.distinct(), "links")
        # Every link of ``large`` leads from a larger node down.
        down = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(down, "node").select(
            F.explode(F.array(F.struct("node", F.col("least").alias("root")),
                              F.struct(F.col("root").alias("node"), F.col("least").alias("root")))).alias("e")
        ).select("e.*").filter("node > root")
        edges = stored(small.distinct(), "links")
        # A star forest has one link per node and no root that is itself linked; sums tell a change.
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return edges
        before = mark


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per input row: (id, fingerprint as 16 hex digits, component_id).

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id`` is the
    smallest id that links reach.  Null, empty and blank texts have fingerprint zero and
    link like any other.  Rows that share an id have each their own fingerprint; a null
    id takes no part and has no component.  A very long text is read whole, one at a time.
    Other columns are left out.  An empty table gives an empty result.
    """
    out = _with_components(df, id_column, text_column, shingle, max_bits, shard_rows)
    return out.select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def _with_components(
    df: DataFrame, id_column: str, text_column: str, shingle: int = SHINGLE, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(id, key, fp, component, component_id); components are found among fingerprints, whatever ids they share."""
    prints = stored(fingerprints(df, id_column, text_column, shingle), "fingerprints")
    unique = prints.filter("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("least"))
    unique = stored(unique.withColumn("node", F.col("fp")), "distinct_fingerprints")
    found = components(shard_links(unique, max_bits, shard_rows))
    placed = unique.join(found, "node", "left").withColumn("component", F.coalesce("root", "node"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return prints.join(placed.join(least, "component").select("fp", "component", "component_id"), "fp", "left")


def keep_one_of_each(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The input with one row of each component, that of the smallest id; rows without an id stay.

    Rows that share an id are told apart by their texts: each component keeps a row of its own. Of
    rows of one component that share its smallest id one stays, the same at every run but for equal rows.
    """
    found = _with_components(df, id_column, text_column, **options).filter("id IS NOT NULL")
    first = found.groupBy("component").agg(F.min(F.struct("id", "key")).alias("first"))
    stay_id, stay_key, key = (free_name(df.columns, n) for n in ("stay_id", "stay_key", "text_key"))
    kept = first.select(F.col("first.id").alias(stay_id), F.col("first.key").alias(stay_key))
    rows = df.withColumn(key, text_key(text_or_empty(text_column)))
    same = (rows[id_column].cast("bigint") == kept[stay_id]) & (rows[key] == kept[stay_key])
    stay = rows.join(kept, same, "left_semi").dropDuplicates([id_column, key]).select(*df.columns)
    return stay.unionByName(df.filter(F.col(id_column).isNull()))
