"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

A signature has ``POSITIONS`` positions, each the low ``BITS`` bits of a minimum over the
document's shingles; the distance of two signatures is the number of positions that differ.
Signatures are split into chunks.  By the pigeonhole principle two signatures that differ
in at most ``MAX_DIFFER`` positions have a chunk with one error at most.  The allowed
errors of a chunk are enumerated by leaving out each of its positions in turn: the other
positions are the key under which documents meet, so no pair within the distance is lost.

Documents meet by key, and pairs are never listed.  First each tries the nearest of its
keys' smallest members; what is confirmed on the full sets of shingles forms components.
Then members of one key in different components are compared by signature, and only who
takes part in a near pair is passed on, to cells of two blocks.  A cell holds the full
sets of its members against each other and gives back the few links that join components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.shared import RowBuffer, may_hold, stored, text_or_empty
from quarterdeck.llm.simhash import components, words_of

SHINGLE = 4
PERCENT = 80

POSITIONS = 48
BITS = 16
CHUNK = 4  # positions of a chunk
CHUNKS = POSITIONS // CHUNK
# With one error allowed in each chunk, 2 * CHUNKS errors are the fewest that can leave no chunk with one.  A pair
# of similarity 0.8 differs in a fifth of the positions on average, and in more than these 23 of 48 three times in
# a million; more similar pairs do so less often.
MAX_DIFFER = 2 * CHUNKS - 1

SET_SEED = 7
BLOCK_ROWS = 1024  # members of one key on either side of a comparison of signatures
HELD_ROWS = 1 << 20  # rows a task gathers before it drops repeats
BLOCK_NODES = 512  # sets of one block, two of which are compared in a task
BLOCK_SHINGLES = 1 << 18  # shingles of a block, on average, but for a larger set
SLICE_ROWS = 1 << 14  # pairs compared at once

# One multiplier and one summand for each position, from a fixed rule.
_RULE = np.random.Generator(np.random.PCG64(SHINGLE))
MULTIPLIERS = _RULE.integers(0, 1 << 63, POSITIONS, np.uint64) * np.uint64(2) + np.uint64(1)
SUMMANDS = _RULE.integers(0, 1 << 63, POSITIONS, np.uint64)


# ---- sets and signatures


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes, in order, of the text's runs of words; with fewer words, of the whole sequence."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    runs = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    hash_of = xxhash.xxh64_intdigest
    count = max(1, len(words) - shingle + 1)
    return np.unique(np.fromiter((hash_of(b" ".join(run), SET_SEED) for run in runs), np.uint64, count))


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 1 << 12):
        mixed = shingles[start : start + (1 << 12), None] * MULTIPLIERS + SUMMANDS
        np.minimum(least, mixed.min(axis=0), out=least)
    return least.astype("<u2")


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """All keys of each row of signatures: chunk, left-out position and the values of the others, side by side."""
    chunks = signatures.astype(np.int64).reshape(len(signatures), CHUNKS, CHUNK)
    keys = np.empty((len(signatures), CHUNKS, CHUNK), np.int64)
    for left_out in range(CHUNK):
        rest = [p for p in range(CHUNK) if p != left_out]
        key = np.arange(CHUNKS, dtype=np.int64) * CHUNK + left_out
        for position in rest:
            key = (key << BITS) | chunks[:, :, position]
        keys[:, :, left_out] = key
    return keys.reshape(len(signatures), -1)


def signatures_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, POSITIONS)


def may_link(sizes: np.ndarray, others: np.ndarray, percent: int) -> np.ndarray:
    """Sets of such sizes can reach the similarity at all."""
    return 100 * np.minimum(sizes, others) >= percent * np.maximum(sizes, others)


def enough_shared(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


# ---- tables


PRINTS = pa.schema(
    [("id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("signature", pa.binary())]
)


def prints(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, row, n, digest, signature) of ``docs`` (id, row, text); equal sets have equal digests, empty ones none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), shingle)
                sizes.append(len(shingles))
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            made = (pa.array(c, f.type) for c, f in zip((sizes, digests, signatures), list(PRINTS)[2:], strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), *made], schema=PRINTS)

    return docs.mapInArrow(run, "id long, row long, n long, digest binary, signature binary")


def key_rows(unique: DataFrame) -> DataFrame:
    """(key, node) for every key of every signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                keys = chunk_keys(signatures_of(batch.column("signature")))
                nodes = np.repeat(batch.column("node").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(nodes)], ["key", "node"])

    return unique.select("node", "signature").mapInArrow(run, "key long, node long")


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of the documents named by ``wanted`` (id, row, node); other texts are not moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = RowBuffer(pa.schema([("node", pa.int64()), ("shingles", pa.binary())]))
        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text"), strict=True):
                found = shingle_set(text.as_py(), shingle).tobytes()
                out.add(node, found, size=len(found))
                if out.full():
                    yield from out.take()
        yield from out.take()

    near = may_hold(docs, wanted, "row", "may").filter("may").drop("may").dropDuplicates(["id", "row"])
    return near.join(wanted, ["id", "row"]).select("node", "text").mapInArrow(run, "node long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) for ``pairs`` (a, b): whether their full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("set_a"), batch.column("set_b"), strict=True)
            as_array = lambda value: np.frombuffer(value.as_py(), np.uint64)
            linked = pa.array([enough_shared(as_array(x), as_array(y), percent) for x, y in both], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), linked], ["a", "b", "linked"])

    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.select("a", "b").join(first, "a").join(second, "b").mapInArrow(run, "a long, b long, linked boolean")


def nearest_centre(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): each node with the nearest, within the distance, of the smallest members of its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            ones, others = (signatures_of(batch.column(c)) for c in ("signature", "other_signature"))
            differ = (ones != others).sum(axis=1)
            sizes, other_sizes = (batch.column(c).to_numpy() for c in ("n", "other_n"))
            keep = np.flatnonzero((differ <= MAX_DIFFER) & may_link(sizes, other_sizes, percent))
            picked = [batch.column(c).take(pa.array(keep)) for c in ("node", "centre")]
            yield pa.RecordBatch.from_arrays([*picked, pa.array(differ[keep], pa.int32())], ["node", "centre", "differ"])

    met = members.filter("node != centre").select("node", "centre").distinct()
    other = nodes.select(F.col("node").alias("centre"), F.col("n").alias("other_n"), F.col("signature").alias("other_signature"))
    near = met.join(nodes.select("node", "n", "signature"), "node").join(other, "centre")
    near = near.mapInArrow(run, "node long, centre long, differ int")
    best = near.groupBy("node").agg(F.min(F.struct("differ", "centre")).alias("best"))
    return best.select(F.col("best.centre").alias("a"), F.col("node").alias("b"))


GROUP = ("key", "one", "two")
CELL = ("one", "two")


def group_numbers(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    """Numbers, from 0, of the runs of rows that agree in the named columns."""
    new = np.zeros(len(table), bool)
    for name in names:
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


def whole_groups(batches: Iterator[pa.RecordBatch], names: Sequence[str], rows: int) -> Iterator[pa.Table]:
    """The rows of sorted batches in tables of whole groups, about ``rows`` rows at a time or one larger group."""
    waiting: list[pa.RecordBatch] = []
    held = 0

    def pieces(last: bool) -> Iterator[pa.Table]:
        nonlocal waiting, held
        table = pa.Table.from_batches(waiting)
        starts = np.flatnonzero(np.diff(group_numbers(table, names), prepend=-1)).tolist()
        begin = 0
        for end in [*starts[1:], *([len(table)] if last else [])]:
            if end - begin >= rows or end == len(table):
                yield table.slice(begin, end - begin)
                begin = end
        # The last group may go on in the next batch.
        waiting, held = table.slice(begin).to_batches(), len(table) - begin

    for batch in batches:
        if len(batch):
            waiting.append(batch)
            held += len(batch)
            if held >= 2 * rows:
                yield from pieces(last=False)
    if waiting:
        yield from pieces(last=True)


def met_in_key(table: pa.Table, percent: int) -> np.ndarray:
    """Distinct (block, block, node): the nodes that have, in these groups, a partner in another component.

    A pair counts in the first key that both share, so it is met once however many they share.
    Rows ``step`` apart in one group are compared for all groups at once.
    """
    key, node, part, n, block = (table.column(c).to_numpy() for c in ("key", "node", "part", "n", "block"))
    asks, outside = (table.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "outside"))
    marks, group = signatures_of(table.column("signature")), group_numbers(table, GROUP)
    found = [np.zeros((0, 3), np.int64)]
    first, step, size = np.arange(len(node)), 0, 0
    while len(first):
        step += 1
        first = first[first + step < len(node)]
        first = first[group[first] == group[first + step]]
        other = first + step
        able = (asks[first] != asks[other]) & (part[first] != part[other]) & may_link(n[first], n[other], percent)
        ask, met = np.where(asks[first], first, other)[able], np.where(asks[first], other, first)[able]
        # Two outsiders ask each other; one of them is enough.
        once = ~outside[met] | (node[ask] < node[met])
        ask, met = ask[once], met[once]
        for start in range(0, len(ask), SLICE_ROWS):
            a, m = ask[start : start + SLICE_ROWS], met[start : start + SLICE_ROWS]
            differ = marks[a] != marks[m]
            near = np.flatnonzero(differ.sum(axis=1) <= MAX_DIFFER)
            a, m, errors = a[near], m[near], differ[near].reshape(-1, CHUNKS, CHUNK)
            chunk = np.argmax(errors.sum(axis=2) <= 1, axis=1)
            first_key = chunk * CHUNK + np.argmax(errors[np.arange(len(near)), chunk], axis=1)
            here = first_key == key[a] >> (BITS * (CHUNK - 1))
            a, m = a[here], m[here]
            low, high = np.minimum(block[a], block[m]), np.maximum(block[a], block[m])
            rows = np.concatenate([np.stack([low, high, node[a]], axis=1), np.stack([low, high, node[m]], axis=1)])
            found.append(rows)
            size += len(rows)
            if size > HELD_ROWS:
                found = [np.unique(np.concatenate(found), axis=0)]
                size = 0
    return np.unique(np.concatenate(found), axis=0)


def met_cells(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(one, two, node): for every two blocks the nodes of both that may link across components.

    ``nodes`` has (node, n, signature, block, part).  Of a key, the members outside its
    largest component meet all its members; members of one component do not meet.  Both
    sides are cut into parts of bounded size.  Pairs are not listed, only who takes part in one.
    """
    of = members.select("key", "node").join(nodes.select("node", "part"), "node")
    parts = of.groupBy("key", "part").agg(F.count("*").alias("size"))
    mixed = parts.groupBy("key").agg(
        F.count("*").alias("parts"), F.sum("size").alias("all"), F.max(F.struct("size", "part")).alias("most")
    ).filter("parts > 1")
    rows = of.drop("part").join(mixed, "key").join(nodes.select("node", "n", "signature", "block", "part"), "node")
    outside = F.col("part") != F.col("most.part")
    pieces, outside_pieces = (
        F.ceil(size / F.lit(BLOCK_ROWS)).cast("int") for size in (F.col("all"), F.col("all") - F.col("most.size"))
    )
    own = lambda count: F.pmod(F.xxhash64("node"), count).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    columns = ["key", "node", "part", "n", "block", "signature", outside.alias("outside")]
    asking = rows.filter(outside).select(*columns, F.lit(True).alias("asks"), own(outside_pieces).alias("one"), every(pieces).alias("two"))
    asked = rows.select(*columns, F.lit(False).alias("asks"), every(outside_pieces).alias("one"), own(pieces).alias("two"))
    grouped = asking.unionByName(asked).repartition(*GROUP).sortWithinPartitions(*GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros((0, 3), np.int64)]
        for table in whole_groups(batches, GROUP, BLOCK_ROWS):
            # The keys of one task repeat each other; a bounded number of rows waits for its repeats.
            held.append(met_in_key(table, percent))
            if sum(map(len, held)) > HELD_ROWS:
                held = [np.unique(np.concatenate(held), axis=0)]
                if 2 * len(held[0]) > HELD_ROWS:
                    yield by_cell(held.pop())
                    held.append(np.zeros((0, 3), np.int64))
        yield by_cell(np.unique(np.concatenate(held), axis=0))

    cells = grouped.mapInArrow(run, "one long, two long, nodes array<long>")
    # A node is listed once for each of its keys at most, so the list of a cell is bounded as its blocks are.
    listed = cells.groupBy(*CELL).agg(F.array_distinct(F.flatten(F.collect_list("nodes"))).alias("nodes"))
    return listed.select(*CELL, F.explode("nodes").alias("node"))


def by_cell(rows: np.ndarray) -> pa.RecordBatch:
    """Sorted (one, two, node) as one row for each cell with the list of its nodes."""
    starts = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])[: len(rows)])
    offsets = pa.array(np.append(starts, len(rows)), pa.int32())
    nodes = pa.ListArray.from_arrays(offsets, pa.array(rows[:, 2]))
    return pa.RecordBatch.from_arrays([pa.array(rows[starts, 0]), pa.array(rows[starts, 1]), nodes], ["one", "two", "nodes"])


def link_cell(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """(node, root) links that join the components of one cell, confirmed on the full sets.

    Each node is held at once against all nodes of the other block that are near and not yet in its component.
    """
    node, part, n, block, one, two = (table.column(c).to_numpy() for c in ("node", "part", "n", "block", "one", "two"))
    marks = signatures_of(table.column("signature"))
    shingles = np.frombuffer(b"".join(table.column("shingles").to_pylist()), np.uint64)
    distinct, codes = np.unique(shingles, return_inverse=True)
    ends = np.cumsum(n)
    label, has, links = part.copy(), np.zeros(len(distinct), bool), []
    # In a cell of two blocks the nodes of one ask those of the other.
    asking = np.flatnonzero(block == one)
    other = np.flatnonzero(block == two)
    for i in asking.tolist():
        met = other[other > i] if one[0] == two[0] else other
        met = met[(label[met] != label[i]) & may_link(n[met], n[i], percent)]
        met = met[(marks[met] != marks[i]).sum(axis=1) <= MAX_DIFFER]
        if not len(met):
            continue
        mine = codes[ends[i] - n[i] : ends[i]]
        has[mine] = True
        theirs = has[np.concatenate([codes[ends[j] - n[j] : ends[j]] for j in met.tolist()])]
        has[mine] = False
        shared = np.add.reduceat(theirs.astype(np.int64), np.cumsum(n[met]) - n[met])
        for j in met[100 * shared >= percent * (n[i] + n[met] - shared)].tolist():
            if label[j] != label[i]:
                links.append((int(max(node[i], node[j])), int(min(node[i], node[j]))))
                label[label == label[j]] = label[i]
    return links


def links_across(members: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, root): links that join components which any pair within the distance links.

    A set is sent once to each cell its node takes part in, not once for each partner.
    """
    wanted = met_cells(members, nodes, percent)
    carried = nodes.select("node", "part", "n", "block", "signature").join(sets, "node")
    cells = wanted.join(carried, "node").repartition(*CELL).sortWithinPartitions(*CELL, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, CELL, 1):
            if links := link_cell(table, percent):
                arrays = [pa.array(c, pa.int64()) for c in zip(*links, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "root"])

    return cells.mapInArrow(run, "node long, root long")


def with_blocks(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``nodes`` and ``block``: nodes whose keys have the same smallest member lie in few blocks, of bounded
    numbers of nodes and shingles."""
    homes = members.groupBy("node").agg(F.min("centre").alias("home"))
    at_home = nodes.join(homes, "node")
    sizes = at_home.groupBy("home").agg(
        F.greatest(F.sum("n") / F.lit(BLOCK_SHINGLES), F.count("*") / F.lit(BLOCK_NODES)).alias("wanted")
    )
    place = F.pmod(F.xxhash64("node"), F.ceil("wanted"))
    return at_home.join(sizes, "home").withColumn("block", F.xxhash64("home", place)).select(*nodes.columns, "block")


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per input row: (id, n_shingles, component_id, kept).

    A document's set holds its distinct runs of ``shingle`` words; with fewer words, all of them as one run.
    Two documents link when their sets share ``percent`` percent of their union, counted on the full
    sets of 64-bit hashes.  ``component_id`` is the smallest id that links reach, ``kept`` marks
    the documents it names.

    Null, empty and blank texts have an empty set and link with nothing, not with each
    other.  Rows that share an id have each their own set and component; equal rows are
    alike.  A row without an id takes no part: it has no component and is kept.  A very
    long text is read whole, one at a time; memory follows the longest text.  Other
    columns are left out, so their names cannot clash.  An empty table gives an empty result.
    """
    docs = df.select(F.col(id_column).cast("bigint").alias("id"), text_or_empty(text_column).alias("text"))
    docs = docs.withColumn("row", F.xxhash64("text"))
    rows = stored(prints(docs.select("id", "row", "text"), shingle), "prints")
    one = rows.filter("id IS NOT NULL AND n > 0").groupBy("digest", "n", "signature")
    unique = one.agg(F.min(F.struct("id", "row")).alias("first")).select("digest", "n", "signature", "first.*")
    unique = stored(unique.withColumn("node", F.monotonically_increasing_id()), "sets")

    keys = key_rows(unique)
    shared = keys.groupBy("key").agg(F.count("*").alias("met"), F.min("node").alias("centre")).filter("met > 1")
    members = stored(keys.join(shared.select("key", "centre"), "key"), "members")
    meeting = members.select("node").distinct()
    nodes = stored(with_blocks(unique.join(meeting, "node", "left_semi"), members), "nodes")
    sets = stored(full_sets(docs, nodes.select("id", "row", "node"), shingle), "full_sets")

    star = confirmed(nearest_centre(members, nodes, percent), sets, percent).filter("linked")
    links = components(star.select(F.col("b").alias("node"), F.col("a").alias("root")))
    parted = nodes.join(links, "node", "left").withColumn("part", F.coalesce("root", "node")).drop("root")
    parted = stored(parted, "parted")
    more = stored(links_across(members, parted, sets, percent), "links")
    if not more.isEmpty():
        links = components(links.unionByName(more))

    placed = unique.select("node", "digest", "id").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    named = placed.join(least, "root").select(F.col("digest").alias("set_digest"), "component_id")
    out = rows.select("id", "n", "digest").join(named, F.col("digest") == F.col("set_digest"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
