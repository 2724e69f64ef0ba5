"""Near-duplicate documents by MinHash: a multi-index Hamming join over b-bit signatures.

A signature has ``chunks * width`` symbols, each the low 16 bits of one minimum hash of the document's
shingle set. Two signatures that differ in at most ``reach`` symbols have, by the pigeonhole principle, a
chunk with at most ``errors`` differing symbols. The index therefore holds, for every chunk, one key for
each way to leave ``errors`` of its symbols out: all pairs within ``reach`` share a key. Pairs that share a
key and whose distance a pair of the wanted similarity can plausibly have are confirmed on the full shingle
sets.

At scale: copies of one shingle set are one node from the start (combined on the map side); an id with several sets
has a node for each of them, and its nodes are linked afterwards. Bucket sizes and
minima are combined on the map side too. Each bucket first links its members to its smallest one, which
settles groups of near copies at linear cost; only buckets whose members are still in different components
are compared further, in blocks of bounded size, by one bucket for each pair, and only links leave a task.
No list of links, components or signatures reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapgrid.llm import textkit as tk
from snapgrid.llm.frames import connected_components, sized_join, sorted_groups, tidy
from snapgrid.session import materialize


@dataclass(frozen=True)
class Settings:
    """Similarity ``percent`` / 100 or more links two documents."""

    percent: int = 80
    words: int = 5
    chunks: int = 10
    width: int = 5
    errors: int = 1
    block: int = 2048

    @property
    def symbols(self) -> int:
        return self.chunks * self.width

    @property
    def reach(self) -> int:
        """Every pair of signatures that differ in at most so many symbols shares a key."""
        return self.chunks * (self.errors + 1) - 1

    @property
    def cut(self) -> int:
        """Distances above this have a chance under one in a million at the wanted similarity."""
        n, p = self.symbols, 1 - self.percent / 100
        left = 1.0
        for d in range(n + 1):
            left -= math.comb(n, d) * p**d * (1 - p) ** (n - d)
            if left < 1e-6:
                return max(d, self.reach)
        return n

    @property
    def slots(self) -> list[tuple[int, tuple[int, ...]]]:
        """Chunk and left-out symbols of every key."""
        left_out = list(combinations(range(self.width), self.errors))
        return [(c, skip) for c in range(self.chunks) for skip in left_out]

    def linked(self, both, total):
        """Whether sets with ``both`` common and ``total`` elements in all are similar enough."""
        return 100 * both >= self.percent * total


_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, 1 << 10, dtype=np.uint64) | np.uint64(1)


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, with the texts' borders.

    Words are lower-cased in ASCII and separated by white space. Null, empty and blank texts have empty sets;
    a text of fewer words has its whole sequence as its only shingle.
    """
    data, offsets = tk.texts(column)
    low = tk.LOWER[data]
    starts, ends, first = tk.runs(low, offsets, tk.NOT_SPACE)
    hashes, borders = tk.shingles(tk.run_hashes(low, starts, ends), first, words)
    return tk.distinct_per_group(hashes, borders)


def signatures(values: np.ndarray, borders: np.ndarray, symbols: int) -> np.ndarray:
    """Low 16 bits of ``symbols`` minimum hashes of each set; zeros for an empty set."""
    full = np.flatnonzero(np.diff(borders))
    out = np.zeros((len(borders) - 1, symbols), np.uint16)
    if len(full):
        for k in range(symbols):
            hashed = values * _FACTORS[k]
            hashed ^= hashed >> np.uint64(32)
            out[full, k] = (np.minimum.reduceat(hashed, borders[:-1][full]) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def _binary(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape[0], matrix.shape[1] * matrix.itemsize
    offsets = pa.py_buffer(np.arange(rows + 1, dtype=np.int32) * np.int32(width))
    return pa.Array.from_buffers(pa.binary(), rows, [None, offsets, pa.py_buffer(np.ascontiguousarray(matrix))])


def _matrix(column: pa.Array, symbols: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, symbols)


def sketches(
    documents: DataFrame, settings: Settings, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_hash`` (16 bytes), ``signature``, and ``text`` if wanted, of every row, in one pass."""
    kept = ["text"] if keep_text else []

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch, "text"):
                values, borders = shingle_sets(part.column("text"), settings.words)
                sums = []
                for factor in _FACTORS[-2:]:
                    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tk.mix(values * factor))])
                    sums.append(running[borders[1:]] - running[borders[:-1]])
                sizes = np.diff(borders).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes),
                        _binary(np.stack([sums[0] + sizes.astype(np.uint64), sums[1]], axis=1)),
                        _binary(signatures(values, borders, settings.symbols)),
                        *[part.column(c) for c in kept],
                    ],
                    ["doc_id", "n_shingles", "set_hash", "signature", *kept],
                )

    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, set_hash binary, signature binary" + "".join(f", {c} string" for c in kept)
    return source.mapInArrow(tidy(sketch), schema)


def _set_node() -> Column:
    """Number of a set whose smallest id has other sets too."""
    return F.xxhash64("set_hash")


def index_keys(nodes: DataFrame, settings: Settings) -> DataFrame:
    """``key``, ``node`` for every slot of every signature; the low 8 bits of a key are its slot."""
    slots = settings.slots

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            symbols = _matrix(batch.column("signature"), settings.symbols).astype(np.uint64)
            node = batch.column("node").to_numpy()
            for slot, (chunk, skip) in enumerate(slots):
                total = np.full(len(node), slot + 1, np.uint64) * _FACTORS[-3]
                for at in range(settings.width):
                    if at not in skip:
                        total += (symbols[:, chunk * settings.width + at] + np.uint64(1)) * _FACTORS[-4 - at]
                key = (tk.mix(total) & np.uint64(0xFFFFFFFFFFFFFF00)) | np.uint64(slot)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(node)], ["key", "node"])

    if len(slots) > 256:
        raise ValueError("at most 256 keys a document")
    return nodes.select("node", "signature").mapInArrow(tidy(keys), "key long, node long")


# ---------------------------------------------------------------- confirming pairs


def _intersections(values: np.ndarray, borders: np.ndarray):
    """A function from a set's number to the sizes of its intersections with all sets."""
    _, ids = np.unique(values, return_inverse=True)
    marks = np.zeros(int(ids.max()) + 1, bool)

    def with_all(x: int) -> np.ndarray:
        own = ids[borders[x] : borders[x + 1]]
        marks[own] = True
        found = np.add.reduceat(marks[ids], borders[:-1], dtype=np.int64)
        marks[own] = False
        return found

    return with_all


def _star_links(settings: Settings):
    """Rows of two texts: the pairs whose full sets are similar."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch, "text"):
                kept = []
                left = shingle_sets(part.column("center_text"), settings.words)
                right = shingle_sets(part.column("text"), settings.words)
                for i in range(part.num_rows):
                    x = left[0][left[1][i] : left[1][i + 1]]
                    y = right[0][right[1][i] : right[1][i + 1]]
                    merged = np.concatenate([x, y])
                    merged.sort()
                    both = int((merged[1:] == merged[:-1]).sum())
                    kept.append(bool(settings.linked(both, len(merged) - both)))
                yield part.select(["center", "node"]).filter(pa.array(kept, pa.bool_()))

    return confirm


def _near(part: np.ndarray, slot: np.ndarray, x: int, settings: Settings) -> np.ndarray:
    """Which rows after x are within the cut of row x and have this slot as their first common one."""
    chunk, skip = settings.slots[int(slot)]
    differ = part[x + 1 :] != part[x]
    by_chunk = differ.reshape(len(differ), settings.chunks, settings.width)
    errors = by_chunk.sum(2)
    first = np.argmax(errors <= settings.errors, axis=1)
    own = (first == chunk) & (errors.sum(1) <= settings.cut)
    rows = np.flatnonzero(own)
    if len(rows):
        # Of the slots of that chunk, the first that leaves out every differing symbol.
        left_out = [s for c, s in settings.slots if c == chunk]
        inside = by_chunk[rows, chunk]
        fits = np.stack([~inside[:, [i for i in range(settings.width) if i not in s]].any(1) for s in left_out], 1)
        rows = rows[np.argmax(fits, axis=1) == left_out.index(skip)]
    return rows + x + 1


def _tested(group: pa.RecordBatch, settings: Settings):
    """For each row of a block: the later rows it has to be compared with in this block."""
    symbols = _matrix(group.column("signature"), settings.symbols)
    slot = group.column("key")[0].as_py() & 0xFF
    component = group.column("component").to_numpy()
    own = group.column("own").to_numpy()
    across = group.column("low")[0].as_py() != group.column("high")[0].as_py()
    for x in range(group.num_rows - 1):
        rows = _near(symbols, slot, x, settings)
        rows = rows[component[rows] != component[x]]
        if across:  # pairs inside a part are compared where that part meets itself
            rows = rows[own[rows] != own[x]]
        yield x, rows


_BLOCK_KEYS = ["key", "low", "high"]


def _flag_rows(settings: Settings):
    """Rows of blocks that take part in any comparison; the rest need no text."""

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, _BLOCK_KEYS):
            needed = np.zeros(group.num_rows, bool)
            for x, rows in _tested(group, settings):
                if len(rows):
                    needed[x] = True
                    needed[rows] = True
            if needed.any():
                yield group.filter(pa.array(needed))

    return flag


def _block_links(settings: Settings):
    """Links of each block that join what its earlier links and the components have not joined."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, _BLOCK_KEYS):
            values, borders = shingle_sets(group.column("text"), settings.words)
            if (np.diff(borders) == 0).any():
                raise ValueError("a document without shingles has no place in the index")
            sizes, with_all = np.diff(borders), _intersections(values, borders)
            node = group.column("node").to_numpy()
            joined = np.unique(group.column("component").to_numpy(), return_inverse=True)[1]
            out = []
            for x, rows in _tested(group, settings):
                rows = rows[joined[rows] != joined[x]]
                if not len(rows):
                    continue
                both = with_all(x)[rows]
                for y in rows[settings.linked(both, sizes[rows] + sizes[x] - both)].tolist():
                    if joined[y] != joined[x]:
                        joined[joined == joined[y]] = joined[x]
                        out.append((int(node[x]), int(node[y])))
            if out:
                pairs = np.array(out, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["center", "node"])

    return confirm


# ---------------------------------------------------------------- the join


def links(members: DataFrame, documents: DataFrame, settings: Settings) -> DataFrame:
    """``a``, ``b``: enough links between different shingle sets to connect all that are similar.

    ``members`` has ``doc_id``, ``rep`` (smallest document of the same set), ``node`` (the set), ``mixed`` (whether
    that document has other sets too) and ``signature``; ``documents`` has ``doc_id`` and ``text``.
    """
    nodes = members.where(F.col("doc_id") == F.col("rep")).select("node", "rep", "mixed", "signature")
    nodes = nodes.dropDuplicates(["node"])
    keys = index_keys(nodes, settings)
    buckets = keys.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("size")).where("size > 1")
    shared = materialize(keys.join(buckets, "key"), "dedup-shared")
    signature = materialize(
        nodes.join(shared.select("node").distinct(), "node", "left_semi"), "dedup-signatures"
    )
    of_node = signature.select("node", "signature")
    own = signature.where("not mixed").select(F.col("node").alias("doc_id"))
    texts = sized_join(documents.select("doc_id", "text"), own, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    texts = texts.select(F.col("doc_id").alias("node"), "text")
    of_mixed = signature.where("mixed").select(F.col("rep").alias("doc_id")).distinct()
    if not of_mixed.isEmpty():  # the text that a set comes from
        several = sized_join(documents.select("doc_id", "text"), of_mixed, "doc_id", "left_semi").distinct()
        several = sketches(several, settings, keep_text=True).select(_set_node().alias("node"), "text")
        several = sized_join(several, signature.where("mixed").select("node"), "node", "left_semi")
        texts = texts.unionAll(several.dropDuplicates(["node"]))
    texts = materialize(texts, "dedup-texts")

    def distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("signature"), settings.symbols)
                y = _matrix(batch.column("center_signature"), settings.symbols)
                yield batch.select(["center", "node"]).filter(pa.array((x != y).sum(1) <= settings.cut))

    of_center = signature.select(F.col("node").alias("center"), F.col("signature").alias("center_signature"))
    pairs = shared.where("node <> center").select("center", "node").distinct()
    pairs = pairs.join(of_node, "node").join(of_center, "center").mapInArrow(tidy(distance), "center long, node long")
    of_center = texts.select(F.col("node").alias("center"), F.col("text").alias("center_text"))
    star = materialize(
        pairs.join(texts, "node").join(of_center, "center").mapInArrow(tidy(_star_links(settings)), "center long, node long"),
        "dedup-star",
    )
    found = connected_components(star, "center", "node", "dedup-star")

    placed = shared.join(found, "node", "left").select(
        "key", "node", "size", F.coalesce("component", "node").alias("component")
    )
    placed = materialize(placed, "dedup-placed")
    spread = placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    open_keys = spread.where("a <> b").select("key")
    parts = F.ceil(F.col("size") / settings.block).cast("int")
    blocks = (
        placed.where("size > 2")
        .join(open_keys, "key", "left_semi")
        .join(of_node, "node")
        .withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "key",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "node",
            "own",
            "component",
            "signature",
        )
    )
    schema = "key long, low int, high int, node long, own int, component long, signature binary"
    columns = [c.split()[0] for c in schema.split(", ")]
    flagged = _by_block(blocks.select(*columns)).mapInArrow(tidy(_flag_rows(settings)), schema)
    flagged = materialize(flagged, "dedup-blocks")
    more = _by_block(flagged.join(texts, "node").select(*columns, "text")).mapInArrow(
        tidy(_block_links(settings)), "center long, node long"
    )
    return star.unionAll(more).select(F.col("center").alias("a"), F.col("node").alias("b"))


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_BLOCK_KEYS).sortWithinPartitions(*_BLOCK_KEYS, "node")


def near_duplicates(
    documents: DataFrame, settings: Settings | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``documents``.

    ``component_id`` is the smallest id reachable over links, ``kept`` marks the document that has it. Null,
    empty and blank texts have no shingles and are linked with nothing. Rows of one id are one document: copies
    of a row get equal results, and differing texts under one id count as linked. A null id is linked with
    nothing: its component is null and it is kept. Texts of any length count whole; an empty table gives no rows. Other
    columns are not read.
    """
    settings = settings or Settings()
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketch = materialize(sketches(source, settings), "dedup-sketches")
    full = F.col("n_shingles") > 0
    known = sketch.where(F.col("doc_id").isNotNull())
    mixed = known.groupBy("doc_id").agg(F.min("set_hash").alias("low"), F.max("set_hash").alias("high")).where("low <> high")
    mixed = materialize(mixed.select("doc_id"), "dedup-mixed")
    reps = known.where(full).groupBy("set_hash").agg(F.min("doc_id").alias("rep"))
    marked = mixed.select(F.col("doc_id").alias("rep"), F.lit(True).alias("mixed"))
    reps = sized_join(reps, marked, "rep", "left").withColumn("mixed", F.coalesce("mixed", F.lit(False)))
    reps = reps.withColumn("node", F.when(F.col("mixed"), _set_node()).otherwise(F.col("rep")))
    own = full & F.col("doc_id").isNotNull()
    members = sketch.join(reps, "set_hash", "left").select(
        "doc_id", "n_shingles", *[F.when(own, F.col(c)).alias(c) for c in ("rep", "node", "mixed")], "signature"
    )
    members = materialize(members.withColumn("signature", F.expr("if(doc_id = rep, signature, null)")), "dedup-members")
    alike = links(members, source, settings)
    # Only ids with several sets have something to link here.
    of_mixed = sized_join(members.where("node is not null"), mixed, "doc_id", "left_semi").select("doc_id", "node").distinct()
    least = of_mixed.groupBy("doc_id").agg(F.min("node").alias("b"))
    same_id = of_mixed.join(least, "doc_id").select(F.col("node").alias("a"), "b")
    component = connected_components(alike.unionAll(same_id), "a", "b", "dedup-all")
    if not mixed.isEmpty():  # nodes of such ids are no ids: a component is named by its smallest id
        ids = members.where("doc_id = rep").select("node", "rep").distinct()
        component = materialize(component.join(ids, "node"), "dedup-named")
        named = component.groupBy("component").agg(F.min("rep").alias("least"))
        component = component.join(named, "component").select("node", F.col("least").alias("component"))
    label = F.coalesce("component", "rep", "doc_id")
    return members.join(component, "node", "left").select(
        "doc_id",
        "n_shingles",
        label.alias("component_id"),
        F.coalesce(label == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
