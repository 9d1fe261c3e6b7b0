"""SimHash near-duplicates by tiled exact comparison of fingerprints.

The population counts of a fingerprint's parts (four of 16 bits, say) name its tile. Two fingerprints that differ in r bits
have counts that differ by at most r in sum, so only such tiles are compared, and every pair within the radius is compared:
the result is exact. Tiles are cut into blocks of bounded size; a task compares one block with one block by exclusive-or
and bit counts. For a wide radius, at which counts prune nothing, tiles are the texts that share a band of their sketches, the
smallest hashes of 64 bins of shingles; every pair of a tile within the radius is also held against both sketches, in the same
task. Such pairs are only candidates: the components they form are cut into blocks, and two texts are
linked only if the exact Jaccard similarity of their whole shingle sets reaches the bound.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from spotshare.llm.common import batch_of, encoded, lean, slices
from spotshare.llm.components import components
from spotshare.plans.staging import join_side, write_stage

BLOCK = 2048  # fingerprints in a block of a tile
BINS = 64  # bytes of a sketch
BAND = 4  # bins in a band
_NONE = np.iinfo(np.uint64).max
WIDE = 20  # bits: pairs of similarity 0.8 differ in 9.7, with a deviation of 2.9
AGREEMENT = 0.6  # of two sketches: four deviations below 0.8
SIMILARITY = 0.8  # Jaccard, of whole shingle sets
SETS = 1024  # shingle sets in a block of a component of candidates
SHINGLES = 1 << 18  # in all sets of such a block, about
_PAIRS_AT_ONCE = 1 << 18
_HASHES_AT_ONCE = 1 << 16


def _hashes(text: bytes, words: int) -> Iterator[int]:
    """XXH64 (seed 42) of the word shingles of a text, in order; a text of fewer words is one shingle."""
    w = text.lower().split()
    if not w:
        return iter(())
    if len(w) < words:
        return iter((xxhash.xxh64_intdigest(b" ".join(w), 42),))
    return (xxhash.xxh64_intdigest(s, 42) for s in map(b" ".join, zip(*(w[i:] for i in range(words)))))


def _parts(hashes: Iterator[int]) -> Iterator[np.ndarray]:
    while len(part := np.fromiter(itertools.islice(hashes, _HASHES_AT_ONCE), dtype=np.uint64)):
        yield part


def _minima(parts: Iterable[np.ndarray]) -> tuple[int, np.ndarray]:
    """The SimHash of hashes that come in parts, and the smallest of each bin; the largest number where there is none."""
    total, ones, low = 0, np.zeros(64, dtype=np.int64), np.full(BINS, _NONE, dtype=np.uint64)
    for part in parts:
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        for i in range(0, len(bits), 255):
            ones += bits[i : i + 255].sum(axis=0, dtype=np.uint8)
        np.minimum.at(low, (part % np.uint64(BINS)).astype(np.int64), part // np.uint64(BINS))
        total += len(part)
    return int(np.packbits(2 * ones > total).view(">u8")[0]), low


def _sketch(low: np.ndarray) -> bytes:
    return np.where(low == _NONE, 0, 1 + low % np.uint64(255)).astype(np.uint8).tobytes()


def _print_of(parts: Iterable[np.ndarray]) -> tuple[int, bytes]:
    """The SimHash and the sketch of hashes that come in parts."""
    found, low = _minima(parts)
    return found, _sketch(low)


def _bands(low: np.ndarray) -> list[int]:
    """A key for each BAND bins in a row that hold something: texts of similarity 0.8 lack a common one of the 16 with 0.0002."""
    rows = low.reshape(-1, BAND)
    held = np.flatnonzero((rows != _NONE).any(1))
    return [xxhash.xxh64_intdigest(rows[b].tobytes(), int(b)) - (1 << 63) for b in held]


def fingerprint(text: bytes, words: int = 3) -> tuple[int, bytes]:
    """The SimHash of a text, and a sketch of its shingles.

    SimHash: bits that are set in over half of the XXH64 (seed 42) of its word shingles; 0 without words. Sketch: the shingles'
    hashes are dealt over BINS bins, and each keeps a byte of its smallest; 0 where there is none.
    """
    return _print_of(_parts(_hashes(text, words)))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The different hashes of a text's word shingles, sorted; none without words."""
    return np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *_parts(_hashes(text, words))]))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (64 bits as a signed long) and ``sketch`` of every row; a NULL text is empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.int64()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(t, words) for t in encoded(batch.column(1))]
            prints = np.array([f for f, _ in found], dtype=np.uint64)
            yield batch_of(schema, doc_id=batch.column(0), fingerprint=prints.view(np.int64), sketch=[k for _, k in found])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        lean(run), "doc_id long, fingerprint long, sketch binary")


def _near_tiles(radius: int, parts: int) -> list[tuple[int, ...]]:
    """Differences of the parts' counts within the radius: none, or the first that differs is positive."""
    steps = [d for d in itertools.product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
    return [d for d in steps if d >= (0,) * parts]


def _forest(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links (a of left, b of right) with the smallest node it reaches through them."""
    nodes, ends = np.unique(np.concatenate((left[a], right[b])), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _alike(one: np.ndarray, other: np.ndarray, agreement: float) -> np.ndarray:
    """Which rows of two tables of sketches agree in that share of the bins that either has filled."""
    filled = np.maximum((one != 0).sum(1, dtype=np.int32), 0) + ((one == 0) & (other != 0)).sum(1, dtype=np.int32)
    same = ((one == other) & (one != 0)).sum(1, dtype=np.int32)
    return same >= agreement * filled


def _links(nodes_a, prints_a, sketches_a, nodes_b, prints_b, sketches_b, radius: int, agreement: float, rows: int = 256):
    """A spanning forest of the links between two blocks: never more links than nodes."""
    found_a, found_b = [nodes_a[:0]], [nodes_a[:0]]
    for i in range(0, len(nodes_a), rows):
        a, b = np.nonzero(np.bitwise_count(prints_a[i : i + rows, None] ^ prints_b[None, :]) <= radius)
        if agreement and len(a):
            parts = [slice(k, k + _PAIRS_AT_ONCE) for k in range(0, len(a), _PAIRS_AT_ONCE)]
            alike = np.concatenate([_alike(sketches_a[i + a[p]], sketches_b[b[p]], agreement) for p in parts])
            a, b = a[alike], b[alike]
        if len(a):
            nodes, roots = _forest(nodes_a[i : i + rows], nodes_b, a, b)
            found_a.append(nodes)
            found_b.append(roots)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    if len(found_a) > 2:
        nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
        a, b = _forest(nodes, nodes, ends[: len(a)], ends[len(a) :])
    apart = a != b
    return a[apart], b[apart]


def _tile(print_: Column, parts: int) -> Column:
    """The counts of the parts, a byte each."""
    name, width = F.lit(0).cast("long"), 64 // parts
    for q in range(parts):
        part = F.shiftrightunsigned(print_, width * q)
        count = F.bit_count(part.bitwiseAND(F.lit((1 << width) - 1).cast("long")) if parts > 1 else part)
        name = name + count.cast("long") * (1 << 8 * q)
    return name


def near_links(
    prints: DataFrame, radius: int = 3, parts: int = 4, agreement: float = 0.0, block: int = BLOCK, tiles: DataFrame | None = None
) -> DataFrame:
    """Links ``a``, ``b`` between different nodes of ``prints`` (``node`` long, ``fingerprint``, ``sketch``) whose fingerprints differ in at
    most ``radius`` bits, and whose sketches have ``agreement``. With ``tiles`` (``node``, ``tile``) only nodes of a tile are compared.

    Each pair of blocks returns a spanning forest of its links, so that a block of near copies yields as many links as it has
    nodes; the components of the result are those of all links.
    """
    own = prints.select("node", "fingerprint", "sketch")
    own = own.withColumn("tile", _tile(F.col("fingerprint"), parts)) if tiles is None else tiles.join(join_side(own), "node")
    near = _near_tiles(radius, parts) if tiles is None else [(0,)]
    counts = own.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    # a packed block is one row of bounded size: hashing deals a tile's prints evenly over its blocks
    packed = write_stage(
        own.join(join_side(counts), "tile").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .groupBy("tile", "block").agg(F.max("blocks").alias("blocks"), F.collect_list(F.struct("node", "fingerprint", "sketch")).alias("prints")), "blocks"
    )
    steps = F.array(*(F.lit(sum(d << 8 * q for q, d in enumerate(delta))).cast("long") for delta in near))
    heads = packed.select("tile", F.col("blocks").alias("tile_blocks")).distinct()
    # the tile pairs whose counts are within the radius, then their block pairs
    pairs = (
        packed.select("tile", "block", F.explode(steps).alias("step"))
        .select(F.col("tile").alias("tile_a"), F.col("block").alias("block_a"), (F.col("tile") + F.col("step")).alias("tile"))
        .join(heads, "tile")
        .withColumn("block_b", F.explode(F.sequence(F.lit(0), F.col("tile_blocks") - 1)))
        .where("tile_a <> tile OR block_a <= block_b")
        .select("tile_a", "block_a", F.col("tile").alias("tile_b"), "block_b")
    )
    # pairs are few and costly: they are dealt one by one, to as many tasks at any size; the blocks come to them by broadcast
    # within a measured bound, else by shuffles
    tasks = 2 * int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(tasks, "tile_a", "block_a", "tile_b", "block_b")
    side = packed.select("tile", "block", "prints")
    pairs = pairs.join(join_side(side.toDF("tile_a", "block_a", "prints_a")), ["tile_a", "block_a"])
    pairs = pairs.join(join_side(side.toDF("tile_b", "block_b", "prints_b")), ["tile_b", "block_b"])
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def arrays(value: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, print_, sketch = value.values.flatten()
        return node.to_numpy(), print_.to_numpy().view(np.uint64), np.frombuffer(
            b"".join(sketch.to_pylist()) if agreement else b"", dtype=np.uint8).reshape(-1, BINS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                a, b = _links(*arrays(x), *arrays(y), radius, agreement)
                if len(a):
                    yield batch_of(schema, a=a, b=b)

    return pairs.select("prints_a", "prints_b").mapInArrow(lean(run), "a long, b long")


def _classes(own: DataFrame, prints: DataFrame, **links) -> DataFrame:
    """``node`` and ``component_id`` for the nodes of ``own`` (``doc_id``, ``node``) under the links between ``prints``."""
    return _named(own, components(near_links(prints, **links)))


def _named(own: DataFrame, reached: DataFrame) -> DataFrame:
    """``node`` and ``component_id``, the smallest doc_id of the nodes of ``own`` with its root in ``reached``."""
    roots = write_stage(
        own.groupBy("node").agg(F.min("doc_id").alias("first_id")).join(reached, "node", "left").withColumn("root", F.coalesce("root", "node")), "roots"
    )
    ids = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return write_stage(roots.join(ids, "root").select("node", "component_id"), "classes")


def near_duplicates(docs: DataFrame, radius: int = 3, words: int = 3, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``fingerprint`` (signed long) and ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest doc_id of the documents that links reach, the document included. Rows are documents:
    repeated rows and ids stay, equal fingerprints are always linked, and texts that are NULL, empty or only white space have
    fingerprint 0. A NULL doc_id never is a component's id unless all its ids are NULL. Other columns are not read.
    """
    own = write_stage(fingerprints(docs, words).select("doc_id", "fingerprint", F.col("fingerprint").alias("node")), "fingerprints")
    prints = own.select("node", "fingerprint", F.lit(b"").alias("sketch")).distinct()
    classes = _classes(own, prints, radius=radius, block=block)
    return own.join(classes, "node").select("doc_id", "fingerprint", "component_id")


def copy_prints(docs: DataFrame, words: int = 5) -> DataFrame:
    """``docs`` with ``__row`` (a number of the row, to be written before it is used), ``__node`` (a hash of the shingle set, equal
    for equal sets), ``__fingerprint``, ``__sketch`` and ``__bands`` (keys of parts of the sketch), all of the shingle set.
    """
    own = docs.select(F.col("text").cast("string").alias("__text"), *(F.col(f"`{c}`") for c in docs.columns), F.monotonically_increasing_id().alias("__row"))
    added = [("__node", T.LongType(), pa.int64()), ("__fingerprint", T.LongType(), pa.int64()), ("__sketch", T.BinaryType(), pa.binary()),
             ("__bands", T.ArrayType(T.LongType()), pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t, words) for t in encoded(batch.column(0))]
            found = [_minima([x]) for x in sets]
            nodes = np.array([xxhash.xxh64_intdigest(x.tobytes(), 42) for x in sets], dtype=np.uint64)
            prints = np.array([f for f, _ in found], dtype=np.uint64)
            made = [nodes.view(np.int64), prints.view(np.int64), [_sketch(low) for _, low in found], [_bands(low) for _, low in found]]
            columns = batch.columns[1:] + [pa.array(v, type=kind) for v, (_, _, kind) in zip(made, added)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[1:] + [name for name, _, _ in added])

    return own.mapInArrow(lean(run), T.StructType(own.schema.fields[1:] + [T.StructField(name, kind) for name, kind, _ in added]))


def _confirmed(nodes: np.ndarray, sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between sets (not empty) of at least that Jaccard similarity; any two are compared unless
    links join them already.
    """
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    starts = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(sizes)))
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    held, label = np.zeros(len(values), dtype=np.int32), np.arange(len(sets))
    found_a, found_b = [nodes[:0]], [nodes[:0]]
    for i in range(len(sets) - 1):
        apart = label[i + 1 :] != label[i]
        if not apart.any():
            continue
        own = ids[starts[i] : starts[i + 1]]
        held[own] = 1
        common = np.add.reduceat(held[ids[starts[i + 1] :]], starts[i + 1 : -1] - starts[i + 1])
        held[own] = 0
        # common / (both - common) >= similarity
        alike = apart & (common * (1 + similarity) >= similarity * (sizes[i] + sizes[i + 1 :]) - 1e-6)
        others = i + 1 + np.flatnonzero(alike)
        if len(others):
            labels, first = np.unique(label[others], return_index=True)
            found_a.append(np.full(len(first), nodes[i]))
            found_b.append(nodes[others[first]])
            label[np.isin(label, labels)] = label[i]
    return np.concatenate(found_a), np.concatenate(found_b)


def copy_groups(
    own: DataFrame, words: int = 5, radius: int = WIDE, agreement: float = AGREEMENT, block: int = 4 * BLOCK, similarity: float = SIMILARITY,
    sets_at_once: int = SETS,
) -> DataFrame:
    """``node`` and ``root`` for each node of ``own`` (``copy_prints``, written) that a link joins to another.

    Linked are shingle sets of at least that Jaccard similarity, computed exactly. Fingerprints and sketches only find the
    candidates: links between them form components, and within a component all pairs of sets are compared that no links join yet.
    """
    prints = write_stage(own.select(
        F.col("__node").alias("node"), F.col("__fingerprint").alias("fingerprint"), F.col("__sketch").alias("sketch"),
        F.col("__bands").alias("bands")).dropDuplicates(["node"]), "nodes")
    # most bands are of one node alone; the others are the tiles
    tiles = prints.select("node", F.explode("bands").alias("tile"))
    shared = tiles.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("tile")
    tiles = write_stage(tiles.join(join_side(shared), "tile", "left_semi"), "tiles")
    near = components(near_links(prints, radius=radius, agreement=agreement, block=block, tiles=tiles))
    # one text of each candidate is read again, for its whole shingle set
    rows = own.groupBy(F.col("__node").alias("node")).agg(F.min("__row").alias("__row")).join(near, "node")
    texts = own.select("__row", F.col("text").cast("string")).join(join_side(rows), "__row").select("root", "node", "text")
    schema = pa.schema([("root", pa.int64()), ("node", pa.int64()), ("size", pa.int64()), ("shingles", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t, words) for t in encoded(batch.column(2))]
            yield batch_of(schema, root=batch.column(0), node=batch.column(1), size=[len(x) for x in sets], shingles=[x.tobytes() for x in sets])

    sets = write_stage(texts.mapInArrow(lean(read), "root long, node long, size long, shingles binary"), "sets")
    blocks = sets.groupBy("root").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / sets_at_once, F.sum("size") / SHINGLES)).cast("int").alias("blocks"))
    # a set goes to every pair that its block forms with another block, or to the only block
    dealt = sets.join(join_side(blocks), "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("blocks = 1 OR block <> other")
    pairs = dealt.groupBy("root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).agg(
        F.collect_list("node").alias("nodes"), F.collect_list("shingles").alias("sets"))
    links = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nodes, found in zip(batch.column(0), batch.column(1)):
                held = [np.frombuffer(x, dtype=np.uint64) for x in found.values.to_pylist()]
                a, b = _confirmed(nodes.values.to_numpy(), held, similarity)
                if len(a):
                    yield batch_of(links, a=a, b=b)

    return components(pairs.select("nodes", "sets").mapInArrow(lean(confirm), "a long, b long"))


def near_copies(docs: DataFrame, words: int = 5, **links) -> DataFrame:
    """``doc_id`` and ``component_id`` for every row: groups of texts that share four fifths of their different word shingles.

    Linked are texts whose shingle sets have a Jaccard similarity of at least 0.8. ``links`` are those of ``copy_groups``. Rows,
    NULLs and ids as in ``near_duplicates``; all texts without words are one group.
    """
    own = write_stage(copy_prints(docs.select(F.col("doc_id").cast("long"), "text"), words), "fingerprints")
    classes = _named(own.select("doc_id", F.col("__node").alias("node")), copy_groups(own, words, **links))
    return own.join(classes.withColumnRenamed("node", "__node"), "__node").select("doc_id", "component_id")
