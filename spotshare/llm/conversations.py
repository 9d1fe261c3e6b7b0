"""The prefix trie of conversations by collapsing whole sequences.

A turn is known by a digest, a prefix of turns by two 64-bit sums of its digests times powers of two odd multipliers, so the
prefixes of a conversation are running sums over its sorted turns. Turns are sorted by range: a conversation may span many
tasks, whose sums are then carried on by a table of at most two rows for each task. Conversations of equal turns become one
weighted sequence; sequences that end inside another one are told from leaves by an anti-join; all values of a node are
sums over the prefixes of the weighted sequences. No step goes through the trie level by level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from spotshare.plans.staging import join_side, write_stage

WORDS = r"[^\x20\x09-\x0D]+"
BLOCK = 20  # conversations that share the opening of the first of them
OPENINGS = 4  # an opening has 0 to 3 turns
_MASK = (1 << 64) - 1
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_CHUNK_IDS = 4096
ROOT = bytes(16)


def _opening(conv_id: Column) -> Column:
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(OPENINGS))


def turn_rows(conversations: DataFrame) -> DataFrame:
    """One narrow row for each turn: conv_id, turn, digest of role and text (NULL is empty), number of words, a row number.

    Rows without a conv_id belong to no conversation. The rows are written, so that the row numbers stay.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"))
    return write_stage(rows.withColumn("row", F.monotonically_increasing_id()), "turns")


def rebuilt(turns: DataFrame) -> DataFrame:
    """The turns of every conversation c after it has taken over an opening: conv_id, borrowed and the keys of their order.

    The first h turns are those of conversation c - c % 20 (all if it has fewer, none if it is absent), then c's own follow
    after its first h, where h is the crc32 of c in digits, modulo 4. Turns are ordered by turn (NULL first), equal ones by
    digest, equal rows in any order.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest", "row")
    # a filter on row_number is a top-k of every task before anything is exchanged, also for a hot conversation
    firsts = write_stage(turns.withColumn("nth", F.row_number().over(order)).where(F.col("nth") < OPENINGS), "openings")
    taken = F.col("nth") <= _opening(F.col("conv_id"))
    own = turns.join(join_side(firsts.where(taken).select("row")), "row", "left_anti")
    every = turns.select("conv_id").distinct().withColumn("base", F.expr(f"conv_id - conv_id % {BLOCK}"))
    lent = firsts.where(F.col("conv_id") % BLOCK == 0).select(F.col("conv_id").alias("base"), "nth", "digest", "words")
    borrowed = every.join(lent.hint("merge"), "base").where(taken)
    kind = dict(turns.dtypes)["turn"]
    return own.select("conv_id", F.lit(0).alias("nth"), "turn", "digest", "words", "row").unionByName(
        borrowed.select("conv_id", (F.col("nth") - OPENINGS).alias("nth"), F.lit(None).cast(kind).alias("turn"), "digest", "words",
                        F.lit(None).cast("long").alias("row")))


def _power(multiplier: int, n: int) -> np.uint64:
    return np.uint64(pow(multiplier, n, 1 << 64))


_RUNNING = "conv_id long, part int, n long, a long, b long, a0 long, b0 long, p long, p0 long"


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums of the turns of each conversation, as far as this task holds them: up to a turn, and before it (0)."""
    part = TaskContext.get().partitionId()
    last, n0, sums = None, 0, [np.uint64(0), np.uint64(0), np.uint64(0)]
    for batch in batches:
        size = batch.num_rows
        if not size:
            continue
        conv = batch.column(0).to_numpy()
        digest = batch.column(1)
        lanes = np.frombuffer(digest.buffers()[2], dtype="<u8")[: 2 * (digest.offset + size)].reshape(-1, 2)[digest.offset :]
        start = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        count = np.diff(np.r_[start, size])
        n = np.arange(1, size + 1) - np.repeat(start, count)
        goes_on = last is not None and conv[0] == last
        if goes_on:
            n[: count[0]] += n0
        columns = []
        for k, values in enumerate((lanes[:, 0].astype(np.uint64), lanes[:, 1].astype(np.uint64), batch.column(2).to_numpy().astype(np.uint64))):
            if k < 2:
                power = np.cumprod(np.full(int(count.max()), _MULTIPLIERS[k], dtype=np.uint64))
                values = values * power[np.arange(size) - np.repeat(start, count)]
                if goes_on:
                    values[: count[0]] *= _power(_MULTIPLIERS[k], n0)
            total = np.cumsum(values)
            upto = total - np.repeat((total - values)[start], count)
            if goes_on:
                upto[: count[0]] += sums[k]
            sums[k] = upto[-1]
            columns.append((upto.view(np.int64), (upto - values).view(np.int64)))
        last, n0 = conv[-1], int(n[-1])
        (a, a0), (b, b0), (p, p0) = columns
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (conv, np.full(size, part, dtype=np.int32), n, a, b, a0, b0, p, p0)],
            names=["conv_id", "part", "n", "a", "b", "a0", "b0", "p", "p0"])


def _carries(running: DataFrame) -> dict[int, tuple[int, ...]]:
    """For each task whose first conversation began in earlier tasks: its id, its number of turns there and their sums.

    What comes to the driver is two rows for each task of the sort.
    """
    ends = running.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    rows = (
        running.join(F.broadcast(ends), "part").where("conv_id = low OR conv_id = high")
        .groupBy("part", "conv_id").agg(F.max(F.struct("n", "a", "b", "p")).alias("s")).select("part", "conv_id", "s.*").collect()
    )
    carries, before = {}, None
    for part, conv, n, a, b, p in sorted(map(tuple, rows)):
        if before is not None and before[0] == conv:
            carries[part] = before
            _, m, a1, b1, p1 = before
            a, b = ((old + pow(q, m, 1 << 64) * new) & _MASK for q, old, new in zip(_MULTIPLIERS, (a1, b1), (a, b)))
            n, p = n + m, p + p1
        before = (conv, n, a & _MASK, b & _MASK, p)
    return carries


def _keys(a: np.ndarray, b: np.ndarray) -> pa.Array:
    data = np.stack((a, b), axis=1).astype("<u8").tobytes()
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(np.arange(0, 16 * len(a) + 1, 16, dtype=np.int32)), pa.py_buffer(data)])


def paths(turns: DataFrame) -> DataFrame:
    """One row for each prefix of each rebuilt conversation, the empty one too: conv_id, depth, node, parent (NULL at the root),
    the words up to its last turn (``p``) and before it (``p0``). Equal prefixes have equal nodes, of 16 bytes."""
    order = ["conv_id", "nth", F.col("turn").asc_nulls_first(), "digest", "row"]
    rows = rebuilt(turns).repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "words")
    running = write_stage(rows.mapInArrow(_running, _RUNNING), "running")
    carries = _carries(running)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, part, n, a, b, a0, b0, p, p0 = (c.to_numpy(zero_copy_only=False).copy() for c in batch.columns)
            a, b, a0, b0 = (x.view(np.uint64) for x in (a, b, a0, b0))
            for k in np.unique(part).tolist():
                if k in carries:
                    of, m, a1, b1, p1 = carries[k]
                    mine = (part == k) & (conv == of)
                    for sums, q, old in ((a, 0, a1), (a0, 0, a1), (b, 1, b1), (b0, 1, b1)):
                        sums[mine] = sums[mine] * _power(_MULTIPLIERS[q], m) + np.uint64(old)
                    n[mine] += m
                    p[mine] += p1
                    p0[mine] += p1
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv), pa.array(n), _keys(a, b), _keys(a0, b0), pa.array(p), pa.array(p0)],
                names=["conv_id", "depth", "node", "parent", "p", "p0"])

    schema = "conv_id long, depth long, node binary, parent binary, p long, p0 long"
    roots = turns.select("conv_id").distinct().select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(bytearray(ROOT)).alias("node"), F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("p"), F.lit(0).cast("long").alias("p0"))
    return running.mapInArrow(finish, schema).unionByName(roots)


def _end_digests(whole: DataFrame) -> DataFrame:
    """For each node where conversations end, the SHA-256 of their ids, rising, joined by commas.

    Ids are sorted by range and joined in chunks, so that a node where very many end is a stream of few rows in the end.
    """
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, node, conv = (c.to_pylist() for c in batch.columns)
            out, at = [], 0
            while at < len(conv):
                to = at + 1
                while to < len(conv) and to - at < _CHUNK_IDS and node[to] == node[at] and depth[to] == depth[at]:
                    to += 1
                out.append((depth[at], node[at], conv[at], ",".join(map(str, conv[at:to]))))
                at = to
            if out:
                d, k, first, ids = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d, pa.int64()), pa.array(k, pa.binary()), pa.array(first, pa.int64()), pa.array(ids, pa.string())],
                    names=["depth", "node", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []

        def flushed() -> pa.RecordBatch:
            d, k, h = zip(*out)
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int64()), pa.array(k, pa.binary()), pa.array(h, pa.string())], names=["depth", "node", "ends_sha256"])

        for batch in batches:
            for depth, node, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, node) == key:
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (depth, node), hashlib.sha256(ids.encode())
                if len(out) >= 8192:
                    yield flushed()
        if key is not None:
            out.append((*key, state.hexdigest()))
        if out:
            yield flushed()

    order = ["depth", "node", "conv_id"]
    chunks = whole.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        join, "depth long, node binary, first long, ids string")
    return chunks.repartition("depth", "node").sortWithinPartitions("depth", "node", "first").mapInArrow(
        digest, "depth long, node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations (see ``rebuilt``), the textless root at depth 0 too.

    Columns: node and parent (keys of 16 bytes), conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children,
    n_leaves (childless nodes of its subtree, itself included), saved_tokens (over its subtree, members less one times the words
    of each node's last text) and ends_sha256 (of the members that end here). A conversation without turns is a member of the
    root. NULL roles and texts are empty, rows without conv_id are no conversation, equal rows are turns of their own, other
    columns are not read; no rows give no nodes.
    """
    every = write_stage(paths(turn_rows(conversations)), "paths")
    whole = every.groupBy("conv_id").agg(F.max(F.struct("depth", "node", "p")).alias("last")).select(
        "conv_id", "last.depth", "last.node", F.col("last.p").alias("total"))
    whole = write_stage(whole, "whole")
    sequences = whole.groupBy("depth", "node", "total").agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"))
    # the sequences that go on in another one hold no leaf
    inner = every.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).distinct()
    inner = write_stage(inner, "inner")
    ends = sequences.join(inner.hint("merge"), ["depth", "node"], "left_anti").withColumn("leaf", F.lit(1)).unionByName(
        sequences.join(inner.hint("merge"), ["depth", "node"], "left_semi").withColumn("leaf", F.lit(0)))
    rows = write_stage(every.join(join_side(ends.select("conv_id", "weight", "total", "leaf")), "conv_id"), "sequences")
    # every node belongs to the smallest leaf sequence through it; the nodes of a sequence that belong to it are its last ones
    owners = rows.where("leaf = 1").groupBy("depth", "node").agg(F.min("conv_id").alias("conv_id"), F.max("p0").alias("p0"))
    owned = owners.groupBy("conv_id").agg(F.min(F.struct("depth", "p0")).alias("first")).select(
        "conv_id", F.col("first.p0").alias("others"))
    rows = rows.join(join_side(owned), "conv_id", "left")
    once = F.when(F.col("leaf") == 1, F.col("total") - F.greatest("p0", "others")).otherwise(0)
    nodes = write_stage(rows.groupBy("depth", "node").agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").cast("long").alias("n_leaves"),
        F.sum(F.col("weight") * (F.col("total") - F.col("p0")) - once).alias("saved_tokens"), F.max("parent").alias("parent")), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select("depth", "node", "conv_id").join(children.hint("merge"), ["depth", "node"])
    parents = join_side(parents.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")))
    done = nodes.join(children.hint("merge"), ["depth", "node"], "left").join(_end_digests(whole).hint("merge"), ["depth", "node"], "left")
    return done.join(parents, ["depth", "parent"], "left").select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
