"""Removal of repeated byte strings by sorting suffixes, deep-shallow.

Suffixes are dealt out by anchors: in every string of ``length`` bytes the ``gram``-byte string with the smallest hash is
its anchor, so equal strings have equal anchors at equal places. Only suffixes whose anchor stands in two places of the corpus
are sorted. A task sorts the suffixes of its anchors by multikey quicksort over eight bytes at a time down to a shallow depth;
groups that still agree there go into blind tries, which keep only the depths and bytes at which suffixes branch off. Suffixes
that reach depth ``length`` together are the repeated strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spotshare.llm.common import CHUNK_BYTES, batch_of, chunks, lean, prefix_sums, span_hashes
from spotshare.plans.staging import join_side, write_stage

LENGTH = 200
GRAM = 32
SHALLOW = 16  # bytes that the multikey quicksort looks at
SUFFIXES_AT_ONCE = 1 << 19
SLICES_AT_ONCE = 1 << 15
HOT = 20_000  # places of an anchor whose strings one task sorts; those of one with more are dealt by more of their bytes
SPREAD = 16  # starts of a hot anchor that are dealt together
_POSITION_BITS = 22


def _anchors(text: bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of starts of ``length``-byte strings that share an anchor: anchor hash, first start, number of starts, and how
    far the anchor stands behind the first start."""
    window = length - gram + 1
    parts = []
    step = CHUNK_BYTES
    for at in range(0, max(1, len(text) - length + 1), step):
        buf = np.frombuffer(text[at : at + step + length - 1], dtype=np.uint8)
        if len(buf) < length:
            continue
        places = np.arange(len(buf) - gram + 1)
        hashes = span_hashes(prefix_sums(buf), places, places + gram)
        # the leftmost smallest: high bits of the hash, then the place
        low = (hashes >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | places.astype(np.uint64)
        width = 1
        while 2 * width <= window:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < window:
            low = np.minimum(low[: len(low) - (window - width)], low[window - width :])
        anchor = (low & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        first = np.concatenate((np.zeros(1, dtype=np.int64), np.flatnonzero(anchor[1:] != anchor[:-1]) + 1))
        count = np.diff(np.concatenate((first, [len(anchor)])))
        place = anchor[first]
        parts.append((hashes[place].view(np.int64), first + at, count, place - first))
    if not parts:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*parts))


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """One row for each text: its digest, the hashes of its anchors, and start << 32 | number of starts << 16 | offset of each."""
    schema = pa.schema([("digest", pa.binary()), ("anchors", pa.list_(pa.int64())), ("places", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks((v.as_py() for v in batch.column(1)), 8 * CHUNK_BYTES):
                found = [_anchors(t, length, gram) for t in part]
                ends = pa.array(np.cumsum([0] + [len(f[0]) for f in found]), pa.int32())
                anchors = np.concatenate([f[0] for f in found])
                places = np.concatenate([f[1] << 32 | f[2] << 16 | f[3] for f in found])
                yield batch_of(schema, digest=batch.column(0).slice(first, len(part)),
                               anchors=pa.ListArray.from_arrays(ends, pa.array(anchors)),
                               places=pa.ListArray.from_arrays(ends, pa.array(places)))

    return texts.select("digest", "content").mapInArrow(lean(run), "digest binary, anchors array<long>, places array<long>")


def _pieces(text: bytes, runs: pa.Scalar, length: int) -> dict[tuple, list[int]]:
    """The different slices of a text's repeated anchors (id, anchor, number of starts, offset, bytes), with their first starts."""
    found: dict[tuple, list[int]] = {}
    anchors, places = (x.to_pylist() for x in runs.values.flatten())
    for anchor, place in zip(anchors, places):
        start, count, offset = place >> 32, place >> 16 & 0xFFFF, place & 0xFFFF
        piece = text[start : start + count + length - 1]
        key = hashlib.md5(b"%d %d " % (anchor, offset) + piece).digest()
        found.setdefault((key, anchor, count, offset, piece), []).append(start)
    return found


def _slices(held: DataFrame, length: int) -> DataFrame:
    """The slices around repeated anchors with their bytes. Equal ones of a task, some millions of bytes at a time, are one row."""
    schema = pa.schema([
        ("id", pa.binary()), ("anchor", pa.int64()), ("count", pa.int32()), ("offset", pa.int32()), ("bytes", pa.binary()), ("copies", pa.int64()),
    ])

    def rows(own: dict[tuple, int]) -> Iterator[pa.RecordBatch]:
        keys = list(own)
        for i in range(0, len(keys), 8192):
            part = keys[i : i + 8192]
            columns = dict(zip(("id", "anchor", "count", "offset", "bytes"), map(list, zip(*part))))
            yield batch_of(schema, **columns, copies=[own[k] for k in part])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[tuple, int] = {}
        for batch in batches:
            for content, runs, rows_of_text in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                for key, starts in _pieces(content.as_py(), runs, length).items():
                    own[key] = own.get(key, 0) + len(starts) * rows_of_text
                if len(own) >= SLICES_AT_ONCE:
                    yield from rows(own)
                    own = {}
        yield from rows(own)

    return held.select("content", "runs", "rows").mapInArrow(lean(run), "id binary, anchor long, count int, offset int, bytes binary, copies long")


def _members(held: DataFrame, length: int) -> DataFrame:
    """Which texts have a slice, and where."""
    schema = pa.schema([("digest", pa.binary()), ("id", pa.binary()), ("starts", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, content, runs in zip(batch.column(0), batch.column(1), batch.column(2)):
                own = _pieces(content.as_py(), runs, length)
                yield batch_of(schema, digest=[digest.as_py()] * len(own), id=[k[0] for k in own], starts=list(own.values()))

    return held.select("digest", "content", "runs", "rows").mapInArrow(lean(run), "digest binary, id binary, starts array<int>")


def _words_at(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number that sorts as they do."""
    return np.ndarray((len(buf) - 7,), dtype=">u8", buffer=buf.data, strides=(1,))


def _groups(member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal neighbours in ``member``: for each element whether it has company, and its group's number."""
    edge = np.ones(len(member) + 1, dtype=bool)
    edge[1:-1] = member[1:] != member[:-1]
    return ~(edge[:-1] & edge[1:]), np.cumsum(edge[:-1]) - 1


def repeated(buf: np.ndarray, place: np.ndarray, group: np.ndarray, length: int, shallow: int = SHALLOW) -> np.ndarray:
    """Which of the strings buf[p:p+length] equal another one of their group, by deep-shallow sorting.

    ``buf`` must reach eight bytes beyond the last string.
    """
    words = _words_at(buf)
    result = np.zeros(len(place), dtype=bool)
    left = np.arange(len(place))
    # shallow: multikey quicksort, eight bytes to a key; a string without company in its part is done
    for depth in (None, *range(0, min(shallow, length) // 8 * 8, 8)):
        key = words[place[left] + depth].astype(np.uint64) if depth is not None else np.zeros(len(left), dtype=np.uint64)
        order = np.lexsort((key, group[left]))
        left, key = left[order], key[order]
        old = group[left]
        edge = np.ones(len(left), dtype=bool)
        edge[1:] = (old[1:] != old[:-1]) | (key[1:] != key[:-1])
        part = np.cumsum(edge) - 1
        company, _ = _groups(part)
        left, part = left[company], part[company]
        group = group.copy()
        group[left] = part
        if not len(left):
            return result
    # deep: blind tries. The first suffix of a group is the trie's spine; every other one leaves it at a depth, by a byte,
    # and those that leave alike make the subtrie there. Suffixes that never leave it within the length are equal to it.
    while len(left):
        _, part = _groups(group[left])
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        spine = left[first][part]
        depth = np.full(len(left), length, dtype=np.int64)
        alive = np.flatnonzero(left != spine)
        for d in range(0, length, 8):
            if not len(alive):
                break
            differ = words[place[left[alive]] + d].astype(np.uint64) ^ words[place[spine[alive]] + d].astype(np.uint64)
            off = differ != 0
            if off.any():
                bits = np.frexp((differ[off] >> np.uint64(11)).astype(np.float64))[1] + 11
                small = differ[off] < np.uint64(1 << 11)
                if small.any():
                    bits[small] = np.frexp(differ[off][small].astype(np.float64))[1]
                depth[alive[off]] = np.minimum(length, d + (64 - bits) // 8)
                alive = alive[~off]
        same = depth == length
        result[left[same & (left != spine)]] = True
        result[spine[same & (left != spine)]] = True
        off = ~same
        branch = (part[off] * (length + 1) + depth[off]) * 256 + buf[place[left[off]] + depth[off]]
        left = left[off]
        order = np.argsort(branch, kind="stable")
        left, branch = left[order], branch[order]
        company, number = _groups(branch)
        left = left[company]
        group[left] = number[company]
    return result


def _sorted_slices(slices: DataFrame, length: int) -> DataFrame:
    """For each different slice the bits of its starts whose strings also start elsewhere.

    Slices arrive sorted by anchor, equal ones from several tasks next to each other. Whole anchors are sorted together, about
    SUFFIXES_AT_ONCE suffixes at a time.
    """
    schema = pa.schema([("id", pa.binary()), ("repeats", pa.binary())])

    def sort(rows: list[tuple]) -> pa.RecordBatch:
        count = np.array([r[2] for r in rows], dtype=np.int64)
        size = count + length - 1
        base = np.concatenate(([0], np.cumsum(size)[:-1]))
        buf = np.frombuffer(b"".join([r[4] for r in rows]) + bytes(8), dtype=np.uint8)
        owner = np.repeat(np.arange(len(rows)), count)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        _, anchor = np.unique(np.array([r[1] for r in rows], dtype=np.int64), return_inverse=True)
        offset = np.array([r[3] for r in rows], dtype=np.int64)
        group = anchor[owner] * (length + 1) + offset[owner] - nth
        many = np.array([r[5] > 1 for r in rows])
        flags = repeated(buf, base[owner] + nth, group, length) | many[owner]
        ends = np.cumsum(count)
        return batch_of(schema, id=[r[0] for r in rows],
                        repeats=[np.packbits(flags[e - c : e]).tobytes() for e, c in zip(ends.tolist(), count.tolist())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held and row[0] == held[-1][0]:
                    held[-1] = (*row[:5], row[5] + held[-1][5])
                    continue
                if weight >= SUFFIXES_AT_ONCE and row[1] != held[-1][1]:
                    yield sort(held)
                    held, weight = [], 0
                held.append(row)
                weight += row[2]
        if held:
            yield sort(held)

    return (
        slices.select("id", "anchor", "count", "offset", "bytes", "copies").repartition("anchor")
        .sortWithinPartitions("anchor", "id").mapInArrow(lean(run), "id binary, repeats binary")
    )


def _finer(hot: DataFrame, length: int) -> DataFrame:
    """The slices of anchors with too many places for a task, cut into slices of up to SPREAD starts that are dealt by more bytes.

    Equal strings stand equally far before their anchor, so starts are cut by that distance, and all strings of such a range hold
    the same ``length`` - SPREAD + 1 bytes around the anchor: these bytes take the anchor's part. ``id`` gains two bytes, the
    place of the first start in its old slice.
    """
    low = F.col("range") * SPREAD  # the least distance of the range
    first = F.greatest(F.lit(0), F.col("offset") - low - (SPREAD - 1))
    last = F.least(F.col("count") - 1, F.col("offset") - low)
    ranges = F.sequence(F.floor((F.col("offset") - F.col("count") + 1) / SPREAD), F.floor(F.col("offset") / SPREAD))
    cut = hot.withColumn("range", F.explode(ranges)).select("*", first.cast("int").alias("first"), last.cast("int").alias("last"), low.alias("low"))
    core = F.substring(F.col("bytes"), (F.col("offset") - F.col("low") + 1).cast("int"), F.lit(length - SPREAD + 1))
    return cut.select(
        F.concat("id", F.unhex(F.lpad(F.hex("first"), 4, "0"))).alias("id"), F.xxhash64("anchor", "range", core).alias("anchor"),
        (F.col("last") - F.col("first") + 1).alias("count"), (F.col("offset") - F.col("first")).alias("offset"),
        F.substring(F.col("bytes"), F.col("first") + 1, F.col("last") - F.col("first") + length).alias("bytes"), "copies")


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """The texts without their repeated strings, from the starts found in them."""
    schema = pa.schema([
        ("digest", pa.binary()), ("kept", pa.binary()), ("spans", pa.list_(pa.list_(pa.int32()))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, content, runs in zip(batch.column(0), batch.column(1), batch.column(2)):
                text = content.as_py()
                steps = np.zeros(len(text) + 1, dtype=np.int32)
                for run_ in runs.as_py():
                    nth = np.flatnonzero(np.unpackbits(np.frombuffer(run_["repeats"], dtype=np.uint8)))
                    for start in run_["starts"]:
                        steps[start + nth] += 1
                        steps[start + nth + length] -= 1
                gone = np.cumsum(steps[:-1]) > 0
                kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                if len(edges):
                    yield batch_of(schema, digest=[digest.as_py()], kept=[kept], spans=[edges.tolist()])

    return rows.select("digest", "content", "found", "rows").mapInArrow(lean(run), "digest binary, kept binary, spans array<array<int>>")


def content_of(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def digest_of(content: Column) -> Column:
    return F.unhex(F.md5(content))


def cuts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """For each different text that loses bytes: ``digest`` (of the whole text), ``kept`` (the bytes left) and ``spans``
    (maximal removed runs, [from, to)).

    A byte goes if a string of ``length`` bytes that covers it also starts elsewhere in the corpus, in the same text or another
    row; all places lose it. Repeated rows and copies count as places of their own, so a text with copies loses all its bytes if
    it is long enough. Texts are whole, as UTF-8; NULL is empty and never loses anything. Ids and other columns are not read.
    """
    if not gram < length <= 1 << 14 or length - SPREAD < gram:
        raise ValueError("strings must be longer than their anchors, and of 16,384 bytes at most")
    texts = docs.select(content_of().alias("content")).where(F.octet_length("content") >= length).withColumn(
        "digest", digest_of(F.col("content"))
    )
    rows = write_stage(_anchor_rows(texts, length, gram).withColumn("row", F.monotonically_increasing_id()), "anchors")
    runs = rows.select("row", F.explode(F.arrays_zip("anchors", "places")).alias("r")).select(
        F.col("r.anchors").alias("anchor"), "row", F.col("r.places").alias("place")
    )
    # every row stands for itself here, so an anchor of a copied text counts as repeated
    often = write_stage(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("places")).where("places > 1"), "often")
    first_rows = rows.groupBy("digest").agg(F.min("row").alias("row"))
    lists = write_stage(
        runs.join(often.select("anchor").hint("merge"), "anchor", "left_semi")
        .groupBy("row").agg(F.collect_list(F.struct("anchor", "place")).alias("runs"), F.count(F.lit(1)).alias("n"))
        .join(first_rows, "row").select("digest", "runs"), "runs"
    )
    # one text for each digest, with its number of rows: copies meet before they are exchanged. Slices, members and the cut all
    # take the same columns, so that they read one exchange of texts
    text = texts.groupBy("digest").agg(F.first("content").alias("content"), F.count(F.lit(1)).alias("rows"))
    held = text.join(lists.hint("merge"), "digest")
    slices = _slices(held, length)
    wide = often.where(F.col("places") > hot).select("anchor")
    if not wide.isEmpty():
        # slices are exchanged only once the few anchors of many places are told apart
        wide = join_side(wide)
        slices = slices.join(wide, "anchor", "left_anti").unionByName(_finer(slices.join(wide, "anchor", "left_semi"), length))
    repeats = _sorted_slices(slices, length).select(
        F.substring("id", 1, 16).alias("id"), "repeats",
        F.when(F.octet_length("id") > 16, F.conv(F.hex(F.substring("id", 17, 2)), 16, 10).cast("int")).otherwise(0).alias("shift"))
    found = (
        _members(held, length).join(repeats.hint("merge"), "id")
        .groupBy("digest").agg(F.collect_list(F.struct(F.transform("starts", lambda s: s + F.col("shift")).alias("starts"), "repeats")).alias("found"))
    )
    return _cut(text.join(found.hint("merge"), "digest"), length)


def repeat_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``digest`` (see ``digest_of``) and ``spans`` of each different text that loses bytes; see ``cuts``."""
    return cuts(docs, length, gram, hot).select("digest", "spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``docs`` with the columns ``kept`` (the bytes left), ``spans`` and ``n_bytes`` added; see ``cuts`` for what goes.

    A text with copies loses all its bytes if it is long enough, as each of them is a place elsewhere. Columns of these names
    are replaced.
    """
    content = content_of()
    own = [f"`{c}`" for c in docs.columns if c.lower() not in ("kept", "spans", "n_bytes")]
    marked = docs.select(*own, digest_of(content).alias("__digest"), F.octet_length(content).cast("long").alias("n_bytes"))
    changed = cuts(docs, length, gram, hot).withColumnRenamed("digest", "__digest")
    done = marked.join(changed, "__digest", "left")
    return done.select(*own, "n_bytes", F.coalesce("kept", content_of()).alias("kept"),
                       F.coalesce("spans", F.array().cast("array<array<int>>")).alias("spans"))


def removal_digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans and the digest of the bytes that are left."""
    content = content_of()
    own = docs.select(
        "doc_id", digest_of(content).alias("digest"), F.octet_length(content).cast("long").alias("n_bytes"), F.sha2(content, 256).alias("whole")
    )
    changed = cuts(docs, length, gram, hot).select(
        "digest", F.octet_length("kept").cast("long").alias("n_kept"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    return own.join(changed, "digest", "left").select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.coalesce("n_kept", "n_bytes")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )
