"""Ranked lexical search by Block-Max MaxScore over shards of documents.

An index is a table of posting lists: for each shard (8 MB of texts that one task has read) and each term the places
of its documents and counts, in blocks of 128 packed to the fewest bytes. Beside a block stand its last document and the
counts and lengths that no other posting of it beats, which give the block's largest impact under any corpus statistics. A
search visits the lists of a query from the largest global bound down; once those left can't lift a document above the score
that the k-th best has already, they are not essential: they find no new candidates, and each candidate is dropped as soon as
its score, the maximum of its block and the bounds of the lists below stay under that score, before the block is unpacked. The
best of all shards of a task, and then of all tasks, are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from spotshare.llm.common import CHUNK_BYTES, DIGITS, byte_classes, chunks, encoded, tokens
from spotshare.plans.staging import join_side, write_stage

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CLASSES = byte_classes(term=DIGITS + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
SHARD_BYTES = 1 << 23
BLOCK = 128
QUERY_TERMS = 500_000  # terms of queries that one job searches together
_HEADER = np.dtype([("last", "<i4"), ("data", "<i4"), ("front", "<i4"), ("count", "u1"), ("widths", "u1")])
_FRONT = np.dtype([("tf", "<i4"), ("n", "<i4")])
INDEX = "shard long, term string, n_docs long, total long, blob binary"


# -- building ----------------------------------------------------------------------------------------------------------


def _slices(raw: bytes) -> Iterator[bytes]:
    """A long text in parts that end between terms."""
    at, size = 0, CHUNK_BYTES
    while len(raw) - at > size:
        ends = np.flatnonzero(_CLASSES[np.frombuffer(raw, dtype=np.uint8, count=size, offset=at)] == 0)
        if not len(ends) or not ends[-1]:
            size *= 2
            continue
        yield raw[at : at + int(ends[-1])]
        at, size = at + int(ends[-1]), CHUNK_BYTES
    yield raw[at:]


class _Shard:
    """The terms of documents, gathered until there are enough for a shard."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.size, self.names = 0, {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, ids: list[int | None], texts: list[bytes]) -> None:
        first = len(self.ids)
        self.ids += ids
        self.size += sum(map(len, texts)) + 64 * len(texts)
        owners, pieces = zip(*((i, s) for i, t in enumerate(texts) for s in _slices(t)))
        owners = np.array(owners, dtype=np.int64)
        for at, part in chunks(pieces):
            term, owner, _, start, end = tokens(part, _CLASSES)
            if not len(term):
                continue
            doc = first + owners[at + owner]
            distinct, place, number = np.unique(term, return_index=True, return_inverse=True)
            for h, k in zip(distinct.tolist(), place.tolist()):
                if h not in self.names:
                    self.names[h] = part[owner[k]][start[k] : end[k]]
            low, width = int(doc[0]), int(doc[-1] - doc[0]) + 1
            key, tf = np.unique(number * width + doc - low, return_counts=True)
            self.parts.append((distinct[key // width], (key % width + low).astype(np.int32), tf.astype(np.int32)))

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        """The rows of the index: one for the documents (term NULL), one for each term."""
        if not self.parts:
            return
        term, doc, tf = (np.concatenate(x) for x in zip(*self.parts))
        self.parts = []
        distinct, term = np.unique(term, return_inverse=True)
        # parts of one long text may repeat a posting
        order = np.lexsort((doc, term))
        term, doc, tf = term[order], doc[order], tf[order]
        new = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])])
        term, doc, tf = term[new], doc[new].astype(np.int64), np.add.reduceat(tf, new, dtype=np.int64)
        lengths = np.bincount(doc, weights=tf, minlength=len(self.ids)).astype(np.int64)
        held = np.flatnonzero(lengths)
        doc, lengths, ids = (np.cumsum(lengths > 0) - 1)[doc], lengths[held], [self.ids[i] for i in held.tolist()]
        schema = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("n_docs", pa.int64()), ("total", pa.int64()), ("blob", pa.binary())])
        known = np.array([i is not None for i in ids])
        blob = known.astype(np.uint8).tobytes() + np.array([i or 0 for i in ids], dtype="<i8").tobytes() + lengths.astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([None], pa.string()), pa.array([len(ids)], pa.int64()),
             pa.array([int(lengths.sum())], pa.int64()), pa.array([blob], pa.binary())], schema=schema)
        names = [self.names[h].decode() for h in distinct.tolist()]
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        blobs = _packed(term, first, doc, tf, lengths)
        n_docs, total = np.diff(np.r_[first, len(term)]), np.add.reduceat(tf, first)
        for at in range(0, len(names), 1 << 16):
            to = min(at + (1 << 16), len(names))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(to - at, shard)), pa.array(names[at:to]), pa.array(n_docs[at:to]), pa.array(total[at:to]),
                 pa.array(blobs[at:to], pa.binary())], schema=schema)


def _packed(term: np.ndarray, first: np.ndarray, doc: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """The posting lists as bytes: number of blocks, their headers, the postings that no other of their block beats, the data."""
    size = np.diff(np.r_[first, len(term)])
    nth = np.arange(len(term)) - np.repeat(first, size)
    start = np.flatnonzero(nth % BLOCK == 0)
    count = np.diff(np.r_[start, len(term)])
    block = np.repeat(np.arange(len(start)), count)
    gap = np.diff(doc, prepend=-1)
    gap[first] = doc[first] + 1

    def width(values: np.ndarray) -> np.ndarray:
        most = np.maximum.reduceat(values, start)
        return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))

    gap_width, tf_width = width(gap), width(tf)
    block_bytes = count * (gap_width + tf_width)
    block_at = np.cumsum(block_bytes) - block_bytes
    data = np.zeros(int(block_bytes.sum()), dtype=np.uint8)
    inside = np.arange(len(term)) - start[block]
    for values, widths, base in ((gap, gap_width, block_at), (tf, tf_width, block_at + count * gap_width)):
        at = base[block] + inside * widths[block]
        for k in range(4):
            has = widths[block] > k
            data[at[has] + k] = values[has] >> (8 * k) & 255
    # by falling count, only shorter documents than all before can have the larger impact
    n = lengths[doc]
    order = np.lexsort((n, -tf, block))
    far = np.int64(lengths.max() + 1)
    least = np.minimum.accumulate(n[order] - block[order] * far)
    best = order[np.r_[True, (least[1:] < least[:-1])]]
    front = np.zeros(len(best), dtype=_FRONT)
    front["tf"], front["n"] = tf[best], n[best]
    fronts = np.bincount(block[best], minlength=len(start))
    header = np.zeros(len(start), dtype=_HEADER)
    header["last"], header["count"] = doc[start + count - 1], count - 1
    header["widths"] = gap_width << 4 | tf_width
    head_bytes, front_bytes, data_bytes = header.dtype.itemsize, front.dtype.itemsize, data.tobytes()
    first_block = np.searchsorted(start, first)
    n_blocks = np.diff(np.r_[first_block, len(start)])
    ends = np.cumsum(fronts)
    header["front"] = (ends - fronts) - np.repeat((ends - fronts)[first_block], n_blocks)
    header["data"] = block_at - np.repeat(block_at[first_block], n_blocks)
    heads, points = header.tobytes(), front.tobytes()
    b0 = first_block.tolist() + [len(start)]
    f0 = (ends - fronts)[first_block].tolist() + [len(front)]
    d0 = block_at[first_block].tolist() + [len(data)]
    return [
        (b0[i + 1] - b0[i]).to_bytes(4, "little") + (f0[i + 1] - f0[i]).to_bytes(4, "little")
        + heads[b0[i] * head_bytes : b0[i + 1] * head_bytes] + points[f0[i] * front_bytes : f0[i + 1] * front_bytes] + data_bytes[d0[i] : d0[i + 1]]
        for i in range(len(first))
    ]


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The written index of all rows of ``docs`` (doc_id, text): rows of ``INDEX``, one for each shard and term.

    The row of a shard with term NULL holds its documents that have a term, their number and all their terms. Terms are runs of
    ASCII letters and digits and of all other characters, with only A-Z lower-cased; NULL has none. Rows are documents: repeated
    rows and ids, NULL too, count each. Terms of a shard are told apart by 64-bit hashes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        shard = _Shard()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(ids), 256):
                part = encoded(texts.slice(at, 256))
                shard.add(ids[at : at + 256], [t.lower() for t in part])
                if shard.size >= shard_bytes:
                    yield from shard.rows(number)
                    shard, number = _Shard(), number + 1
        yield from shard.rows(number)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return write_stage(rows.mapInArrow(run, INDEX), "postings")


# -- searching ---------------------------------------------------------------------------------------------------------


def _impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class _List:
    """A posting list; blocks are unpacked when first asked for."""

    def __init__(self, blob: bytes, m_of_length, m_of_doc: np.ndarray):
        blocks, fronts = int.from_bytes(blob[:4], "little"), int.from_bytes(blob[4:8], "little")
        self.header = np.frombuffer(blob, dtype=_HEADER, count=blocks, offset=8)
        at = 8 + self.header.nbytes
        front = np.frombuffer(blob, dtype=_FRONT, count=fronts, offset=at)
        self.blob, self.data, self.m = blob, at + front.nbytes, m_of_doc
        self.last = self.header["last"].astype(np.int64)
        self.maxima = np.maximum.reduceat(_impacts(front["tf"], m_of_length(front["n"])), self.header["front"])
        self.most = int(self.maxima.max())
        self.unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.whole: tuple[np.ndarray, np.ndarray] | None = None

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents and impacts of a block."""
        found = self.unpacked.get(b)
        if found is None:
            head = self.header[b]
            count, widths, at = int(head["count"]) + 1, int(head["widths"]), self.data + int(head["data"])
            gap = np.frombuffer(self.blob, dtype=f"<u{widths >> 4}", count=count, offset=at)
            tf = np.frombuffer(self.blob, dtype=f"<u{widths & 15}", count=count, offset=at + count * (widths >> 4))
            doc = np.cumsum(gap, dtype=np.int64) + (self.last[b - 1] if b else -1)
            found = self.unpacked[b] = doc, _impacts(tf, self.m[doc])
        return found

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.whole is None:
            docs, impacts = zip(*(self.block(b) for b in range(len(self.header))))
            self.whole = np.concatenate(docs), np.concatenate(impacts)
        return self.whole


def _candidates(lists: list[tuple[_List, int]], n_docs: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard, with their scores, that may be among the k best: all that reach ``floor`` and the k-th best score here.

    ``lists`` are the query's lists and their weights.
    """
    lists = sorted(lists, key=lambda x: -x[1] * x[0].most)
    bounds = [w * part.most for part, w in lists]
    below = np.r_[np.cumsum(bounds[::-1])[::-1], 0]  # the bounds of a list and all after it
    if below[0] < floor:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    score = np.zeros(n_docs, dtype=np.int64)

    def raised(scores: np.ndarray, least: int) -> int:
        return max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k])) if len(scores) >= k else least

    at = 0
    while at < len(lists) and below[at] >= floor:
        part, w = lists[at]
        doc, impact = part.all()
        score[doc] += w * impact
        at += 1
        if at < len(lists) and below[at] <= int(score.max()):
            floor = raised(score, floor)
    found = np.flatnonzero(score)
    scores = score[found]
    for i in range(at, len(lists)):
        part, w = lists[i]
        block = np.searchsorted(part.last, found)
        inside = block < len(part.last)
        most = np.zeros(len(found), dtype=np.int64)
        most[inside] = w * part.maxima[block[inside]]
        keep = scores + most + below[i + 1] >= floor
        found, scores, block = found[keep], scores[keep], block[keep]
        if not len(found):
            break
        for b in np.unique(block[block < len(part.last)]).tolist():
            doc, impact = part.block(b)
            of = np.flatnonzero(block == b) if len(part.last) > 1 else np.flatnonzero(block == 0)
            place = np.minimum(np.searchsorted(doc, found[of]), len(doc) - 1)
            hit = doc[place] == found[of]
            scores[of[hit]] += w * impact[place[hit]]
        floor = raised(scores, floor)
    keep = scores >= max(floor, 1)
    return found[keep], scores[keep]


def _best(scores: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: by score, then by id, NULL last."""
    return np.lexsort((ids, ~known, -scores))[:k]


def _searcher(queries: list[list[tuple[int, int]]], numbers: list[int], n: int, total: int, k: int):
    """A function over the rows of the asked lists (shard, term number, blob), sorted by shard; -1 numbers the documents of a shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.int64)
        best = [(none, none, none.astype(bool)) for _ in queries]
        held: dict[int, bytes] = {}
        shard = None

        def search() -> None:
            docs = held.pop(-1)
            size = len(docs) // 17
            known = np.frombuffer(docs, dtype=np.uint8, count=size).astype(bool)
            ids = np.frombuffer(docs, dtype="<i8", count=size, offset=size)
            lengths = np.frombuffer(docs, dtype="<i8", count=size, offset=9 * size)
            different = np.unique(lengths)
            # 25 * n * N may exceed 64 bits
            m = np.array([75 + 25 * x * n // total for x in different.tolist()], dtype=np.int64)

            def m_of(length: np.ndarray) -> np.ndarray:
                return m[np.searchsorted(different, length)]

            m_of_doc = m_of(lengths)
            lists: dict[int, _List] = {}
            for q, asked in enumerate(queries):
                own = []
                for t, w in asked:
                    if t in held:
                        if t not in lists:
                            lists[t] = _List(held[t], m_of, m_of_doc)
                        own.append((lists[t], w))
                if not own:
                    continue
                scores, own_ids, own_known = best[q]
                found, new = _candidates(own, size, k, int(scores[-1]) if len(scores) == k else 0)
                if len(found):
                    scores, own_ids, own_known = np.r_[scores, new], np.r_[own_ids, ids[found]], np.r_[own_known, known[found]]
                    top = _best(scores, own_ids, own_known, k)
                    best[q] = scores[top], own_ids[top], own_known[top]
            held.clear()

        for batch in batches:
            for of, term, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if of != shard and held:
                    search()
                shard = of
                held[term] = blob.as_py()
        if held:
            search()
        for q, (scores, ids, known) in enumerate(best):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), numbers[q])), pa.array(scores), pa.array(ids, mask=~known)], names=["query", "score", "doc_id"])

    return run


def _query_blocks(spark: SparkSession, asked: DataFrame) -> Iterator[tuple[list[int], list[list[tuple[int, int]]], dict[str, int]]]:
    """Queries in blocks of about QUERY_TERMS terms: their numbers, their terms by number with weights, and the terms."""
    numbers, queries, terms, size = [], [], {}, 0
    for query, term, weight in asked.orderBy("query").toLocalIterator():
        if not numbers or numbers[-1] != query:
            if size >= QUERY_TERMS:
                yield numbers, queries, terms
                numbers, queries, terms, size = [], [], {}, 0
            numbers.append(query)
            queries.append([])
        queries[-1].append((terms.setdefault(term, len(terms)), weight))
        size += 1
    if numbers:
        yield numbers, queries, terms


def search(index: DataFrame, items: DataFrame, k: int = 20, key: str = "item_id") -> DataFrame:
    """The ``k`` best documents of ``index`` for each row of ``items`` (``key``, text): ``key``, rank, doc_id, score.

    Scores are those of ``build_index``'s terms under integer arithmetic: a term of weight floor(1000 ln((2N+2)/(2df+1))), tf times
    in a document of n terms, adds weight * (10^9 tf div (1000 tf + 12 m)), m = 75 + 25 n N div L, for each time that it stands in
    the query. Only scores above 0 count; equal ones go by rising doc_id, NULL last. A query without terms or hits, a NULL one too,
    gives no rows; repeated rows of ``items`` are queries of their own, whatever their key.
    """
    spark = index.sparkSession
    stats = index.where("term IS NULL").agg(F.sum("n_docs").alias("n"), F.sum("total").alias("total")).first()
    n, total = stats["n"] or 0, stats["total"] or 0
    rows = write_stage(items.select(F.col(f"`{key}`").alias("key"), F.col("text").cast("string").alias("text"))
                       .withColumn("query", F.monotonically_increasing_id()), "queries")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    asked = rows.select("query", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
    asked = write_stage(asked.groupBy("query", "term").agg(F.count(F.lit(1)).alias("times")), "asked")
    side = join_side(asked.select("term").distinct())
    held = index.where("term IS NOT NULL").select("term", "n_docs").join(side, "term").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * F.lit(n) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = held.select("term", weight.alias("weight")).where("weight > 0")
    asked = write_stage(asked.join(weighted, "term").select("query", "term", (F.col("weight") * F.col("times")).alias("weight")), "weighted")
    found = spark.createDataFrame([], "query long, score long, doc_id long")
    for numbers, queries, terms in _query_blocks(spark, asked):
        # at most some QUERY_TERMS terms, or those of one query
        wanted = F.broadcast(spark.createDataFrame(pa.table({"term": list(terms), "number": pa.array(list(terms.values()), pa.int32())})))
        lists = index.where("term IS NOT NULL").join(wanted, "term").select("shard", "number", "blob").unionByName(
            index.where("term IS NULL").select("shard", F.lit(-1).alias("number"), "blob"))
        best = lists.repartition("shard").sortWithinPartitions("shard").mapInArrow(
            _searcher(queries, numbers, n, total, k), "query long, score long, doc_id long")
        found = found.unionByName(write_stage(best, "best"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.join(rows.select("query", F.col("key").alias(key)), "query").select(F.col(f"`{key}`"), "rank", "doc_id", "score")
