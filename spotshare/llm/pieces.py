"""Exact SentencePiece BPE by vectorised merge rounds, and its inverse.

Texts are flat arrays of symbols, first their characters. They fall into words where two neighbours stand side by side in no
piece of the vocabulary, so no merge ever crosses a border; equal words of a chunk are encoded once. In a round every word finds
its smallest pair rank by a segmented minimum and merges the pairs of that rank from the left, all words at once; then the
arrays are compacted and words without a pair leave. Merging all pairs of one rank together is exact unless the piece it makes
can join a neighbour at a smaller or equal rank: of such a rank only the leftmost pair of a word is merged in a round.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values: kinds of pieces in the model file
CHUNK_CHARS = 1 << 19
FLUSH_IDS = 1 << 20
ROUNDS = 64  # what still merges after so many rounds is one very long word each, and goes on by a queue of pairs
_NO_RANK = np.int64(1) << 60


class Vocabulary:
    """The pieces of a model file: BPE with byte fallback, spaces escaped, a space put before the text, no other normalisation."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, trained = model.normalizer_spec, model.trainer_spec
        kinds = np.array([p.type for p in model.pieces])
        if (trained.model_type != 2 or not trained.byte_fallback or rules.precompiled_charsmap or not rules.add_dummy_prefix
                or rules.remove_extra_whitespaces or not rules.escape_whitespaces or trained.treat_whitespace_as_suffix
                or not set(kinds.tolist()) <= {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError(f"{path} holds another kind of model")
        self.texts = [p.piece for p in model.pieces]
        self.kinds, self.end = kinds, next(i for i, p in enumerate(model.pieces) if p.piece == trained.eos_piece)
        self.unknown_text = trained.unk_surface
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for i in np.flatnonzero(kinds == BYTE):
            self.byte_ids[int(self.texts[i][3:5], 16)] = i
        normal = {self.texts[i]: int(i) for i in np.flatnonzero(kinds == NORMAL)}
        self._learn(normal, [p.score for p in model.pieces])
        self._spell()

    def _learn(self, normal: dict[str, int], scores: list[float]) -> None:
        chars = sorted(set("".join(normal)))
        self.size = len(self.texts) + len(chars)
        symbols = {c: len(self.texts) + k for k, c in enumerate(chars)} | normal
        self.char_no = np.full(0x110000, -1, dtype=np.int32)
        self.char_no[[ord(c) for c in chars]] = np.arange(len(chars))
        self.symbol_of_char = np.array([symbols[c] for c in chars], dtype=np.int64)
        self.known = np.zeros(self.size, dtype=bool)
        self.known[list(normal.values())] = True
        self.char_of_symbol = {symbols[c]: ord(c) for c in chars if c not in normal}
        number = {c: k for k, c in enumerate(chars)}
        self.beside = np.zeros((len(chars), len(chars)), dtype=bool)
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True))}
        rank = {i: order[scores[i]] for i in normal.values()}
        pairs, careful = {}, np.zeros(len(order), dtype=bool)
        held = np.bincount([rank[i] for text, i in normal.items() if len(text) > 1], minlength=len(order))
        careful[held > 1] = True
        for text, i in normal.items():
            for k in range(1, len(text)):
                self.beside[number[text[k - 1]], number[text[k]]] = True
                left, right = symbols.get(text[:k]), symbols.get(text[k:])
                if left is None or right is None:
                    continue
                pairs[left << 32 | right] = i
                for half in (left, right):
                    if half in rank and rank[half] >= rank[i]:
                        careful[rank[half]] = True
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ids = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        self.pair_ranks = np.array([rank[i] for i in self.pair_ids.tolist()], dtype=np.int64)
        self.pairs, self.careful = {k: (rank[i], i) for k, i in pairs.items()}, careful
        values = np.random.default_rng(20250117).integers(0, 1 << 63, len(chars), dtype=np.uint64)
        self.char_hash = values * np.uint64(2) + np.uint64(1)

    def _spell(self) -> None:
        def bytes_of(i: int) -> bytes:
            kind = self.kinds[i]
            if kind == BYTE:
                return bytes([int(self.texts[i][3:5], 16)])
            if kind == CONTROL:
                return b""
            return (self.unknown_text if kind == UNKNOWN else self.texts[i].replace(SPACE, " ")).encode()

        spelled = [bytes_of(i) for i in range(len(self.texts))]
        self.spelled = spelled
        self.lengths = np.array(list(map(len, spelled)), dtype=np.int64)
        self.firsts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.starts_with_space = np.array([t.startswith(SPACE) for t in self.texts]) & (self.kinds == NORMAL)

    # -- encoding ------------------------------------------------------------------------------------------------------

    def borders(self, number: np.ndarray) -> np.ndarray:
        """Whether a word starts at each character: characters outside the vocabulary stand alone."""
        starts = np.ones(len(number), dtype=bool)
        left, right = number[:-1], number[1:]
        starts[1:] = (left < 0) | (right < 0) | ~self.beside[left, right]
        return starts

    def slices(self, text: str) -> Iterator[str]:
        """A text with its leading space, escaped, in parts of about CHUNK_CHARS that end between words."""
        text, at, size = SPACE + text.replace(" ", SPACE), 0, CHUNK_CHARS
        while len(text) - at > size:
            part = np.frombuffer(text[at : at + size].encode("utf-32-le"), dtype=np.uint32)
            cuts = np.flatnonzero(self.borders(self.char_no[part]))
            if cuts[-1] == 0:
                size *= 2
                continue
            yield text[at : at + int(cuts[-1])]
            at, size = at + int(cuts[-1]), CHUNK_CHARS
        yield text[at:]

    def _queued(self, symbols: list[int]) -> list[int]:
        """Merges the pairs of one long word by rank and place, from a queue."""
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            found = self.pairs.get(symbols[i] << 32 | symbols[j])
            if found:
                heapq.heappush(queue, (found[0], i, j, symbols[i], symbols[j]))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, left, right = heapq.heappop(queue)
            if symbols[i] != left or symbols[j] != right or after[i] != j:
                continue
            symbols[i], symbols[j] = self.pairs[left << 32 | right][1], -1
            after[i] = after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [s for s in symbols if s >= 0]

    def merged(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The final symbols and their words; ``word`` numbers the word of each symbol, rising."""
        done_symbols, done_words = [], []
        for round_ in range(ROUNDS + 1):
            if not len(symbols):
                break
            if round_ == ROUNDS:
                edges = np.flatnonzero(np.r_[True, word[1:] != word[:-1], True])
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    left = self._queued(symbols[a:b].tolist())
                    done_symbols.append(np.array(left, dtype=np.int64))
                    done_words.append(np.full(len(left), word[a], dtype=word.dtype))
                break
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.full(len(symbols), _NO_RANK)
            hit = (self.pair_keys[at] == key) & (word[1:] == word[:-1])
            rank[:-1][hit] = self.pair_ranks[at[hit]]
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            count = np.diff(np.r_[first, len(symbols)])
            low = np.minimum.reduceat(rank, first)
            open_ = low < _NO_RANK
            chosen = np.flatnonzero((rank == np.repeat(low, count)) & (rank < _NO_RANK))
            if len(chosen):
                of = word[chosen]
                new_word = np.r_[True, of[1:] != of[:-1]]
                # pairs that overlap in a row: every other one from the left
                run = np.flatnonzero(new_word | np.r_[True, chosen[1:] != chosen[:-1] + 1])
                nth = np.arange(len(chosen)) - np.repeat(run, np.diff(np.r_[run, len(chosen)]))
                take = (nth % 2 == 0) & (new_word | ~self.careful[rank[chosen]])
                chosen = chosen[take]
                symbols[chosen] = self.pair_ids[at[chosen]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[chosen + 1] = False
            closed = np.repeat(~open_, count)
            done_symbols.append(symbols[closed])
            done_words.append(word[closed])
            keep &= ~closed
            symbols, word = symbols[keep], word[keep]
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _distinct(self, number: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the words: places of the different ones, and the one each word equals. Equal hashes are compared in full."""
        powers = np.cumprod(np.full(int(length.max()), 0x9E3779B97F4A7C15, dtype=np.uint64))
        nth = np.arange(len(number)) - np.repeat(start, length)
        values = np.where(number < 0, np.uint64(0), self.char_hash[number]) * powers[nth]
        hashes = np.add.reduceat(values, start) ^ length.astype(np.uint64)
        _, place, same = np.unique(hashes, return_index=True, return_inverse=True)
        model = start[place[same]]
        if (length != length[place[same]]).any() or (number != number[np.minimum(np.repeat(model, length) + nth, len(number) - 1)]).any():
            return np.arange(len(start)), np.arange(len(start))
        return place, same

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts in one array, and the number of ids of each part."""
        codes = np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32)
        sizes = np.array(list(map(len, parts)), dtype=np.int64)
        ends = np.cumsum(sizes)
        number = self.char_no[codes]
        starts = self.borders(number)
        starts[(ends - sizes)[sizes > 0]] = True
        start = np.flatnonzero(starts)
        length = np.diff(np.r_[start, len(number)])
        place, same = self._distinct(number, start, length)
        # the different words of known characters, flat
        of = np.flatnonzero(number[start[place]] >= 0)
        size = length[place[of]]
        flat = np.repeat(start[place[of]] - np.cumsum(size) + size, size) + np.arange(size.sum())
        ids, word = self.merged(self.symbol_of_char[number[flat]], np.repeat(of, size)) if len(of) else (flat, flat)
        ids, word = self._spelled_out(ids, word)
        n_ids = np.bincount(word, minlength=len(place))
        first = np.cumsum(n_ids) - n_ids
        # every word by its model; a character outside the vocabulary by its bytes, of which its word has none yet
        counts = n_ids[same]
        alone = np.flatnonzero(number[start] < 0)
        raw, raw_size = self._bytes_of(codes[start[alone]])
        counts[alone] = raw_size
        at = np.cumsum(counts) - counts
        known = number[start] >= 0
        out = np.empty(int(counts.sum()), dtype=np.int32)
        out[np.repeat(at[alone], raw_size) + np.arange(len(raw)) - np.repeat(np.cumsum(raw_size) - raw_size, raw_size)] = raw
        k = counts[known]
        inner = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        out[np.repeat(at[known], k) + inner] = ids[np.repeat(first[same[known]], k) + inner]
        total = np.r_[0, np.cumsum(counts)]
        ends_in_words = np.searchsorted(start, ends)
        return out, np.diff(np.r_[0, total[ends_in_words]])

    def _spelled_out(self, ids: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that only stand inside pieces and were not merged become bytes."""
        loose = ~self.known[ids] if len(ids) else np.zeros(0, dtype=bool)
        if not loose.any():
            return ids, word
        raw, size = self._bytes_of(np.array([self.char_of_symbol[i] for i in ids[loose].tolist()], dtype=np.uint32))
        count = np.ones(len(ids), dtype=np.int64)
        count[loose] = size
        out = np.repeat(ids, count)
        out[np.repeat(loose, count)] = raw
        return out, np.repeat(word, count)

    def _bytes_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(codes.tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
        size = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        return self.byte_ids[raw], size

    def encode_texts(self, texts: Iterator[str]) -> Iterator[np.ndarray]:
        """For each text its ids with the end id behind them; an empty text has the end id alone."""
        held: list[str] = []
        owner: list[int] = []
        open_, tail, size = 0, [], 0  # open_: texts not given out yet; tail: ids of the first of them that are known

        def flush() -> Iterator[np.ndarray]:
            nonlocal held, owner, open_, tail, size
            ids, counts = self.encode_parts(held) if held else (np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64))
            at = 0
            whole = [tail, *([] for _ in range(open_ - 1))] if open_ else []
            for n, of in zip(counts.tolist(), owner):
                whole[of].append(ids[at : at + n])
                at += n
            for parts in whole[:-1]:
                yield np.concatenate([*parts, [self.end]]).astype(np.int32)
            tail, held, owner, size = (whole[-1] if whole else []), [], [], 0
            open_ = min(open_, 1)

        for text in texts:
            open_ += 1
            for part in self.slices(text) if text else ():
                held.append(part)
                owner.append(open_ - 1)
                size += len(part)
                if size >= CHUNK_CHARS:
                    yield from flush()
        yield from flush()
        if open_:
            yield np.concatenate([*tail, [self.end]]).astype(np.int32)

    # -- decoding ------------------------------------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: control ids say nothing, the first space of the text is dropped, bytes that make no character are U+FFFD."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.texts)):
            raise ValueError("an id lies outside the vocabulary")
        size = self.lengths[ids]
        ends = np.cumsum(size)
        raw = self.letters[np.repeat(self.firsts[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        said = np.flatnonzero(self.kinds[ids] != CONTROL)
        drop = int(len(said) > 0 and self.starts_with_space[ids[said[0]]])
        try:
            return raw[drop:].decode()
        except UnicodeDecodeError:
            return self._mended(ids, int(said[0]) if drop else -1)

    def _mended(self, ids: np.ndarray, spaced: int) -> str:
        """Runs of byte ids decoded one by one, each byte of no character as a sign of its own."""
        out = []
        raw = b""
        for i, id_ in enumerate([*ids.tolist(), None]):
            if id_ is not None and self.kinds[id_] == BYTE:
                raw += self.spelled[id_]
                continue
            while raw:
                try:
                    out.append(raw.decode())
                    break
                except UnicodeDecodeError as error:
                    out.append(raw[: error.start].decode() + "�")
                    raw = raw[error.start + 1 :]
            raw = b""
            if id_ is not None:
                out.append(self.spelled[id_].decode()[i == spaced :])
        return "".join(out)


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for each worker process; the model file is part of the installation on every host."""
    return Vocabulary(path)


def _grouped(values: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for ids in values:
        held.append(ids)
        size += len(ids)
        if size >= FLUSH_IDS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _lists(parts: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(np.concatenate(parts)))


def _mapped(df: DataFrame, source: str, made: list[StructField], make) -> DataFrame:
    """The columns of ``df`` but those named as ``made``, and ``made``, which ``make`` gives for an Arrow column in parts."""
    new = {f.name.lower() for f in made}
    keep = [i for i, n in enumerate(df.columns) if n.lower() not in new]
    schema = StructType([*(df.schema.fields[i] for i in keep), *made])
    at = df.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for parts in make(batch.column(at)):
                kept = [batch.column(i).slice(first, len(parts[0])) for i in keep]
                yield pa.RecordBatch.from_arrays([*kept, *parts], names=schema.names)
                first += len(parts[0])

    return df.mapInArrow(run, schema)


_IDS, _DECODED = StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())


def encode(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the pieces of ``column`` by the model at ``path`` and the end id behind them.

    NULL and empty texts have the end id alone; whole texts are encoded however long, in slices that end between words;
    repeated rows stay rows, no rows give no rows. A column named ids is replaced, all others stay as they are.
    """
    def make(texts: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
        for part in _grouped(vocabulary(path).encode_texts(v.as_py() or "" for v in texts)):
            yield (_lists(part),)

    return _mapped(docs, column, [_IDS], make)


def decode(df: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the text of the ids in ``column``; NULL or no ids give an empty text, an unknown id raises."""
    def make(lists: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
        model, none = vocabulary(path), np.zeros(0, dtype=np.int32)
        for part in _grouped(v.values.to_numpy() if v.is_valid else none for v in lists):
            yield (pa.array([model.decode(ids) for ids in part], pa.string()),)

    return _mapped(df, column, [_DECODED], make)


def round_trip(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``encode`` and ``decode`` of these ids in one pass: ``docs`` with ``ids`` and ``decoded``."""
    def make(texts: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
        model = vocabulary(path)
        for part in _grouped(model.encode_texts(v.as_py() or "" for v in texts)):
            yield _lists(part), pa.array([model.decode(ids) for ids in part], pa.string())

    return _mapped(docs, column, [_IDS, _DECODED], make)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """One row for each document: its number of ids, a digest of them, and of the text that they decode to."""
    done = round_trip(docs.select("doc_id", "text"), path)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
