"""Exact byte-level BPE by backtracking over longest matches, and its inverse.

Tokens are Latin-1 keys of an Aho-Corasick automaton. A text's pieces are encoded from left to right by the longest token
that may follow the one before; two tokens may stand side by side only if merging their bytes by rank gives just these
two, which is remembered per pair. A dead end takes the next shorter token, or takes back the last one. Each position is
left for good at most once, so a piece costs linear time, and the result is that of merging by rank. The different pieces of a
chunk of texts take these steps together, as arrays.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

from spotshare.llm.common import chunks, lean

_PAIRS = 1 << 17
_WORDS = 40_000  # of each of two generations; the young one may also hold those of one chunk
_LONGEST_REMEMBERED = 64
_FLUSH_IDS = 1 << 20
_SEARCHED_BYTES = 1 << 18  # of pieces that are searched together
_LONG = 1 << 12  # a piece of more bytes is searched alone
_FEW = 48  # so few pieces are searched one after the other
_PLACES, _SPREAD = 19, 0x1E3779B97F4A7C15  # bits and multiplier of the places of remembered pairs
_NODE_WORDS = 5  # of 64 bytes each; the last one, which stays empty, for 256


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


# Under this published pattern a single space between two other characters always starts a piece, so what stands between two
# such spaces is encoded alike wherever it stands. (Fixed value.)
SPLITS_AT_SPACES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Encodes pieces by a vocabulary of byte strings and ranks that holds all 256 bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.sizes = list(map(len, self.tokens))
        self.shorter: list[int] = [-1] * len(self.tokens)  # the longest token that is a shorter prefix
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.fits: dict[int, bool] = {}
        self.young: dict[str, bytes] = {}  # the ids of words with a space before them, four bytes each
        self.old: dict[str, bytes] = {}
        self.by_words = pattern == SPLITS_AT_SPACES
        self._learn()
        self.fits.clear()
        # the last place of each is for a rank of -1
        self.size_of = np.array([*self.sizes, 0], dtype=np.int64)
        self.shorter_of = np.array([*self.shorter, -1], dtype=np.int64)
        self.pair_at = np.full(1 << _PLACES, -1, dtype=np.int64)
        self.fit_at = np.zeros(1 << _PLACES, dtype=bool)
        self._plant()

    def _plant(self) -> None:
        """The trie of the automaton as arrays, breadth first: which bytes follow a node, 64 in each word, and the first child of each word."""
        nodes = sorted({key[:n] for key in self.by_text for n in range(len(key) + 1)}, key=lambda x: (len(x), x))
        index = {node: i for i, node in enumerate(nodes)}
        word = np.array([index[node[:-1]] * _NODE_WORDS + (ord(node[-1]) >> 6) for node in nodes[1:]], dtype=np.int64)
        bit = np.left_shift(np.uint64(1), np.array([ord(node[-1]) & 63 for node in nodes[1:]], dtype=np.uint64))
        self.follows = np.zeros(len(nodes) * _NODE_WORDS, dtype=np.uint64)
        np.bitwise_or.at(self.follows, word, bit)
        self.child = np.zeros(len(nodes) * _NODE_WORDS, dtype=np.int32)
        self.child[word[::-1]] = np.arange(len(nodes) - 1, 0, -1)
        self.rank_at = np.array([self.by_text.get(node, -1) for node in nodes], dtype=np.int32)

    def _longest_all(self, codes: np.ndarray) -> np.ndarray:
        """The longest token that starts at each place of bytes in which 256 stands after each piece; -1: none."""
        words, bits = codes >> 6, np.left_shift(np.uint64(1), (codes & 63).astype(np.uint64))
        longest = np.full(len(codes), -1, dtype=np.int64)
        start = at = np.arange(len(codes))
        node = np.zeros(len(codes), dtype=np.int64)
        while len(start):
            place, bit = node * _NODE_WORDS + words[at], bits[at]
            follows = self.follows[place]
            on = np.flatnonzero(follows & bit)
            start, at = start[on], at[on] + 1
            node = self.child[place[on]] + np.bitwise_count(follows[on] & (bit[on] - np.uint64(1))).astype(np.int64)
            rank = self.rank_at[node]
            ends = np.flatnonzero(rank >= 0)
            longest[start[ends]] = rank[ends]
        return longest

    def _learn(self) -> None:
        """By rising rank, the two tokens that merge into each token.

        The tokens before it encode its bytes; if that gives other than two tokens, merging never makes it: it is only
        the answer for a piece that equals it, and no key of the automaton.
        """
        self._build(self.ranks)
        for token in sorted(self.ranks, key=len):
            self.shorter[self.ranks[token]] = next(
                (self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks), -1
            )
        unmade = set()
        for token, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                continue
            parts = self._search(token, rank, unmade)
            if len(parts) == 2:
                self.halves[rank] = parts[0], parts[1]
                self.joined[parts[0], parts[1]] = rank
                self.fits[parts[0] << 32 | parts[1]] = False  # a new merge changes no other pair: those look at older ranks
            else:
                unmade.add(rank)
        if unmade:
            self._build({t: r for t, r in self.ranks.items() if r not in unmade})
            for rank, shorter in enumerate(self.shorter):
                while shorter in unmade:
                    shorter = self.shorter[shorter]
                self.shorter[rank] = shorter

    def _build(self, ranks: dict[bytes, int]) -> None:
        self.by_text = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.longest_size = max(map(len, ranks))
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.by_text.items():
            self.automaton.add_word(token, rank)
        self.automaton.make_automaton()

    def _fit(self, left: int, right: int) -> bool:
        """Whether merging the bytes of the two tokens by rank gives just these two.

        The border is crossed if some token that ends the left one, as it is built, meets one that starts the right one and
        their merge has a lower rank than the merges that bury them. The later built of the two is taken apart first.
        """
        a, b, limit, result = left, right, 1 << 62, True
        while True:
            if self.joined.get((a, b), limit) < limit:
                result = False
                break
            # of equal ranks, the merge further left comes first, so the right token is then the later one
            if a > b:
                if a in self.halves:
                    limit, a = a, self.halves[a][1]
                elif b in self.halves:
                    limit, b = b + 1, self.halves[b][0]
                else:
                    break
            elif b in self.halves:
                limit, b = b + 1, self.halves[b][0]
            elif a in self.halves:
                limit, a = a, self.halves[a][1]
            else:
                break
        return result

    def _longest(self, text: str, at: int) -> int:
        """The longest token that starts at a place of a Latin-1 text."""
        size = self.automaton.longest_prefix(text[at : at + self.longest_size])  # of a path of the trie: a token may end before
        rank = self.by_text.get(text[at : at + size])
        while rank is None:
            size -= 1
            if not size:
                raise ValueError("the vocabulary lacks a byte")
            rank = self.by_text.get(text[at : at + size])
        return rank

    def _search(self, piece: bytes, below: int = 1 << 32, unmade: set[int] = frozenset()) -> list[int]:
        """The tokens of a piece, of ranks under ``below`` that merging can make."""
        n = len(piece)
        text = piece.decode("latin-1")
        shorter, sizes, fits = self.shorter, self.sizes, self.fits
        dead = bytearray(n + 1)
        taken: list[int] = []
        at, last, rank = 0, -1, self._longest(text, 0)
        while True:
            while rank >= 0:
                end = at + sizes[rank]
                if not dead[end] and rank < below and rank not in unmade:
                    if last < 0:
                        break
                    fit = fits.get(last << 32 | rank)
                    if fit is None:
                        if len(fits) >= _PAIRS:
                            fits.clear()
                        fit = fits[last << 32 | rank] = self._fit(last, rank)
                    if fit:
                        break
                rank = shorter[rank]
            if rank >= 0:
                taken.append(rank)
                if end == n:
                    return taken
                at, last, rank = end, rank, self._longest(text, end)
            elif taken:
                dead[at] = 1
                at -= sizes[taken.pop()]
                rank, last = shorter[last], taken[-1] if taken else -1
            else:
                raise ValueError("no tokens make this piece")

    def _fitting(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each two tokens may stand side by side; what was found lately is remembered, one pair in each place."""
        pairs = left << 32 | right
        place = (pairs * _SPREAD & 0x7FFFFFFFFFFFFFFF) >> 63 - _PLACES
        new = np.flatnonzero(self.pair_at[place] != pairs)
        if not len(new):
            return self.fit_at[place]
        found = self.fit_at[place]
        asked, at = np.unique(pairs[new], return_inverse=True)
        found[new] = np.array([self._fit(pair >> 32, pair & 0xFFFFFFFF) for pair in asked.tolist()], dtype=bool)[at]
        # of pairs that share a place the last one stays, with its own finding
        self.pair_at[place[new]] = pairs[new]
        self.fit_at[place[new]] = found[new]
        return found

    def _search_all(self, raws: list[bytes]) -> list[bytes]:
        """The ids of pieces, four bytes each, by the steps of ``_search``, one step of every piece at a time."""
        lengths = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        ends = np.cumsum(lengths + 1) - 1  # after each piece stands a border
        starts = ends - lengths
        codes = np.frombuffer(b"\0".join(raws) + b"\0", dtype=np.uint8).astype(np.int64)
        codes[ends] = 256
        size, shorter, longest = self.size_of, self.shorter_of, self._longest_all(codes)
        dead = np.zeros(len(codes), dtype=bool)
        taken = np.full(len(codes), -1, dtype=np.int64)  # the token that ends at a place, -1 at a start
        who, at = np.arange(len(raws)), starts.copy()
        rank = longest[at]
        while len(who) > _FEW:
            end, last = at + size[rank], taken[at]
            goes = (rank >= 0) & ~dead[end]
            ask = np.flatnonzero(goes & (last >= 0))
            goes[ask] = self._fitting(last[ask], rank[ask])
            stuck = np.flatnonzero(rank < 0)
            if (last[stuck] < 0).any():
                raise ValueError("no tokens make this piece")
            dead[at[stuck]] = True
            taken[end[goes]] = rank[goes]
            at[stuck] -= size[last[stuck]]
            rank = np.where(goes, -1, shorter[rank])
            rank[stuck] = shorter[last[stuck]]
            at = np.where(goes, end, at)
            rank[goes] = longest[at[goes]]
            on = np.flatnonzero(~(goes & (at == ends[who])))
            if len(on) < len(who):
                who, at, rank = who[on], at[on], rank[on]
        # from the ends to the starts, then in order
        left = np.ones(len(raws), dtype=bool)
        left[who] = False
        held, at, index = [], ends[left], np.flatnonzero(left)
        while len(index):
            token = taken[at]
            held.append((index, at, token))
            at = at - size[token]
            on = at > starts[index]
            index, at = index[on], at[on]
        done = [b""] * len(raws)
        if held:
            index, at, token = map(np.concatenate, zip(*held))
            order = np.argsort(at)
            ids = token[order].astype(np.int32).tobytes()
            bounds = (4 * np.r_[0, np.cumsum(np.bincount(index, minlength=len(raws)))]).tolist()
            done = [ids[first:end] for first, end in zip(bounds, bounds[1:])]
        for i in who.tolist():
            done[i] = array("i", self._search(raws[i])).tobytes()
        return done

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces, four bytes each."""
        raws = [piece.encode() for piece in pieces]
        done = list(map(self.ranks.get, raws))
        places, asked = [], []
        for i, rank in enumerate(done):
            if rank is not None:
                done[i] = rank.to_bytes(4, sys.byteorder)
            elif len(raws[i]) > _LONG:
                done[i] = array("i", self._search(raws[i])).tobytes()
            else:
                places.append(i)
                asked.append(raws[i])
        for first, some in chunks(asked, _SEARCHED_BYTES):
            for i, ids in zip(places[first:], self._search_all(some)):
                done[i] = ids
        return done

    def _matched(self, parts: list[str]) -> list[bytes]:
        """The ids of each of the matches ``parts``."""
        different = list(set(parts))
        return list(map(dict(zip(different, self._pieces(different))).__getitem__, parts))

    def _matches(self, texts: list[str]) -> list[bytes]:
        """The ids of all matches of the pattern in each text."""
        parts = [self.pattern.findall(text) for text in texts]
        ids = iter(self._matched([part for found in parts for part in found]))
        return [b"".join(islice(ids, len(found))) for found in parts]

    def _learn_words(self, words: set[str]) -> None:
        """Puts the ids of words with a space before them into the young generation, but for words that white space borders on.

        Of letters alone the pattern needn't be asked; of the others in one text, each starts with the match that starts with a space.
        """
        letters = list(filter(str.isalpha, words))
        self.young.update(zip(letters, self._pieces([" " + word for word in letters])))
        others = [word for word in words.difference(letters) if word and not (word[0].isspace() or word[-1].isspace())]
        if others:
            parts = self.pattern.findall(" " + " ".join(others))
            ids = self._matched(parts)
            bounds = [i for i, part in enumerate(parts) if part[0] == " "]
            self.young.update((word, b"".join(ids[first:end])) for word, first, end in zip(others, bounds, [*bounds[1:], len(ids)], strict=True))

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each of a chunk of texts, four bytes each in the machine's order."""
        if not self.by_words:
            return self._matches(texts)
        split = [text.split(" ") for text in texts]
        new = set().union(*split).difference(self.young)
        kept = new.intersection(self.old)
        self.young.update((word, self.old[word]) for word in kept)
        self._learn_words(new - kept)
        done = []
        for words, head in zip(split, self._matches([words[0] for words in split])):
            parts = list(map(self.young.get, words))
            parts[0] = head
            done.append(b"".join(self._loose(parts, words) if None in parts else parts))
        for word in [word for word in new if len(word) > _LONGEST_REMEMBERED]:
            self.young.pop(word, None)
        if len(self.young) >= _WORDS:
            self.old, self.young = self.young, {}
        return done

    def _loose(self, parts: list[bytes | None], words: list[str]) -> list[bytes]:
        """The ids of a text in which words stand that white space borders on: a run of these is asked of the pattern in one."""
        runs, done = [], []
        for i, (part, word) in enumerate(zip(parts, words)):
            if i == 0 or part is None and done[-1] is None:
                done += [None] * (i == 0)
                runs += [[]] * (i == 0)
                runs[-1].append(word)
            elif part is None:
                done.append(None)
                runs.append(["", word])
            else:
                done.append(part)
        found = iter(self._matches([" ".join(run) for run in runs]))
        return [next(found) if part is None else part for part in done]

    def forget(self) -> None:
        """Drops the remembered words: an idle worker keeps the vocabulary alone."""
        self.young, self.old = {}, {}

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed([text])[0]).tolist()


class Speller:
    """The bytes of tokens, for decoding: far smaller than an encoder."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.size = np.array(list(map(len, tokens)), dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.letters = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.letters[np.repeat(self.first[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


@lru_cache(maxsize=1)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each worker process; the vocabulary file is part of the installation on every host."""
    return Encoder(read_ranks(path), pattern)


@lru_cache(maxsize=1)
def speller(path: str) -> Speller:
    return Speller(read_ranks(path))


def _mapped(
    df: DataFrame, source: str, made: dict[str, DataType], make: Callable[[pa.Array], Iterator[tuple[pa.Array, ...]]],
    after: Callable[[], None] = lambda: None,
) -> DataFrame:
    """All columns of ``df`` and those of ``made``, which ``make`` gives for column ``source`` in parts of bounded size.

    ``after`` is called at the end of a task.
    """
    keep = [n for n in df.columns if n.lower() not in made]
    schema = StructType([*(df.schema[n] for n in keep), *(StructField(n, kind) for n, kind in made.items())])
    place = {n: i for i, n in enumerate(df.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for parts in make(batch.column(place[source])):
                kept = [batch.column(place[n]).slice(first, len(parts[0])) for n in keep]
                yield pa.RecordBatch.from_arrays([*kept, *parts], names=[*keep, *made])
                first += len(parts[0])
        after()

    return df.mapInArrow(lean(run), schema)


def _lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), dtype=np.int32)))


def _flushed(values: Iterator[bytes]) -> Iterator[list[bytes]]:
    """The values in lists of bounded size."""
    held, size = [], 0
    for value in values:
        held.append(value)
        size += len(value)
        if size >= 4 * _FLUSH_IDS:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(docs: DataFrame, path: str, pattern: str, column: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the tokens of ``column``: what merging by rank gives for each match of ``pattern``.

    A NULL or empty text has no ids; whole texts are encoded however long; repeated rows stay rows. A column named ids is
    replaced, all others stay as they are.
    """
    def make(texts: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
        packed = encoder(path, pattern).packed
        for _, part in chunks(value.as_py() or "" for value in texts):
            yield (_lists(packed(part)),)

    return _mapped(docs, column, {"ids": ArrayType(IntegerType())}, make, lambda: encoder(path, pattern).forget())


def decode(df: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the bytes of the tokens in ``column``; NULL or no ids give no bytes, an unknown id raises."""
    def make(lists: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
        spell = speller(path).decode
        none = np.zeros(0, dtype=np.int32)
        for part in _flushed(spell(value.values.to_numpy() if value.is_valid else none) for value in lists):
            yield (pa.array(part, pa.binary()),)

    return _mapped(df, column, {"decoded": BinaryType()}, make)


def round_trip(docs: DataFrame, path: str, pattern: str, column: str = "text") -> DataFrame:
    """``encode`` and ``decode`` one after the other in one pass: ``docs`` with ``ids`` and ``decoded``, the bytes of these ids."""
    def make(texts: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
        packed, spell = encoder(path, pattern).packed, speller(path).decode
        for _, some in chunks(value.as_py() or "" for value in texts):
            part = packed(some)
            yield _lists(part), pa.array([spell(np.frombuffer(ids, dtype=np.int32)) for ids in part], pa.binary())

    return _mapped(docs, column, {"ids": ArrayType(IntegerType()), "decoded": BinaryType()}, make, lambda: encoder(path, pattern).forget())


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row for each document: its number of ids, a digest of them, and of the bytes that they decode to."""
    done = round_trip(docs.select("doc_id", "text"), path, pattern)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
