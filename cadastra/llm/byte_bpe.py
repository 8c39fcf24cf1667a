"""Byte-level BPE by corpus-level merge replay.

Documents are read in blocks. The distinct pieces of a block are laid out side by side as one string of
symbols, and an inverted index lists, for the rank of every pair that may merge, the positions that hold
such a pair. Ranks are taken in order; all positions of a rank merge at once, and only the pairs of the
two touched neighbours are looked up and listed anew. So a merge costs its occurrences among distinct
pieces, however often these stand in the texts, and a piece of any length costs no square.

Pieces are independent of one another, so replaying block by block gives the ids that one replay over the
whole corpus would give: no text and no vocabulary of the corpus is shuffled, and memory is that of a block.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from typing import Generic, TypeVar

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

# Characters of text whose distinct pieces are replayed together.
BLOCK_CHARS = 8 << 20
# Pieces remembered per worker from one block to the next: at most twice as many.
REMEMBERED = 200_000
LONG_PIECE = 256
# Fixed value: the pattern of these vocabularies, which parts a text into pieces.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_SINGLE = [bytes([byte]) for byte in range(256)]
Value = TypeVar("Value")


class Remembered(Generic[Value]):
    """What was last put in or asked for, in two generations: when the new one is full, the old one is dropped."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key: str) -> Value | None:
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: Value) -> None:
        if len(self.new) >= self.size:
            self.new, self.old = {}, self.new
        self.new[key] = value


class Numbered(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        return number


def _class_ranges(points: set[int]) -> str:
    """Code points as the inside of a character class."""
    parts, listed = [], sorted(points)
    for at, point in enumerate(listed):
        if at and listed[at - 1] == point - 1:
            parts[-1][1] = point
        else:
            parts.append([point, point])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in parts)


class Splitter:
    """The pieces of a text by a pattern, with character classes as the tiktoken library knows them.

    The library's tables may be of another Unicode version than those of :mod:`regex`, so it is asked once
    which characters each class holds; texts with a character on which both differ take a pattern of their own.
    """

    def __init__(self, pattern: str):
        everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        single = {byte: at for at, byte in enumerate(_SINGLE)}
        exact, differing = pattern, set()
        for name in (r"\p{L}", r"\p{N}", r"\s"):
            if name not in pattern:
                continue
            asked = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
            theirs = set(map(ord, bytes(asked.encode_ordinary(everything)).decode()))
            ours = set(map(ord, regex.findall(name, everything)))
            more, less = _class_ranges(theirs - ours), _class_ranges(ours - theirs)
            held = f"[{name}--[{less}]]" if less else name
            exact = exact.replace(name, f"[{held}||[{more}]]" if more else held)
            differing |= theirs ^ ours
        self.plain = regex.compile(pattern).findall
        self.exact = regex.compile("(?V1)" + exact).findall
        self.differs = regex.compile(f"[{_class_ranges(differing)}]" if differing else "(?!)").search
        self.latin = min(differing, default=0x110000) > 0xFF

    def _certain(self, text: str) -> bool:
        """Whether both tables know all characters of the text alike."""
        if self.latin:
            try:
                text.encode("latin-1")
                return True
            except UnicodeEncodeError:
                pass
        return not self.differs(text)

    def __call__(self, text: str) -> list[str]:
        return self.plain(text) if self._certain(text) else self.exact(text)


class ByteBpe:
    """Encoder and decoder for a file of ranks: one base64 token and its rank per line."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.split = Splitter(pattern)
        pairs = (self.ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256))
        self.first_pairs = np.fromiter(pairs, np.int64, 1 << 16)
        self.known: Remembered[array] = Remembered(REMEMBERED)

    def replay(self, words: list[bytes]) -> list[array]:
        """The ids of every word, by applying all merges to all words in rank order."""
        data = b"".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        codes = np.frombuffer(data, np.uint8).astype(np.int64)
        word_of = np.repeat(np.arange(len(words)), sizes).tolist()
        after = np.arange(1, len(codes) + 1)
        before = np.arange(-1, len(codes) - 1)
        after[ends[sizes > 0] - 1] = -1
        before[(ends - sizes)[sizes > 0]] = -1
        # The rank of the pair that now begins at a position, or -1; what is listed under another is out of date.
        places, now = self._first_index(codes, after)
        after, before, now = after.tolist(), before.tolist(), now.tolist()
        part = list(map(_SINGLE.__getitem__, data))
        rank_of, bytes_of = self.ranks.get, self.bytes_of
        heap = list(places)
        heapify(heap)
        while heap:
            rank = heappop(heap)
            listed = places.pop(rank)
            listed.sort()
            made = bytes_of[rank]
            # In a word where a merge made a pair of lower rank, that pair goes first.
            held, later = set(), []
            for at in listed:
                if now[at] != rank:
                    continue
                if held and word_of[at] in held:
                    later.append(at)
                    continue
                other = after[at]
                beyond = after[at] = after[other]
                part[at], part[other], now[other] = made, None, -1
                found = -1
                if beyond >= 0:
                    before[beyond] = at
                    found = rank_of(made + part[beyond], -1)
                    if found >= 0:
                        if found in places:
                            places[found].append(at)
                        else:
                            places[found] = [at]
                            heappush(heap, found)
                        if found < rank:
                            held.add(word_of[at])
                now[at] = found
                ahead = before[at]
                if ahead >= 0:
                    found = now[ahead] = rank_of(part[ahead] + made, -1)
                    if found >= 0:
                        if found in places:
                            places[found].append(ahead)
                        else:
                            places[found] = [ahead]
                            heappush(heap, found)
                        if found < rank:
                            held.add(word_of[at])
            if later:
                if rank not in places:
                    heappush(heap, rank)
                places.setdefault(rank, []).extend(later)
        begin, ids = 0, []
        for end in ends.tolist():
            ids.append(array("i", [self.ranks[token] for token in part[begin:end] if token]))
            begin = end
        return ids

    def _first_index(self, codes: np.ndarray, after: np.ndarray) -> tuple[dict[int, list[int]], np.ndarray]:
        """Positions of all mergeable pairs of single bytes, by rank, and the rank at every position."""
        now = np.full(len(codes), -1, np.int64)
        inner = np.flatnonzero(after >= 0)
        if not len(inner):
            return {}, now
        now[inner] = self.first_pairs[codes[inner] << 8 | codes[inner + 1]]
        inner = np.flatnonzero(now >= 0)
        inner = inner[np.argsort(now[inner], kind="stable")]
        ranks = now[inner]
        starts = np.flatnonzero(np.diff(ranks, prepend=-1))
        return dict(zip(ranks[starts].tolist(), map(np.ndarray.tolist, np.split(inner, starts[1:])))), now

    def solve(self, pieces: Iterable[str]) -> list[array]:
        """The ids of each piece: a piece that is a token is that token, all others are replayed together."""
        pieces = list(pieces)
        found = [self.known.get(piece) for piece in pieces]
        fresh = []
        for at, (piece, ids) in enumerate(zip(pieces, found)):
            if ids is None:
                whole = self.ranks.get(piece.encode())
                if whole is None:
                    fresh.append((piece.encode(), at))
                else:
                    found[at] = array("i", [whole])
        # Sorted, so that the positions of a pair lie near one another in memory.
        fresh.sort()
        for (_, at), ids in zip(fresh, self.replay([word for word, _ in fresh])):
            found[at] = ids
            if len(pieces[at]) <= LONG_PIECE:
                self.known.put(pieces[at], ids)
        return found

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of the tokens, joined; an id without a token is left out."""
        return b"".join([self.bytes_of.get(i, b"") for i in ids])


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    """The vocabulary of a file, read once per worker."""
    return ByteBpe(path, pattern)


def _blocks(batches: Iterator[pa.RecordBatch], bpe: ByteBpe, block_chars: int) -> Iterator[tuple]:
    """(ids of rows, numbers of each row's pieces, ids of each numbered piece) per block of documents."""
    number, keys, rows, size = Numbered(), [], [], 0
    for batch in batches:
        for key, value in zip(batch.column(0), batch.column(1)):
            text = value.as_py() or ""
            rows.append(array("i", map(number.__getitem__, bpe.split(text))))
            keys.append(key)
            size += len(text)
            if size >= block_chars:
                yield keys, rows, bpe.solve(number)
                number, keys, rows, size = Numbered(), [], [], 0
    if keys:
        yield keys, rows, bpe.solve(number)


def _key_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def encode_documents(docs: DataFrame, ranks: str, text: str = "text", pattern: str = PATTERN,
                     block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text, by a file of ranks, without special tokens.

    A null text counts as empty and gives no ids. Every row gives a row, repeated rows and null ids
    included. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows, solved in _blocks(batches, load(ranks, pattern), block_chars):
            for key, numbers in zip(keys, rows):
                ids = array("i")
                for number in numbers:
                    ids.extend(solved[number])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key.as_py()], key.type), pa.array([np.array(ids, np.int32)], pa.list_(pa.int32()))],
                    ["doc_id", "ids"],
                )

    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {_key_type(docs)}, ids array<int>")


def decode_documents(encoded: DataFrame, ranks: str, ids: str = "ids", pattern: str = PATTERN) -> DataFrame:
    """(doc_id, decoded binary): the bytes of each row's tokens. Null ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks, pattern)
        for batch in batches:
            decoded = [bpe.decode(row.as_py() or ()) for row in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", ids).mapInArrow(run, f"doc_id {_key_type(encoded)}, decoded binary")


def digest_documents(docs: DataFrame, ranks: str, text: str = "text", pattern: str = PATTERN,
                     block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the encoding's digests without its arrays.

    The same encoder and decoder as above, with the same rules for nulls and repeated rows; what is
    written down and decoded of a piece is made once per block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks, pattern)
        for keys, rows, solved in _blocks(batches, bpe, block_chars):
            shown = [",".join(map(str, ids)) for ids in solved]
            decoded = [bpe.decode(ids) for ids in solved]
            lengths = np.fromiter(map(len, solved), np.int64, len(solved))
            counts, of_ids, of_text = [], [], []
            for numbers in rows:
                counts.append(int(lengths[np.frombuffer(numbers, np.int32)].sum()) if numbers else 0)
                of_ids.append(hashlib.sha256(",".join(map(shown.__getitem__, numbers)).encode()).hexdigest())
                of_text.append(hashlib.sha256(b"".join(map(decoded.__getitem__, numbers))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array([key.as_py() for key in keys], keys[0].type), pa.array(counts, pa.int64()),
                 pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", text).mapInArrow(
        run, f"doc_id {_key_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
