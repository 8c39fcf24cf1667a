"""BPE encoding and decoding with a contiguous rank array per word.

A word's parts and the ranks of their adjacent pairs lie in two short lists. The smallest rank is
scanned for, its boundary deleted, and the two neighbouring ranks refreshed, until no pair has a rank.
Words beyond ``LONG_WORD`` symbols give the same merges from a heap, so a text that is one long word
does not cost the square of its length. Texts are encoded whole, in the task that reads them, with no
shuffle.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

LONG_WORD = 256
# Pieces remembered per worker; beyond it the memory is emptied and fills anew.
REMEMBERED = 300_000
_NO_RANK = 1 << 30
# str.split() takes these four for spaces; the vocabulary's pattern does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_GAP = regex.compile(r"\p{White_Space}+")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + at) for at, b in enumerate(hidden)}


class WordBpe:
    """Encoder and decoder for a tokenizer file of kind BPE with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.token = {number: token for token, number in {**vocab, **self.special}.items()}
        letters = byte_letters()
        self.byte_of = {letter: byte for byte, letter in letters.items()}
        self.library = Tokenizer.from_file(path)
        self.inner = [vocab[letters[byte]] for byte in range(256)]
        self.last = [vocab[letters[byte] + self.suffix] for byte in range(256)]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for at, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.rank.setdefault(vocab[left] << 20 | vocab[right], at)
            self.made.append(vocab[left + right])
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.markers = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.words: dict[str, tuple[bytes, str]] = {}
        self.chunks: dict[str, tuple[bytes, str]] = {}

    def merge(self, parts: list[int]) -> list[int]:
        """Merge the parts of a word, lowest rank first and leftmost among equals."""
        if len(parts) > LONG_WORD:
            return self._merge_long(parts)
        rank, none = self.rank.get, _NO_RANK
        ranks = [rank(a << 20 | b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            at = ranks.index(least)
            parts[at] = self.made[least]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] << 20 | parts[at], none)
            if at < len(ranks):
                ranks[at] = rank(parts[at] << 20 | parts[at + 1], none)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges from a heap of (rank, place), with links in place of deletions."""
        rank, size = self.rank.get, len(parts)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(size - 1)
                if (r := rank(parts[i] << 20 | parts[i + 1])) is not None]
        heapify(heap)
        while heap:
            least, at, left, right = heappop(heap)
            other = after[at]
            if parts[at] != left or other >= size or parts[other] != right:
                continue
            parts[at], parts[other] = self.made[least], -1
            after[at] = after[other]
            if after[at] < size:
                before[after[at]] = at
            for i in (before[at], at):
                if i >= 0 and after[i] < size:
                    r = rank(parts[i] << 20 | parts[after[i]])
                    if r is not None:
                        heappush(heap, (r, i, parts[i], parts[after[i]]))
        return [part for part in parts if part >= 0]

    def word(self, word: str) -> tuple[bytes, str]:
        """Ids of a word as packed 32-bit integers, and its decoded text."""
        found = self.words.get(word)
        if found is None:
            data = word.encode()
            ids = self.merge([self.inner[byte] for byte in data[:-1]] + [self.last[data[-1]]])
            found = np.array(ids, "<u4").tobytes(), " ".join([self.token[i] for i in ids])
            if len(word) <= LONG_WORD:
                if len(self.words) >= REMEMBERED:
                    self.words.clear()
                self.words[word] = found
        return found

    def chunk(self, chunk: str) -> tuple[bytes, str]:
        """Ids and decoded text of a run without white space."""
        pieces = [self.word(piece) for piece in self.pieces(chunk)]
        found = b"".join([ids for ids, _ in pieces]), " ".join([text for _, text in pieces])
        if len(chunk) <= LONG_WORD:
            if len(self.chunks) >= REMEMBERED:
                self.chunks.clear()
            self.chunks[chunk] = found
        return found

    def pieces(self, chunk: str) -> list[str]:
        """Normalized words of a chunk, in the file's own character classes.

        Classes of newer letters depend on the Unicode version, so beyond the Latin blocks the
        tokenizer's own normalizer and splitter decide; merging is the same for all.
        """
        if chunk.isascii():
            return self.pattern.findall(chunk.lower())
        if max(chunk) < "\u0250":
            return self.pattern.findall(unicodedata.normalize("NFC", chunk).lower())
        shown = self.library.normalizer.normalize_str(chunk)
        return [
            bytes(self.byte_of[letter] for letter in piece).decode()
            for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(shown)
        ]

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        chunks = text.split() if not _SEPARATORS.search(text) else [c for c in _GAP.split(text) if c]
        known, make = self.chunks.get, self.chunk
        return [known(chunk) or make(chunk) for chunk in chunks]

    def encode(self, text: str) -> tuple[bytes, str]:
        """All ids of a text, packed, and what they decode to. Markers in the text are single ids."""
        if not any(marker in text for marker in self.special):
            found = self._plain(text)
        else:
            found, at = [], 0
            for marker in self.markers.finditer(text):
                found += self._plain(text[at:marker.start()])
                found.append((np.array([self.special[marker[0]]], "<u4").tobytes(), marker[0]))
                at = marker.end()
            found += self._plain(text[at:])
        return b"".join([ids for ids, _ in found]), " ".join([text for _, text in found])

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, special ones included, as a file without a decoder says."""
        return " ".join(self.token[i] for i in ids if i in self.token)


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """The tokenizer of a file, read once per worker."""
    return WordBpe(path)


def encode_documents(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded) of every whole text.

    A null text counts as empty and gives no ids and an empty decoded text. Every row gives a row,
    repeated rows and null ids included. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        for batch in batches:
            for at, value in enumerate(batch.column(1)):
                packed, _ = bpe.encode(value.as_py() or "")
                ids = np.frombuffer(packed, "<u4").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 1), pa.array([ids], pa.list_(pa.int32())),
                     pa.array([bpe.decode(ids.tolist())], pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    return docs.select("doc_id", text).mapInArrow(run, f"{_type(docs)}, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the encoding's digests without its arrays.

    The same encoder as :func:`encode_documents`, with the same rules for nulls and repeated rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for value in batch.column(1):
                packed, decoded = bpe.encode(value.as_py() or "")
                counts.append(len(packed) // 4)
                of_ids.append(hashlib.sha256(packed).hexdigest())
                of_text.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", text).mapInArrow(
        run, f"{_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _type(docs: DataFrame) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"
