"""Alignment of two tokenizers over the same texts: token spans, groups, links and counts of linked ids.

A is a byte-level vocabulary of the tokenizers library, B a sentencepiece model. Spans come from the
libraries: character offsets of A, spans of the message that sentencepiece returns for B. They are the
coarse cuts; within a character that several tokens share, and over byte-fallback tokens, the cuts come
from the decoded bytes of the tokens.

Neither tokenizer joins a character that is no white space to a space behind it (A by its splitting
pattern, B as no piece of the model holds such a pair, which is checked). So a text is cut there into
chunks that both tokenize alone; a chunk is aligned once per block of documents, whatever its count. With a
model that joins such characters, a chunk is a whole text.

Counts of pairs are additive: each block sends its distinct pairs with their number of links, partial
sums are taken before the shuffle, and each block gets the corpus-wide counts of its own pairs back.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.bpe import byte_letters
from cadastra.llm.byte_bpe import Numbered, Remembered
from cadastra.shared import stage

# Characters of text whose chunks are aligned and counted together.
BLOCK_CHARS = 8 << 20
# Chunks remembered per worker from one block to the next: at most twice as many.
REMEMBERED = 200_000
LONG_CHUNK = 256
# Chunks handed to the libraries as one text.
_JOINED = 200
# All up to the next space that follows no white space and ends no text; for texts with other spaces.
_CHUNKS = re.compile(r" ((?:[^ ]+|(?<=\s) | \Z)*)")
_ODD_SPACE = re.compile(r"\s |\A | \Z").search
_SPACE = "▁"
_PAIR = 32
_LOW = (1 << _PAIR) - 1


class Chunk(NamedTuple):
    """What one chunk adds to its texts: its groups as text, its links, and how many there are of each."""

    shown: str
    links: bytes
    n_a: int
    n_b: int
    n_groups: int
    sound: bool


UNSOUND = Chunk("", b"", 0, 0, 0, False)


class Spans(NamedTuple):
    """Ids and end bytes of the tokens of both sides of a space and a text."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray


def _refined(cuts: np.ndarray, sizes: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """The libraries' cuts, but inside a character those of the decoded bytes since the last cut."""
    if not inside.any():
        return cuts
    decoded = np.cumsum(sizes)
    at = np.where(inside, 0, np.arange(1, len(cuts) + 1))
    last = np.maximum.accumulate(at)
    base = np.concatenate([[0], cuts])[last] - np.concatenate([[0], decoded])[last]
    return np.where(inside, base + decoded, cuts)


class Aligner:
    """Both tokenizers, and the chunks they have aligned."""

    def __init__(self, a_path: str, b_path: str):
        # A task has one core; the library's own threads would take those of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        # Markers in a text are ordinary text.
        self.a.encode_special_tokens = True
        letters = {letter: byte for byte, letter in byte_letters().items()}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes(letters[letter] for letter in token)
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        fallback = [self.b.is_byte(i) for i in range(len(pieces))]
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if byte else piece.replace(_SPACE, " ").encode()
            for piece, byte in zip(pieces, fallback)
        ]
        self.fallback = np.array(fallback)
        self.a_sizes, self.b_sizes = (np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes))
        self.a_shown, self.b_shown = (
            {end: np.array([f"{i}{end}" for i in range(len(t))], object) for end in ends}
            for t, ends in ((self.a_bytes, ",|"), (self.b_bytes, (",", ";", "")))
        )
        self.joins = any(re.search(f"[^{_SPACE}]{_SPACE}", piece) for piece in pieces)
        self.known: Remembered[Chunk] = Remembered(REMEMBERED)

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text, each without its first space; none for an empty text."""
        if not text:
            return []
        if self.joins:
            return [text]
        return _CHUNKS.findall(" " + text) if _ODD_SPACE(text) else text.split(" ")

    def spans(self, text: str) -> Spans | None:
        """Tokens of a text; none if those of either side do not give a space and the text back."""
        spaced = " " + text
        data = spaced.encode()
        found = self.a.encode(spaced, add_special_tokens=False)
        a, offsets = found.ids, np.array(found.offsets, np.int64).reshape(-1, 2)
        pieces = self.b.encode(text, return_type="proto").pieces
        b = [piece.id for piece in pieces]
        if not b"".join(map(self.a_bytes.__getitem__, a)) == b"".join(map(self.b_bytes.__getitem__, b)) == data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        # Offsets of A are characters: the byte where each ends, and tokens that share one with the next token.
        if len(data) == len(spaced):
            cuts = offsets[:, 1]
        else:
            starts = np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)
            cuts = np.append(starts, len(data))[offsets[:, 1]]
        shared = np.append(offsets[1:, 0] < offsets[:-1, 1], False)
        a_ends = _refined(cuts, self.a_sizes[a], shared)
        # Spans of B are bytes of the text without the space that B adds; a run of fallback bytes is cut inside.
        cuts = np.array([piece.end for piece in pieces], np.int64) + 1
        b_ends = _refined(cuts, self.b_sizes[b], self.fallback[b])
        sizes = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        return Spans(a, a_ends, b, b_ends) if all(map(np.array_equal, (a_ends, b_ends), sizes)) else None

    def _solve(self, chunks: list[str]) -> list[Chunk] | None:
        """Chunks that may stand side by side in one text, aligned; none if the text can't be."""
        spans = self.spans(" ".join(chunks))
        if spans is None:
            return None
        a, a_ends, b, b_ends = spans
        ends = np.cumsum([len(chunk.encode()) + 1 for chunk in chunks])
        cuts = np.union1d(a_ends, b_ends)
        of_a, of_b = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        links = (a[of_a] << _PAIR | b[of_b]).astype(np.int64)
        counts = [np.searchsorted(of, ends, "right") for of in (a_ends, b_ends, cuts, common)]
        n_a, n_b, _, n_groups = (np.diff(count, prepend=0).tolist() for count in counts)
        # The tokens of all groups in order, those of A before those of B, each with what stands behind it.
        group_a, group_b = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        shown = np.empty(len(a) + len(b), object)
        last_a, last_b = (np.isin(of, common, assume_unique=True) for of in (a_ends, b_ends))
        shown[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = np.where(
            last_a, self.a_shown["|"][a], self.a_shown[","][a])
        of_chunk = np.isin(b_ends, ends, assume_unique=True)
        shown[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = np.where(
            of_chunk, self.b_shown[""][b], np.where(last_b, self.b_shown[";"][b], self.b_shown[","][b]))
        shown = shown.tolist()
        found, token, link = [], 0, 0
        for i, j, upto, groups in zip(n_a, n_b, counts[2].tolist(), n_groups):
            found.append(Chunk("".join(shown[token:token + i + j]), links[link:upto].tobytes(), i, j, groups, True))
            token, link = token + i + j, upto
        return found

    def solve(self, chunks: Iterable[str]) -> list[Chunk]:
        """Each chunk aligned; many chunks go through the libraries side by side."""
        chunks = list(chunks)
        found = [self.known.get(chunk) for chunk in chunks]
        plain = not self.joins
        fresh = [at for at, known in enumerate(found) if known is None]
        # Only chunks that end in a character that is no white space can be followed by another.
        beside = [at for at in fresh if plain and chunks[at] and not chunks[at][-1].isspace() and len(chunks[at]) <= LONG_CHUNK]
        single = sorted(set(fresh).difference(beside))
        runs = [beside[at:at + _JOINED] for at in range(0, len(beside), _JOINED)] + [[at] for at in single]
        while runs:
            run = runs.pop()
            made = self._solve([chunks[at] for at in run])
            if made is None and len(run) > 1:
                runs += [[at] for at in run]
                continue
            for at, chunk in zip(run, made or [UNSOUND]):
                found[at] = chunk
                if len(chunks[at]) <= LONG_CHUNK:
                    self.known.put(chunks[at], chunk)
        return found


@lru_cache(maxsize=2)
def load(a_path: str, b_path: str) -> Aligner:
    """The tokenizers of two files, read once per worker."""
    return Aligner(a_path, b_path)


def _key_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def align_documents(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """(doc_id, a_ids, a_ends, b_ids, b_ends, cuts) of every whole text.

    Ends are bytes of a space and the text; ``cuts`` are those at which tokens of both sides end. A text that
    is null or empty, or that the tokens of either side do not give back, has no tokens: empty arrays. Every
    row gives a row, repeated rows and null ids included. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, kind = load(a_path, b_path), pa.list_(pa.int32())
        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1)):
                text_of = value.as_py()
                spans = aligner.spans(text_of) if text_of else None
                columns = [*spans, np.intersect1d(spans.a_ends, spans.b_ends)] if spans else [np.zeros(0)] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key.as_py()], key.type), *[pa.array([c.astype(np.int32)], kind) for c in columns]],
                    ["doc_id", "a_ids", "a_ends", "b_ids", "b_ends", "cuts"],
                )

    arrays = ", ".join(f"{name} array<int>" for name in ("a_ids", "a_ends", "b_ids", "b_ends", "cuts"))
    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {_key_type(docs)}, {arrays}")


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, np.int32).tobytes())


def _unpack(packed) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed.as_py()), np.int32)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each of the runs of the given sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _linked_blocks(docs: DataFrame, a_path: str, b_path: str, text: str, block_chars: int) -> DataFrame:
    """A row per block of documents: their own figures, the distinct pairs, and what refers to them.

    ``docs``: figures of each document. ``pairs``, ``n``: distinct linked pairs and their links in the block.
    ``sizes``: chunks per document. ``places``: their numbers. ``widths``: links per numbered chunk. ``refs``:
    place among the pairs of each link of each numbered chunk.
    """
    key_type = _key_type(docs)
    figures = (f"array<struct<doc_id: {key_type}, n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, "
               "groups_sha256: string>>")

    def block(keys: list, rows: list, number: dict, at: int) -> pa.RecordBatch:
        parts = load(a_path, b_path).solve(number)
        shown = [part.shown for part in parts]
        counts = np.array([(p.n_a, p.n_b, p.n_groups, len(p.links) // 8, p.sound) for p in parts], np.int64).reshape(-1, 5)
        sizes, docs_out = [], []
        for key, numbers in zip(keys, rows):
            taken = np.frombuffer(numbers, np.int32)
            of_doc = counts[taken]
            if not of_doc[:, 4].all():
                taken, of_doc, numbers = taken[:0], of_doc[:0], ()
            sizes.append(len(taken))
            n_a, n_b, n_groups, n_links, _ = of_doc.sum(axis=0).tolist()
            groups = ";".join(map(shown.__getitem__, numbers)).encode()
            docs_out.append({
                "doc_id": key.as_py(), "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
                "groups_sha256": hashlib.sha256(groups).hexdigest() if len(taken) else "",
            })
        sizes = np.array(sizes, np.int64)
        places = np.concatenate([np.frombuffer(r, np.int32) for r, size in zip(rows, sizes) if size] or [np.zeros(0, np.int32)])
        links = np.frombuffer(b"".join([part.links for part in parts]), np.int64)
        pairs, refs = np.unique(links, return_inverse=True)
        widths = counts[:, 3]
        often = np.repeat(np.bincount(places, minlength=len(parts)), widths)
        n = np.bincount(refs, weights=often, minlength=len(pairs)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int64()), pa.array([docs_out], _figures_type(keys[0].type)),
             pa.array([pairs], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64())),
             *[pa.array([_pack(v)], pa.binary()) for v in (sizes, places, widths, refs)]],
            ["block", "docs", "pairs", "n", "sizes", "places", "widths", "refs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load(a_path, b_path)
        # A repeated task numbers its blocks alike, and only one of its outputs is kept.
        at = TaskContext.get().partitionId() << 32
        number, keys, rows, size = Numbered(), [], [], 0
        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1)):
                text_of = value.as_py() or ""
                # The mark that stands for a space inside B can't be given back.
                parts = [] if _SPACE in text_of else aligner.chunks(text_of)
                rows.append(array("i", map(number.__getitem__, parts)))
                keys.append(key)
                size += len(text_of)
                if size >= block_chars:
                    yield block(keys, rows, number, at)
                    at, number, keys, rows, size = at + 1, Numbered(), [], [], 0
        if keys:
            yield block(keys, rows, number, at)

    return docs.select("doc_id", text).mapInArrow(
        run, f"block long, docs {figures}, pairs array<long>, n array<long>, sizes binary, places binary, "
             "widths binary, refs binary"
    )


def _figures_type(key: pa.DataType) -> pa.DataType:
    longs = [(name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")]
    return pa.list_(pa.struct([("doc_id", key), *longs, ("groups_sha256", pa.string())]))


def _counted(blocks: DataFrame) -> DataFrame:
    listed = blocks.select(F.inline(F.arrays_zip("pairs", "n")))
    return listed.where("n > 0").groupBy(F.col("pairs").alias("pair")).agg(F.sum("n").alias("n"))


def pair_counts(docs: DataFrame, a_path: str, b_path: str, text: str = "text",
                block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(a_id, b_id, n): in how many links of the corpus each pair of ids stands."""
    blocks = _linked_blocks(docs, a_path, b_path, text, block_chars)
    return _counted(blocks).select(
        F.shiftright("pair", _PAIR).cast("int").alias("a_id"), F.col("pair").bitwiseAND(_LOW).cast("int").alias("b_id"), "n"
    )


def digests(docs: DataFrame, a_path: str, b_path: str, text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every whole text.

    ``n_best``: links whose count over the corpus is the highest of their B id, ties included. ``count_sum``:
    the counts of all links. ``groups_sha256``: of the ids of A and B group by group. Texts without tokens, as in
    :func:`align_documents`, have zeros and an empty text. Every row gives a row, repeated rows and null ids included.
    """
    key_type = _key_type(docs)
    blocks = stage(_linked_blocks(docs, a_path, b_path, text, block_chars), "linked")
    counted = stage(_counted(blocks), "pairs")
    # A row per id of B, as many as its vocabulary.
    most = counted.groupBy(F.col("pair").bitwiseAND(_LOW).alias("b_id")).agg(F.max("n").alias("most"))
    marked = counted.join(most, F.col("pair").bitwiseAND(_LOW) == F.col("b_id")).select(
        "pair", F.col("n").alias("total"), (F.col("n") == F.col("most")).alias("best")
    )
    asked = blocks.select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(marked, "pair").select("of_block", "at", "total", "best")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in range(left.num_rows):
            sizes, places, widths, refs = (_unpack(left.column(c)[row]) for c in ("sizes", "places", "widths", "refs"))
            count = len(left.column("pairs")[row])
            total, best = np.zeros(count, np.int64), np.zeros(count, np.int64)
            at = right.column("at").to_numpy()
            total[at] = right.column("total").to_numpy()
            best[at] = right.column("best").to_numpy(zero_copy_only=False)
            figures = pa.Table.from_struct_array(left.column("docs")[row].values)
            for values, name in ((best, "n_best"), (total, "count_sum")):
                of_doc = _sums(_sums(values[refs], widths)[places], sizes)
                figures = figures.append_column(name, pa.array(of_doc, pa.int64()))
            out.append(figures)
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        return pa.concat_tables(out).select(names) if out else _nothing(left)

    def _nothing(left: pa.Table) -> pa.Table:
        doc = left.schema.field("docs").type.value_type.field("doc_id").type
        longs = [(name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
        return pa.schema([("doc_id", doc), *longs, ("groups_sha256", pa.string())]).empty_table()

    return blocks.drop("n").groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(
        finish, f"doc_id {key_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                "groups_sha256 string"
    )
