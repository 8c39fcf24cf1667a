"""Repeated word passages, located by Aho-Corasick automata.

1. Confirm. Anchors of all 20-word windows are counted, then the windows whose anchor recurs. Stretches of
   windows that recur are brought together with their first start and their number. Windows are judged by
   two 64-bit hashes, of the window and of its anchor phrase. The two filters are of bounded size: fuller,
   they let more through, which is dropped when stretches are counted.
2. Compile. Documents are dealt into buckets of bounded size. A bucket gets each recurring stretch that
   occurs in it once, however often it occurs, and compiles their opening phrases into automata of bounded
   size.
3. Locate. All documents of the bucket stream through its automata; where a phrase is found, the stretches
   that open with it are compared letter by letter. Words of windows that also start earlier are removed.

Only the last step moves texts, compressed; a passage in a third of all documents is one pattern per
bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.anchors import Recurring, constants, gram_hashes, mixed, recurring, runs
from cadastra.shared import stage

WINDOW = 20
GRAM = 6
# Words of a stretch that the automaton looks for; the rest is compared where they are found.
HEAD = 6
# Windows of a stretch at most.
LONGEST = 60
# Text bytes per bucket, and letters of patterns per automaton: what one task holds at a time.
BUCKET_BYTES = 2 << 20
AUTOMATON_LETTERS = 2 << 20
# Text bytes per step of a scan: arrays of eight times that stay in a processor's cache.
SCAN_BYTES = 64 << 10
_GRAM_SEED, _WINDOW_SEED = 0x5EED, 0xF00D
_PLACES = constants(LONGEST, 0xACE)


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text, id, print): documents are ordered by id, null first, then by the print of the text."""
    return docs.select(
        "doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("print"),
    )


_TABLE = constants(257, 0x7AB1E)
_LETTER = np.array([not (byte == 0x20 or 0x09 <= byte <= 0x0D) for byte in range(256)])
_WEIGHT = np.where(_LETTER, _TABLE[:256], np.uint64(0))
_powers = np.ones(1, np.uint64)


@dataclass
class _Scan:
    """Words of some texts in a row, and the windows of each text by their anchors.

    ``run`` numbers, for each window, the anchor occurrence it belongs to; a window that is ``whole`` lies in
    one text. ``text_of`` is the number of the text that a word is in, ``first_word`` of its first word.
    """

    hashes: np.ndarray
    anchors: np.ndarray
    run: np.ndarray
    whole: np.ndarray
    text_of: np.ndarray
    first_word: np.ndarray


def word_hashes(letters: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place of the first letter) of every word of texts that begin at ``begins``, one after another.

    A hash sums all letters by their places in the word; the spaces after a word count nothing.
    """
    global _powers
    inside = _LETTER[letters]
    fresh = np.empty(len(letters), bool)
    fresh[:1] = True
    np.logical_not(inside[:-1], out=fresh[1:])
    fresh[begins[begins < len(letters)]] = True
    starts = np.flatnonzero(inside & fresh)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    reach = np.diff(np.append(starts, len(letters)))
    if len(_powers) < reach.max():
        _powers = np.cumprod(np.full(2 * reach.max(), _TABLE[256], np.uint64))
    first = starts[0]
    place = np.arange(first, len(letters)) - np.repeat(starts, reach)
    sums = np.add.reduceat(_WEIGHT[letters[first:]] * _powers[place], starts - first)
    return mixed(sums), starts


def _scans(column: pa.Array, window: int) -> Iterator[_Scan]:
    """The texts of a column, ``SCAN_BYTES`` or a single longer text at a time."""
    texts = column.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    letters = np.frombuffer(data, np.uint8) if data and offsets[-1] else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + SCAN_BYTES, "right")) - 1)
        begins = offsets[low:high] - offsets[low]
        hashes, starts = word_hashes(letters[offsets[low]:offsets[high]], begins)
        if len(hashes) >= window:
            grams = gram_hashes(hashes, GRAM, _GRAM_SEED)
            first, end, place = runs(grams, window - GRAM + 1)
            text_of = np.searchsorted(begins, starts, "right") - 1
            yield _Scan(
                hashes, grams[place], np.repeat(np.arange(len(first)), end - first),
                text_of[window - 1:] == text_of[:len(text_of) - window + 1],
                text_of + low, np.searchsorted(starts, begins)[text_of],
            )
        low = high


def _counts(docs: DataFrame, window: int, of) -> DataFrame:
    """(anchor, n): how often each hash that ``of`` finds in a scan occurs, summed per batch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64), *map(of, _scans(batch.column(0), window))]
            hashes, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(hashes.view(np.int64)), "n": pa.array(n)})

    return docs.select("text").mapInArrow(count, "anchor long, n long")


def _anchor_counts(docs: DataFrame, window: int) -> DataFrame:
    return _counts(docs, window, lambda scan: scan.anchors[np.unique(scan.run[scan.whole])])


def _window_counts(docs: DataFrame, window: int, known: Recurring) -> DataFrame:
    """Counts of the windows whose anchor may recur."""

    def windows(scan: _Scan) -> np.ndarray:
        often = scan.whole & known.holds(scan.anchors)[scan.run]
        return gram_hashes(scan.hashes, window, _WINDOW_SEED)[often]

    return _counts(docs, window, windows)


def _stretches(
    docs: DataFrame, window: int, known: Recurring, known_windows: Recurring, wanted: Recurring | None = None
) -> DataFrame:
    """(id, print, anchor, start, stretch, size, several) of each run of windows with one anchor that may recur.

    ``size`` is in windows, ``stretch`` a hash of theirs, ``several`` says that the anchor's phrase occurs in
    it more than once, so that its windows may be equal. With ``wanted`` only stretches of these anchors, and
    the list of their windows in place of the last two.
    """
    last_names = ["size", "several"] if wanted is None else ["windows"]

    def found_in(scan: _Scan) -> tuple | None:
        often = scan.whole & known.holds(scan.anchors)[scan.run]
        if wanted is not None:
            often &= wanted.holds(scan.anchors)[scan.run]
        often = np.flatnonzero(often)
        if not len(often):
            return None
        whole = gram_hashes(scan.hashes, window, _WINDOW_SEED)[often]
        held = known_windows.holds(whole)
        often, whole = often[held], whole[held]
        if not len(often):
            return None
        # Runs that follow on one another with one anchor phrase, as in a text that repeats a word,
        # are one stretch, cut where its bits would not fit into a long.
        run = scan.run[often]
        anchor = scan.anchors[run]
        same = (np.diff(often) == 1) & (anchor[1:] == anchor[:-1])
        begins = np.concatenate([[0], np.flatnonzero(~same) + 1])
        inside = np.arange(len(often)) - np.repeat(begins, np.diff(np.append(begins, len(often))))
        starts = np.flatnonzero(inside % LONGEST == 0)
        count = np.diff(np.append(starts, len(often)))
        name = mixed(np.add.reduceat(whole * _PLACES[inside % LONGEST], starts) ^ count.astype(np.uint64))
        at = often[starts]
        return (scan.text_of[at], anchor[starts], at - scan.first_word[at], name, count,
                run[starts] != run[starts + count - 1], whole)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [part for part in map(found_in, _scans(batch.column(0), window)) if part]
            if not found:
                continue
            rows, anchor, start, name, count, several, whole = map(np.concatenate, zip(*found))
            if wanted is None:
                last = [pa.array(count.astype(np.int32)), pa.array(several)]
            else:
                offsets = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
                last = [pa.ListArray.from_arrays(offsets, pa.array(whole.view(np.int64)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(rows)), batch.column(2).take(pa.array(rows)),
                 pa.array(anchor.view(np.int64)), pa.array(start.astype(np.int32)), pa.array(name.view(np.int64)), *last],
                ["id", "print", "anchor", "start", "stretch", *last_names],
            )

    last_kinds = "size int, several boolean" if wanted is None else "windows array<long>"
    return docs.select("text", "id", "print").mapInArrow(
        cut, f"id long, print long, anchor long, start int, stretch long, {last_kinds}"
    )


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id", "print"), F.lit(buckets))


def _early(distinct: DataFrame, again) -> DataFrame:
    """(anchor, stretch, early) of stretches with windows that also start before the stretch's first place.

    Only where an anchor has different stretches, or occurs several times in one, may a window come again in
    another place than its stretch does; ``again`` lists the windows of those anchors' stretches.
    """
    open_anchors = stage(
        distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("several").alias("several"))
        .where("n > 1 OR several").select("anchor"), "open",
    )
    held = again(recurring(open_anchors.withColumn("n", F.lit(2)))).join(open_anchors, "anchor", "left_semi")
    place = F.struct("id", "print", "start")
    windows = held.groupBy("anchor", "stretch").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.first("windows").alias("windows")
    )
    listed = stage(windows.select(
        "anchor", "stretch", "n", F.col("first.id").alias("id"), F.col("first.print").alias("print"),
        F.col("first.start").alias("begin"), F.posexplode("windows").alias("at", "window"),
    ).withColumn("start", F.col("begin") + F.col("at")), "listed")
    often = listed.groupBy("anchor", "window").agg(
        F.min(place).alias("earliest"), F.sum("n").alias("n")
    ).where("n > 1").select("anchor", "window", "earliest")
    return listed.join(often, ["anchor", "window"]).where(F.col("earliest") < place).groupBy("anchor", "stretch").agg(
        F.sum(F.expr("shiftleft(1L, at)")).alias("early")
    )


def patterns(stretches: DataFrame, buckets: int, again) -> DataFrame:
    """Per bucket and distinct stretch in it: one place of it, its first place, and its early windows.

    ``early`` has a bit for each window of the first place that starts earlier still, in another stretch.
    """
    place = F.struct("id", "print", "start")
    distinct = stage(stretches.groupBy("anchor", "stretch").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("occurrences"), F.first("size").alias("size"),
        F.max("several").alias("several"),
    ), "distinct")
    known = distinct.join(_early(distinct, again), ["anchor", "stretch"], "left").withColumn(
        "early", F.coalesce("early", F.lit(0).cast("long"))
    ).where("occurrences > 1 OR early <> 0").select(
        "anchor", "stretch", "size", F.col("first.id").alias("first_id"), F.col("first.print").alias("first_print"),
        F.col("first.start").alias("first_start"), "early",
    )
    here = stretches.withColumn("bucket", _bucket(buckets)).groupBy("bucket", "anchor", "stretch").agg(
        F.min(place).alias("here"), F.count(F.lit(1)).alias("n")
    )
    useless = (F.col("n") == 1) & (F.col("early") == 0) & (F.col("here.id") == F.col("first_id")) & (
        F.col("here.print") == F.col("first_print")) & (F.col("here.start") == F.col("first_start"))
    return here.join(known, ["anchor", "stretch"]).where(~useless).select(
        "bucket", "here.id", "here.print", "here.start", "size",
        "first_id", "first_print", "first_start", "early",
    )


class _Words:
    """A text's words and the letters before each in its canonical form, one space around each word."""

    def __init__(self, packed: bytes, unpack):
        self.words = unpack.decompress(packed).split()
        self.shown = (b" " + b" ".join(self.words) + b" ").decode("latin-1") if self.words else " "
        self.before = np.concatenate([[0], np.cumsum([len(word) + 1 for word in self.words])])

    def part(self, start: int, count: int) -> str:
        return self.shown[self.before[start]:self.before[start + count] + 1]


class _Phrases:
    """An automaton of the stretches' opening words, and the whole stretches to confirm."""

    def __init__(self):
        self.automaton, self.heads, self.letters = ahocorasick.Automaton(), {}, 0

    def add(self, head: str, stretch: str, told: tuple) -> None:
        held = self.heads.get(head)
        if held is None:
            held = self.heads[head] = {}
            self.automaton.add_word(head, (len(head), held))
            self.letters += len(head)
        held.setdefault(len(stretch), {}).setdefault(stretch, []).append(told)

    def occurrences(self, shown: str) -> Iterator[tuple[int, tuple]]:
        """(first letter, what was told) of every occurrence of every stretch, compared letter by letter."""
        for end, (size, held) in self.automaton.iter(shown):
            start = end - size + 1
            for length, stretches in held.items():
                for told in stretches.get(shown[start:start + length], ()):
                    yield start, told


def _removed(texts: dict, rows: list[dict], window: int) -> dict:
    """Which words go, per document of a bucket: (id, print) -> flags of its words."""
    gone = {key: np.zeros(len(text.words) + 1, np.int64) for key, text in texts.items()}
    while rows:
        phrases = _Phrases()
        while rows and phrases.letters < AUTOMATON_LETTERS:
            row = rows.pop()
            text, start = texts[row["id"], row["print"]], row["start"]
            told = (row["first_id"], row["first_print"], row["first_start"], row["size"], row["early"])
            phrases.add(text.part(start, HEAD), text.part(start, row["size"] + window - 1), told)
        phrases.automaton.make_automaton()
        for key, text in texts.items():
            found = list(phrases.occurrences(text.shown))
            if not found:
                continue
            starts = np.searchsorted(text.before, [start for start, _ in found])
            change = gone[key]
            for start, (_, (first_id, first_print, first_start, size, early)) in zip(starts.tolist(), found):
                here, first = (*key, start), (first_id, first_print, first_start)
                if here > first:
                    change[start] += 1
                    change[start + size + window - 1] -= 1
                elif here == first:
                    for at in range(size):
                        if early >> at & 1:
                            change[start + at] += 1
                            change[start + at + window] -= 1
    return {key: np.cumsum(change[:-1]) > 0 for key, change in gone.items()}


def without_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, bucket_bytes: int = BUCKET_BYTES,
                    emit=None, schema: str | None = None) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (the words that stay, joined by a space).

    A word goes if a window of ``window`` consecutive words covers it whose words also start earlier:
    at a smaller doc_id, or earlier in the document. Null ids come first. Rows with one doc_id and
    different texts are ordered by a hash of the text; rows equal in both count as one document and are
    treated alike. A null text has no words. Other columns are not read.
    ``emit`` and ``schema`` replace the kept text by columns made from it. A window has at least ``GRAM`` words.
    """
    if window < max(GRAM, HEAD):
        raise ValueError(f"a window of {window} words is shorter than the {max(GRAM, HEAD)} of its anchor")
    emit = emit or (lambda kept: [kept.decode()])
    schema = schema or "kept string"
    source = keyed(docs, text)
    known = recurring(_anchor_counts(source, window))
    known_windows = recurring(_window_counts(source, window, known))
    stretches = stage(_stretches(source, window, known, known_windows), "stretches")

    def again(wanted: Recurring) -> DataFrame:
        return _stretches(source, window, known, known_windows, wanted)

    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress(value.as_py().encode()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary()), batch.column(2), batch.column(3)],
                ["doc_id", "packed", "id", "print"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    packed = source.mapInArrow(pack, f"doc_id {id_type}, packed binary, id long, print long").withColumn(
        "bucket", _bucket(buckets)
    )

    def locate(texts: pa.Table, passages: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor()
        ids, prints, held = (texts.column(name).to_pylist() for name in ("id", "print", "packed"))
        known_texts: dict = {}
        for key, data in zip(zip(ids, prints), held):
            if key not in known_texts:
                known_texts[key] = _Words(data, unpack)
        gone = _removed(known_texts, passages.to_pylist(), window)
        counts, removed, made = [], [], []
        for key in zip(ids, prints):
            words, flags = known_texts[key].words, gone[key]
            kept = [word for word, flag in zip(words, flags.tolist()) if not flag] if flags.any() else words
            counts.append(len(words))
            removed.append(len(words) - len(kept))
            made.append(emit(b" ".join(kept)))
        columns = [texts.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
        columns += [pa.array([row[at] for row in made]) for at in range(len(made[0]))] if made else []
        return pa.Table.from_arrays(columns, ["doc_id", "n_words", "n_removed", *names])

    names = [part.split()[0] for part in schema.split(",")]
    return packed.groupBy("bucket").cogroup(patterns(stretches, buckets, again).groupBy("bucket")).applyInArrow(
        lambda left, right: locate(left, right) if left.num_rows else _empty(id_type, schema),
        f"doc_id {id_type}, n_words long, n_removed long, {schema}",
    )


def _empty(id_type: str, schema: str) -> pa.Table:
    """No bucket has passages without documents; the type checker of an empty table asks for columns."""
    kinds = {"string": pa.string(), "bigint": pa.int64(), "long": pa.int64(), "int": pa.int32()}
    fields = [part.split() for part in f"doc_id {id_type}, n_words long, n_removed long, {schema}".split(",")]
    return pa.table({name: pa.array([], kinds.get(kind, pa.int64())) for name, kind in fields})


def digests(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): the digest of the words that stay, joined by a space."""
    return without_repeats(
        docs, text, window, emit=lambda kept: [hashlib.sha256(kept).hexdigest()], schema="kept_sha256 string"
    )
