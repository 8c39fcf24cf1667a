"""Byte-level BPE, alignment of two tokenizers, and spelling variants."""

import base64
import hashlib
import random
from array import array

import pytest
import regex
import tiktoken
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cadastra.llm import alignment, byte_bpe, spelling
from cadastra.llm.queries import tokenizer_path
from tests.llm import plain

RANKS = tokenizer_path("byte_bpe_multi_50k.tiktoken")
A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def odd_texts():
    rng = random.Random(3)
    letters = [*range(32, 127), *range(0xA0, 0x250), 0x1E9E, 0x2028, 0x3000, 0x65E5, 0x1F600, 0x1680]
    made = ["".join(chr(rng.choice(letters)) for _ in range(150)) for _ in range(40)]
    made += ["".join(rng.choice("ab'sn t\n\r\t  \x1c\x85 THE the0123") for _ in range(300)) for _ in range(40)]
    made += ["".join(chr(rng.choice([rng.randrange(0x250, 0xD800), rng.randrange(0xE000, 0x40000)])) for _ in range(60))
             for _ in range(40)]
    return [*made, " ", "  ", "a ", " a", "a  b ", "\n a\n", "x " * 3, "<s> </s> <unk> <0x41>", "<|endoftext|>",
            "mark ▁ of a space", "nul \x00 byte", "ﬁ é é"]


@pytest.fixture(scope="module")
def odd_docs(spark, rows_given):
    rows = [*rows_given, *enumerate(odd_texts(), 20_000)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return ranks, tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("block_chars", [1, 50_000, byte_bpe.BLOCK_CHARS])
def test_byte_bpe_is_the_library_s(odd_docs, block_chars):
    rows, docs = odd_docs
    _, encoding = library()
    ids = [(doc_id, encoding.encode_ordinary(text or "")) for doc_id, text in rows]
    encoded = byte_bpe.encode_documents(docs, RANKS, block_chars=block_chars)
    assert tuples(encoded) == sorted(ids, key=repr)
    decoded = {repr((r["doc_id"], bytes(r["decoded"]))) for r in byte_bpe.decode_documents(encoded, RANKS).collect()}
    assert decoded == {repr((doc_id, (text or "").encode())) for doc_id, text in rows}
    expected = [(doc_id, len(found), hashlib.sha256(",".join(map(str, found)).encode()).hexdigest(),
                 hashlib.sha256(encoding.decode_bytes(found)).hexdigest()) for doc_id, found in ids]
    assert tuples(byte_bpe.digest_documents(docs, RANKS, block_chars=block_chars)) == sorted(expected, key=repr)


def test_replay_keeps_the_order_of_ranks_in_each_word():
    # A pair made by a merge may have a lower rank than the merge: (ab)c before the second ab.
    bpe = byte_bpe.load(RANKS, byte_bpe.PATTERN)
    made = object.__new__(byte_bpe.ByteBpe)
    made.ranks = {bytes([b]): b for b in range(256)} | {b"ab": 900, b"abc": 300, b"ca": 400, b"bb": 950, b"aa": 960}
    made.bytes_of = {rank: token for token, rank in made.ranks.items()}
    made.known = byte_bpe.Remembered(50)
    made.first_pairs = bpe.first_pairs * 0 - 1
    for pair in (b"ab", b"ca", b"bb", b"aa"):
        made.first_pairs[pair[0] << 8 | pair[1]] = made.ranks[pair]
    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    words = [w for w in words if w.encode() not in made.ranks]
    assert [list(ids) for ids in made.solve(words)] == [
        plain.byte_bpe(w, made.ranks, regex.compile(r"(?s).+")) for w in words]


def test_long_pieces_and_many_merges_are_replayed_alike():
    ranks, _ = library()
    bpe = byte_bpe.load(RANKS, byte_bpe.PATTERN)
    words = ["ab" * 400, "x" * 700, "the" * 100, "ÿ" * 50, ""]
    pattern = regex.compile(r"(?s).+")
    assert [list(ids) for ids in bpe.replay([w.encode() for w in words])] == [plain.byte_bpe(w, ranks, pattern) for w in words]


def vocabularies():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = {c: n for n, c in alignment.byte_letters().items()}
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in range(b.get_piece_size())]
    return a, a_bytes, b, b_bytes


@pytest.mark.parametrize("block_chars", [1, 30_000, alignment.BLOCK_CHARS])
def test_alignment_is_that_of_whole_texts(odd_docs, block_chars):
    rows, docs = odd_docs
    expected = plain.aligned(rows, *vocabularies())
    assert tuples(alignment.digests(docs, A, B, block_chars=block_chars)) == sorted(expected, key=repr)


def test_spans_lie_where_the_tokens_do(spark):
    texts = ["héllo 日本 😀x", "two  words\n", None, "", "mark ▁"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    a, a_bytes, b, b_bytes = vocabularies()
    for row in alignment.align_documents(docs, A, B).collect():
        text = texts[row["doc_id"]]
        data = (" " + text).encode() if text and "▁" not in text else b""
        for ids, ends, bytes_of in ((row["a_ids"], row["a_ends"], a_bytes), (row["b_ids"], row["b_ends"], b_bytes)):
            assert [data[s:e] for s, e in zip([0, *ends], ends)] == [bytes_of[i] for i in ids]
        assert row["cuts"] == sorted(set(row["a_ends"]) & set(row["b_ends"]))


def test_pair_counts_add_up_to_the_links(odd_docs):
    _, docs = odd_docs
    links = alignment.digests(docs, A, B).groupBy().sum("n_links").first()[0]
    assert alignment.pair_counts(docs, A, B).groupBy().sum("n").first()[0] == links


def test_variants_are_those_of_all_pairs(edge_docs, rows_given, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    assert tuples(spelling.group_variants(edge_docs)) == sorted(plain.spelling(rows_given), key=repr)


@pytest.mark.parametrize("levels", [0, 1, 2, 4])
def test_one_edit_at_any_place_is_found(spark, levels):
    rng = random.Random(9)
    words = set()
    for size in (7, 8, 9, 12, 17, 33, 40, 100):
        for _ in range(3):
            word = "".join(rng.choice("abcé") for _ in range(size))
            words.add(word)
            for at in range(size + 1):
                words |= {word[:at] + "x" + word[at:], word[:at] + "é" + word[at + 1:], word[:at] + word[at + 1:]}
    listed = sorted(words)
    expected = {(a, b) for a in listed for b in listed if a < b and abs(len(a) - len(b)) < 2 and plain.one_edit(a, b)}
    table = spark.createDataFrame([(w, 2) for w in listed], "word string, n long")
    found = [tuple(sorted(r)) for r in spelling.near_words(table, levels).select("left", "right").collect()]
    assert len(found) == len(set(found)) and set(found) == expected


def test_roots_follow_forms_to_the_last(spark):
    words = [("abcdefgh", 10_000), ("abcdefg", 1_000), ("abcdefgx", 100), ("abcdefgxy", 10), ("zzzzzzz", 1_000), ("zzzzzzy", 100),
             ("zzzzzzx", 1_000)]
    table = spark.createDataFrame(words, "word string, n long")
    found = {r["word"]: (r["form"], r["root"], r["n_near"]) for r in spelling.variants(table).collect()}
    assert found["abcdefgxy"] == ("abcdefgx", "abcdefgh", 1)
    assert found["abcdefgh"] == (None, "abcdefgh", 2)
    assert found["zzzzzzy"] == ("zzzzzzx", "zzzzzzx", 2)


def test_no_documents(no_docs):
    assert byte_bpe.digest_documents(no_docs, RANKS).count() == 0
    assert alignment.digests(no_docs, A, B).count() == 0
    assert alignment.pair_counts(no_docs, A, B).count() == 0
    assert spelling.group_variants(no_docs).count() == 0


def test_clashing_columns_and_nulls(edge_docs, rows_given):
    count = len(rows_given)
    assert byte_bpe.encode_documents(edge_docs, RANKS).count() == count
    assert alignment.digests(edge_docs, A, B).count() == count
    assert array("i") == byte_bpe.load(RANKS, byte_bpe.PATTERN).solve([""])[0]
