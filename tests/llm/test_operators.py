"""Each operator against its brute-force version, on rows with every odd case, and on empty tables."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm import (
    bpe, components, decontamination, hamming, induced, quality, secrets, sharding, simhash, substring, suffix,
    token_counts, toxicity,
)
from cadastra.llm.queries import tokenizer_path
from cadastra.shared import scratch_path
from tests.llm import plain


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def same(found, expected):
    assert sorted(found, key=repr) == sorted(expected, key=repr)


# --- 1 decontamination -------------------------------------------------------------------------

def items_of(rows):
    by_id = dict(rows)
    long = by_id[10_005].split()
    edited = list(long[40:100])
    edited[30] = "else"
    return [
        (1, " ".join(long[10:40])), (2, " ".join(edited)), (3, "one"), (4, ""), (5, None), (None, " ".join(long[:30])),
        (6, " ".join(long[100:200])), (6, "a text that is nowhere to be found in any of them"), (7, "again and " * 20),
        (1, " ".join(long[10:40])), (8, " ".join(long[200:280][:40] + ["cut"] * 40)), (9, "only three words"),
        (10, " ".join(long[20:60]).upper()),
    ]


def test_leaks_are_those_of_all_windows(spark, edge_docs, rows_given):
    items = items_of(rows_given)
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("digest", F.lit("clash"))
    expected = {}
    for row in set(rows_given):
        found = plain.leaks([row], [item for item in items if item[0] is not None])
        for (doc_id, item_id), score in found.items():
            expected.setdefault((doc_id, item_id), set()).add(round(score, 9))
    found = {}
    for row in decontamination.contaminated(edge_docs, table).collect():
        found.setdefault((row["doc_id"], row["item_id"]), set()).add(round(row["similarity"], 9))
    assert found == expected
    assert {item for _, item in found} >= {1, 3, 6, 7, 10}
    clean = decontamination.without_leaks(edge_docs, table)
    assert clean.columns == edge_docs.columns
    leaky = {text for _, text in rows_given if text and plain.leaks([(0, text)], [i for i in items if i[0] is not None])}
    same([row["text"] for row in clean.collect()], [text for _, text in rows_given if text not in leaky])


def test_windows_at_any_fingerprint_distance_are_found(spark):
    rng, items, rows = random.Random(1), [], []
    for at in range(200):
        pair = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(2)]
        items.append((at, " ".join(pair * 6 + ["x"])))
        rows.append((at, " ".join(pair * 6 + ["y"])))
    found = decontamination.contaminated(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert sorted((r["doc_id"], r["item_id"], r["similarity"]) for r in found) == [(at, at, 0.8) for at in range(200)]
    assert plain.leaks(rows[:3], items[:3]) == {(at, at): 0.8 for at in range(3)}
    assert max(r["bits"] for r in found) > 20


@pytest.mark.parametrize("size", [12, 13, 20, 40, 120])
def test_the_radius_holds_similar_windows(size):
    """Fingerprints of random distinct shingles: windows at the least similarity against all windows."""
    rng = np.random.default_rng(size)
    kept = -(-8 * size * 2 // 18)
    missed, trials = 0, 2_000
    for _ in range(trials):
        hashes = rng.integers(0, 2**63, size + size - kept, np.uint64) * np.uint64(2) + rng.integers(0, 2, 1, np.uint64)
        bits = (hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        item, window = bits[:size], np.concatenate([bits[:kept], bits[size:]])
        apart = ((2 * item.sum(0) > size) != (2 * window.sum(0) > size)).sum()
        missed += apart > decontamination.RADIUS
    assert missed <= trials // 500


def test_windows_meet_items_through_the_blocks(spark, monkeypatch):
    """Whole windows of distinct shingles are found by the blocks alone."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(4_000)]
    items = [(i, " ".join(rng.sample(words, 40))) for i in range(40)]
    docs = []
    for i, text in items:
        copied = text.split()
        copied[rng.choice([0, 39])] = "changed"
        docs.append((i, " ".join([*rng.sample(words, 60), *copied, *rng.sample(words, 60)])))
    spans = decontamination.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {r["item_id"]: r["bits"] for r in spans.collect()}
    assert found.keys() == set(range(40)) and max(found.values()) <= decontamination.RADIUS
    nothing = decontamination.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
        radius=0)
    assert nothing.count() < 40


def test_no_documents_or_items_give_no_leaks(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(edge_docs, none).count() == 0
    assert decontamination.contaminated(no_docs, spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")).count() == 0
    assert decontamination.without_leaks(edge_docs, none).count() == edge_docs.count()


# --- 2 BPE -------------------------------------------------------------------------------------

def test_bpe_is_the_library_s(edge_docs, rows_given):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    expected, arrays = [], []
    for doc_id, text in rows_given:
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        expected.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()))
        arrays.append((doc_id, ids, shown))
    same(tuples(bpe.digest_documents(edge_docs, tokenizer_path())), expected)
    same([(r["doc_id"], r["ids"], r["decoded"]) for r in bpe.encode_documents(edge_docs, tokenizer_path()).collect()], arrays)


def test_bpe_merges_long_words_alike():
    encoder, rng = bpe.load(tokenizer_path()), random.Random(3)
    for size in (2, 9, 60, 255):
        parts = [encoder.inner[ord(rng.choice("aeinrst"))] for _ in range(size)]
        assert encoder._merge_long(list(parts)) == encoder.merge(list(parts))


def test_bpe_of_no_documents(no_docs):
    assert bpe.digest_documents(no_docs, tokenizer_path()).count() == 0


# --- 3 toxicity --------------------------------------------------------------------------------

def test_toxicity_learns_from_its_own_rows_only(spark):
    rng, made, labels = random.Random(5), [], []
    calm = [f"word{i}" for i in range(200)]
    for doc_id in range(600):
        toxic = doc_id % 5 == 0
        text = rng.choices(calm, k=40) + (rng.choices(["vile", "nasty", "rotten"], k=3) if toxic else [])
        rng.shuffle(text)
        made.append((doc_id, " ".join(text), "clash"))
        # Held-out labels are all wrong: nothing of them may be learned.
        held_out = zlib.crc32(str(doc_id).encode()) % 4 == 2
        labels.append((doc_id, int(toxic != held_out)))
    made += [(None, "vile nasty", "clash"), (9_000, None, "clash"), (9_001, "", "clash"), (9_000, None, "clash")]
    docs = spark.createDataFrame(made, "doc_id long, text string, score string")
    table = spark.createDataFrame([*labels, (None, 1), (3, None), (1, labels[1][1])], "doc_id long, toxic int")
    found = toxicity.score_documents(docs, table).collect()
    assert len(found) == len(made)
    for row in found:
        if row["doc_id"] is not None and row["doc_id"] < 600:
            assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
            assert row["predicted"] == int(row["doc_id"] % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.3)
    assert {row["predicted"] for row in found if row["doc_id"] in (9_000, 9_001)} == {0}
    assert [row["predicted"] for row in found if row["doc_id"] is None] == [1]


def test_toxicity_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    judged = toxicity.score_documents(docs, labels).where("held_out").join(labels, "doc_id").select("predicted", "toxic")
    counts = {(r["predicted"], r["toxic"]): r["count"] for r in judged.groupBy("predicted", "toxic").count().collect()}
    right = counts[1, 1]
    assert right / (right + counts.get((1, 0), 0)) > 0.9
    assert right / (right + counts.get((0, 1), 0)) > 0.8


def test_training_texts_with_a_passage_in_common_stay_apart(spark):
    rng = random.Random(6)
    def words(n):
        return ["".join(rng.choices("abcdefghij", k=7)) for _ in range(n)]
    passage = words(100)
    made = [passage + words(100) for _ in range(40)]
    original = words(200)
    near = [original[:at] + ["changed"] + original[at + 1:] for at in range(0, 40, 4)]
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    texts = [" ".join(t) for t in made + near + [original] * 5] + ["two words", "two words", "", None]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, at % 2) for at, i in enumerate(ids[:40])]
                                   + [(i, 1) for i in ids[40:52]] + [(i, 0) for i in ids[52:len(texts)]],
                                   "doc_id long, toxic int")
    kept = [(r["text"], r["toxic"]) for r in toxicity.training_texts(docs, labels).collect()]
    assert sorted(t for t in kept if t[0] in texts[:40]) == sorted((t, at % 2) for at, t in enumerate(texts[:40]))
    rest = [t for t in kept if t[0] not in texts[:40]]
    assert len(rest) == 3 and [label for text, label in rest if text and len(text) > 100] == [1]


def test_toxicity_without_indicators_drops_nothing(spark):
    docs = spark.createDataFrame([(i, f"word{i} alone") for i in range(60)] + [(60, ""), (61, None)], "doc_id long, text string")
    for toxic in (lambda i: 1, lambda i: i % 2):
        labels = spark.createDataFrame([(i, toxic(i)) for i in range(60)], "doc_id long, toxic int")
        assert {row["predicted"] for row in toxicity.score_documents(docs, labels).collect()} == {0}


def test_toxicity_without_labels(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {row["predicted"] for row in toxicity.score_documents(edge_docs, none).collect()} == {0}
    assert toxicity.score_documents(no_docs, none).count() == 0


def test_label_model_finds_accuracies_and_discounts_copies():
    rng = np.random.default_rng(1)
    truth = rng.random(4_000) < 0.3
    def voter(right):
        return np.where(rng.random(4_000) < right, truth, ~truth) * 2 - 1
    sound, weak, annotator = voter(0.9), voter(0.6), voter(0.95)
    cast = np.stack([sound, weak, weak, weak, annotator], 1).astype(np.int8)
    model = toxicity.fit_label_model(cast)
    assert model.chances[0, 1, 2] > 0.8 and model.chances[1, 1, 2] < 0.75
    assert model.discount[1] < 0.5 < model.discount[0]
    assert ((model.posterior(cast) > 0.5) == truth).mean() > 0.94


# --- 4 and 10 repeated passages ----------------------------------------------------------------

@pytest.mark.parametrize("bucket_bytes", [4 << 20, 20_000])
def test_repeated_passages_are_those_of_all_windows(edge_docs, rows_given, monkeypatch, bucket_bytes):
    monkeypatch.setattr(substring, "AUTOMATON_LETTERS", 5_000)
    found = substring.without_repeats(
        edge_docs, bucket_bytes=bucket_bytes, emit=lambda kept: [hashlib.sha256(kept).hexdigest()], schema="kept string")
    same(tuples(found), plain.substring(rows_given))


def test_repeated_bytes_are_those_of_all_strings(edge_docs, rows_given):
    same(tuples(suffix.digests(edge_docs)), plain.suffix(rows_given))


@pytest.mark.parametrize("crowd", [1, 2, 2_000])
def test_repeated_bytes_over_many_small_shards(edge_docs, rows_given, crowd):
    found = suffix.without_repeats(
        edge_docs, bucket_bytes=30_000, shard_bytes=3_000, crowd=crowd,
        emit=lambda kept: hashlib.sha256(kept).hexdigest(), kept="kept string")
    same(tuples(found), plain.suffix(rows_given))


def test_other_windows_and_lengths(edge_docs, rows_given):
    found = substring.without_repeats(
        edge_docs, window=8, emit=lambda kept: [hashlib.sha256(kept).hexdigest()], schema="kept string")
    same(tuples(found), plain.substring(rows_given, 8))
    same(tuples(suffix.digests(edge_docs, length=150)), plain.suffix(rows_given, 150))
    with pytest.raises(ValueError, match="shorter"):
        substring.digests(edge_docs, window=3)
    with pytest.raises(ValueError, match="out of range"):
        suffix.digests(edge_docs, length=100)


def test_no_documents_have_no_repeats(no_docs):
    assert substring.digests(no_docs).count() == 0
    assert suffix.digests(no_docs).count() == 0


def test_induced_sorting_on_disk(monkeypatch):
    monkeypatch.setattr(induced, "IN_MEMORY", 8)
    monkeypatch.setattr(induced, "_STRETCH", 16)
    rng = random.Random(5)
    for _ in range(250):
        size, kinds, cap = rng.choice([1, 2, 3, 8, 40, 200]), rng.choice([1, 2, 4, 30]), rng.choice([3, 400])
        text = [rng.randrange(kinds) for _ in range(size)]
        if rng.random() < 0.4 and size > 10:
            text = (text[:size // 3] * 4)[:size]
        order, shared = induced.suffixes(np.array(text, np.uint8), 256, cap)
        expected = sorted(range(size), key=lambda i: text[i:])
        assert list(order) == expected
        for at in range(1, size):
            a, b = text[expected[at - 1]:], text[expected[at]:]
            common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[at] == min(cap, common)


# --- 5 secrets ---------------------------------------------------------------------------------

def test_base_spans_are_those_of_the_patterns(edge_docs, rows_given):
    expected = []
    for doc_id, text in rows_given:
        spans = plain.secrets(text)
        listed = ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)
        counts = [sum(kind == k for kind, _, _ in spans) for k in ("assign", "access", "hex")]
        expected.append((doc_id, *counts, hashlib.sha256(listed.encode()).hexdigest()))
    found = secrets.digests(secrets.scan_secrets(edge_docs))
    same(tuples(found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")), expected)
    random_ones = {r["doc_id"]: r["spans"] for r in found.where("n_random > 0").collect()}
    assert list(random_ones) == [10_015] and random_ones[10_015] == "random:5:45"


def test_battery_tells_random_from_prose():
    rng = random.Random(2)
    for name, letters in secrets.ALPHABETS.items():
        if name == "decimal":
            continue
        tokens = ["".join(rng.choices(letters, k=64)) for _ in range(300)]
        passed = sum(secrets.battery(t, name) > 0.01 for t in tokens) / 300
        assert passed > 0.95, name
    words = ["thereforeunderstanding", "internationalisation", "z" * 40, "xyxy" * 10, "path/to/some/file/name/here",
             "snake_case_function_name_here", "2023-11-04T12-33-44-aaaa"]
    assert not any(secrets.secret_spans(w, {}) for w in words)


def test_levels_of_the_class_decide_on_a_token(spark):
    rng = random.Random(7)
    keys = ["".join(rng.choices(secrets.ALPHABETS["base64"], k=40)) for _ in range(2000)]
    doubtful = [k for k in keys if 0.001 < secrets.battery(k, "base64") < 0.005]
    assert len(doubtful) > 2

    def reported(tokens):
        docs = spark.createDataFrame(list(enumerate(tokens)), "doc_id long, text string")
        return {tokens[r["doc_id"]] for r in secrets.scan_secrets(docs).collect() if r["spans"]}

    among_keys = reported(keys)
    assert len(among_keys) >= 1998 and set(doubtful) <= among_keys
    among_words = reported(doubtful + ["thisIsAnOrdinaryNameOfSomeFunctionInCode"] * 5000)
    assert not among_words


def test_keys_behind_names_and_paths_are_found():
    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzEXAMPL3K9"
    dashed = "q7Xz0-Lm4Tn_9bRw2Yc8Kd5Vh1Gs6Jf3Pa-Ue7Bo"
    plain_key = "q7Xz0Lm4Tn9bRw2Yc8Kd5Vh1Gs6Jf3PaUe7BoNi5"
    both = "q7X/z0Lm-4Tn+9bR_w2Yc/8Kd5-Vh1G+s6Jf_3PaU/e7Bo"
    for before, secret in (("AWS_ACCESS_KEY=", key), ("STRIPE_KEY=", "sk_live_" + plain_key), ("/v1?sig=", plain_key),
                           ("SIG=", key + "=="), ("ID=", dashed), ("ID=", both), ("a-long_name=of/this=", plain_key)):
        text = f"so {before}{secret} it is"
        start = 3 + len(before)
        assert secrets.secret_spans(text, {}) == [(start, start + len(secret), "random")], text
    for before, secret in (("path-parts/with-a/", plain_key), ("path-parts/with-a/", dashed), ("a/path/to-", key)):
        (start, end, kind), = secrets.secret_spans(f"so {before}{secret} it is", {})
        assert 3 <= start <= 3 + len(before) and end == 3 + len(before) + len(secret) and kind == "random"
    for words in ("SOME_SETTING=another_ordinary_name_here", "path-parts/with-a/name_of_some_other-thing/in-it",
                  "=" * 40, "a-b/" * 10, "-" * 20 + "=" * 5 + "-" * 20):
        assert not secrets.secret_spans(words, {}), words


def test_short_keys_with_digits_are_found():
    rng = random.Random(4)
    for name in ("base36", "base32"):
        for size in (20, 26, 32):
            keys = ["".join(rng.choices(secrets.ALPHABETS[name], k=size)) for _ in range(300)]
            keys = [key for key in keys if secrets.encoding_of(key) == name and not key.isalpha()]
            assert sum(secrets.secret_spans(f"a {key} b", {}) == [(2, 2 + size, "random")] for key in keys) > 0.95 * len(keys)
    for word in ("version2releasenotes2023", "img20231104customer01", "INTERNATIONALISATION", "THEREFOREUNDERSTANDING"):
        assert not secrets.secret_spans(word, {}), word


def test_masked_texts(edge_docs, rows_given, no_docs):
    masked = secrets.mask_secrets(edge_docs)
    assert masked.schema == edge_docs.schema
    by_id = {r["doc_id"]: r for r in masked.where("doc_id >= 10014").collect()}
    text = by_id[10_014]["text"]
    assert text == "[secret]\" key [secret] [secret] TOKEN: short" and by_id[10_014]["n_chars"] == len(text)
    assert "q7Xz0" not in by_id[10_015]["text"]
    untouched = [t for i, t in rows_given if not plain.secrets(t) and i != 10_015]
    kept = [r["text"] for r in masked.collect()]
    assert len(kept) == len(rows_given) and not set(untouched) - set(kept)
    assert secrets.mask_secrets(no_docs).count() == 0 and secrets.scan_secrets(no_docs).count() == 0


# --- 6 near-duplicates -------------------------------------------------------------------------

def test_near_duplicates_are_those_of_all_pairs(edge_docs, rows_given):
    same(tuples(simhash.near_duplicates(edge_docs)), plain.near_duplicates(rows_given))


@pytest.mark.parametrize("segments, block", [(2, 512), (3, 4), (3, 512), (4, 4), (4, 64)])
def test_links_connect_what_all_pairs_connect(spark, segments, block):
    rng = random.Random(11)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for centre in list(prints)[:4]:
        for _ in range(60):
            prints.add(centre ^ sum(1 << bit for bit in rng.sample(range(64), rng.randrange(1, 6))))
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    table = spark.createDataFrame([(p,) for p in signed.values()], "fp long")
    roots = {r["node"]: r["root"] for r in components.components(simhash.links(table, 4, segments, block)).collect()}
    expected = plain.groups(prints)
    found = plain.by_key((roots.get(signed[p], signed[p]), p) for p in prints)
    assert sorted(map(sorted, found.values())) == sorted(
        map(sorted, plain.by_key((root, p) for p, root in expected.items()).values()))


@pytest.mark.parametrize("segments, block, parts", [(2, 8, 1), (3, 8, 1), (3, 4, 3), (4, 8, 1)])
def test_crowded_values_are_searched_by_their_other_bits(spark, segments, block, parts):
    """One value of a segment held by many, close in their other bits too: several levels down."""
    rng = random.Random(segments)
    shared, centre = rng.getrandbits(64), rng.getrandbits(64)
    low = (1 << 22) - 1
    prints = {shared & low | rng.getrandbits(42) << 22 for _ in range(150)}
    prints |= {centre ^ sum(1 << bit for bit in rng.sample(range(44, 64), rng.randrange(1, 9))) for _ in range(150)}
    for base in list(prints)[:40]:
        prints.add(base ^ sum(1 << bit for bit in rng.sample(range(64), rng.randrange(1, 6))))
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    table = spark.createDataFrame([(p,) for p in signed.values()], "fp long")
    linked = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(table, 4, segments, block, parts).collect()]
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in linked:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    found, expected = plain.by_key((root(p), p) for p in prints), plain.groups(prints)
    assert sorted(map(sorted, found.values())) == sorted(
        map(sorted, plain.by_key((home, p) for p, home in expected.items()).values()))


def test_tables_of_every_fingerprint_are_never_broadcast(spark, edge_docs, monkeypatch):
    """Spark sizes probes by the file they are exploded from, and broadcast millions of them."""
    plans = {}

    def told(df, name="staged", stage=simhash.stage):
        plans.setdefault(name, []).append(df._jdf.queryExecution().sparkPlan().toString())
        return stage(df, name)

    monkeypatch.setattr(simhash, "stage", told)
    monkeypatch.setattr(components, "stage", told)
    told(simhash.near_duplicates(edge_docs), "near duplicates")
    told(simhash.one_of_each(edge_docs), "one of each")
    rng = random.Random(1)
    prints = simhash.stage(spark.createDataFrame([(rng.getrandbits(40) << 22,) for _ in range(100)], "fp long"), "prints")
    told(simhash.links(prints, 4, 3, 8, 50).distinct(), "crowded links")
    assert {"links", "edges", "members", "crowded", "hot", "representatives"} <= set(plans)
    # One row per kept document, or crowded value, and no more: Spark may judge those by their files.
    judged = {"one of each", "crowded links"}
    assert not [name for name, made in plans.items() if name not in judged and any("Broadcast" in plan for plan in made)]
    met = [line for line in plans["crowded links"][0].splitlines() if "Broadcast" in line]
    assert met and all("BuildRight" in line for line in met)
    monkeypatch.setattr(simhash, "SENT", 0)
    told(simhash.links(prints, 4, 3, 8, 50).distinct(), "many crowded values")
    assert "Broadcast" not in plans["many crowded values"][0]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (5, 4), (200, 201), (201, 200)]
    found = dict(tuples(components.components(spark.createDataFrame(edges, "a long, b long"))))
    expected = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)} | {200: 200, 201: 200}
    assert found == expected
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_search_plan_keeps_every_print_within_the_radius():
    rng = random.Random(4)
    for radius, segments in ((4, 2), (4, 3), (4, 4), (20, 8), (2, 5)):
        plan = hamming.search_plan(radius, segments)
        for _ in range(300):
            difference = sum(1 << bit for bit in rng.sample(range(64), radius))
            assert any((difference >> s & (1 << w) - 1).bit_count() <= bits for s, w, bits in plan)


def test_one_of_each_component_stays(edge_docs, rows_given, no_docs):
    found = [(r["doc_id"], r["text"]) for r in simhash.one_of_each(edge_docs).collect()]
    prints = {row: plain.fingerprint(row[1]) for row in rows_given}
    root = plain.groups(set(prints.values()))
    assert sorted(root[prints[row]] for row in found) == sorted(set(root.values()))
    least = plain.by_key((root[prints[row]], row[0]) for row in rows_given if row[0] is not None)
    for row in found:
        ids = least.get(root[prints[row]])
        assert row[0] == (min(ids) if ids else None)
    assert simhash.one_of_each(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0


# --- 7 token counts ----------------------------------------------------------------------------

def test_rollup_adds_signed_changes_once(spark):
    schema = "source string, lang string, tokenizer string, old_tokens long, new_tokens long"
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))
    assert rollup.totals().count() == 0
    first = spark.createDataFrame(
        [("a", "en", "v1", None, 5), ("a", "en", "v1", None, 7), (None, "de", "v1", None, 3), ("b", None, "v1", None, 2)], schema)
    second = spark.createDataFrame(
        [("a", "en", "v1", 5, None), ("a", "en", "v1", 7, 9), ("b", None, "v1", 2, None), ("a", "en", "v2", None, 4)], schema)
    assert rollup.commit("one", first) and not rollup.commit("one", first)
    assert rollup.commit("two", second) and not rollup.commit("two", second)
    assert rollup.commit("nothing", spark.createDataFrame([], schema))
    again = token_counts.TokenRollup(spark, rollup.folder)
    assert not again.commit("one", first)
    same(tuples(again.totals()), [("a", "en", "v1", 1, 9), (None, "de", "v1", 1, 3), ("a", "en", "v2", 1, 4)])
    with pytest.raises(ValueError, match="batch id"):
        rollup.commit("../x", first)


def test_a_batch_that_lost_the_race_adds_nothing(spark, monkeypatch):
    schema = "source string, lang string, tokenizer string, old_tokens long, new_tokens long"
    batch = spark.createDataFrame([("a", "en", "v1", None, 5)], schema)
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))
    rollup.commit("one", batch)
    monkeypatch.setattr(token_counts.TokenRollup, "committed", lambda self, batch_id: False)
    assert not rollup.commit("one", batch)
    assert tuples(rollup.totals()) == [("a", "en", "v1", 1, 5)]


def test_rolled_up_totals_survive_a_kill_at_each_step(spark, monkeypatch):
    schema = "source string, lang string, tokenizer string, old_tokens long, new_tokens long"
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))
    assert not rollup.compact()
    batch = {n: spark.createDataFrame([("a", None, "v1", None, n), (f"s{n}", "en", "v1", None, 1)], schema) for n in range(1, 5)}
    gone = spark.createDataFrame([("s1", "en", "v1", 1, None)], schema)

    def check(*numbers, less=()):
        expected = [("a", None, "v1", len(numbers), sum(numbers))]
        same(tuples(rollup.totals()), expected + [(f"s{n}", "en", "v1", 1, 1) for n in numbers if n not in less])

    def killed(*_):
        raise KeyboardInterrupt

    rollup.commit("b1", batch[1])
    rollup.commit("b2", batch[2])
    for step in ("_publish", "_clean"):
        with monkeypatch.context() as patch:
            patch.setattr(token_counts.TokenRollup, step, killed)
            with pytest.raises(KeyboardInterrupt):
                rollup.compact()
        check(1, 2)
    assert len(rollup.snapshots()) == 1 and not rollup.compact()
    rollup.commit("gone", gone)
    reader = rollup.totals()
    assert rollup.compact()
    same(tuples(reader), tuples(rollup.totals()))
    rollup.commit("b3", batch[3])
    assert rollup.compact() and len(rollup.snapshots()) == 2
    check(1, 2, 3, less=(1,))
    assert not any(rollup.commit(f"b{n}", batch[n]) for n in (1, 2, 3))
    rollup.commit("b4", batch[4])
    check(1, 2, 3, 4, less=(1,))
    # Batches of the snapshot before the newest are spent, later ones are whole.
    left = {n: token_counts._names(spark, f"{rollup.folder}/batches/batch=b{n}") for n in (1, 3)}
    assert left[1] == ["_SUCCESS"] and len(left[3]) > 1
    assert len(token_counts._names(spark, f"{rollup.folder}/rolled")) == 2


def test_token_versions(edge_docs, rows_given):
    counted = edge_docs.select("doc_id", token_counts.word_tokens().alias("n"))
    same(tuples(counted), [(doc_id, len(plain.words(text))) for doc_id, text in rows_given])


# --- 8 sharding --------------------------------------------------------------------------------

@pytest.mark.parametrize("shards, summary", [(40, 1 << 15), (7, 16), (3, 64), (500, 32)])
def test_shards_are_minimax_atomic_and_gapless(edge_docs, rows_given, monkeypatch, shards, summary):
    monkeypatch.setattr(sharding, "SUMMARY", summary)
    found = sharding.shard_documents(edge_docs, shards).collect()
    assert len(found) == len(rows_given)
    checks = plain.by_key((r["doc_id"], (r["size"], r["text_crc32"])) for r in found)
    for doc_id, text in rows_given:
        data = (text or "").encode()
        assert (len(data) + 16, zlib.crc32(data)) in checks[doc_id]
    slots = plain.by_key((r["shard"], r["slot"]) for r in found)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < shards
    # Equal texts: size and checksum stand for them here, and nulls are apart from the empty text.
    homes = plain.by_key(((r["size"], r["text_crc32"]), r["shard"]) for r in found if r["size"] > 16)
    assert all(len(set(h)) == 1 for h in homes.values())
    sizes = {}
    for _, text in rows_given:
        sizes[text] = sizes.get(text, 0) + len((text or "").encode()) + 16
    order = sorted(sizes, key=lambda t: (t is not None, hashlib.sha256((t or "").encode()).digest()))
    capacity = plain.smallest_capacity([sizes[t] for t in order], shards)
    filled = plain.by_key((r["shard"], r["size"]) for r in found)
    assert max(map(sum, filled.values())) <= capacity
    assert {r["law"] for r in found} == {"bytes"} and {r["grown_shard"] for r in found} == {None}


def test_no_documents_need_no_shards(no_docs):
    assert sharding.shard_documents(no_docs).count() == 0


# --- 9 quality ---------------------------------------------------------------------------------

def test_measures_and_verdicts(edge_docs, rows_given):
    found = quality.apply_rules(edge_docs)
    expected = []
    for doc_id, text in rows_given:
        n, chars, symbols, lines, repeats = plain.measures(text)
        expected.append((doc_id, n, chars, symbols, lines, repeats, n < 50 or 100 * repeats > 50 * n))
    same(tuples(found.select("doc_id", *quality.MEASURES, "base_failed")), expected)
    assert found.where("base_failed AND kept").count() == 0
    assert found.where("kept <> (rejected_by IS NULL)").count() == 0


def test_order_of_rules_changes_no_verdict(edge_docs):
    measured = quality.measured(edge_docs.select("doc_id", "text"))
    rules = [*quality.base_rules(), *quality.prose_rules()]
    kept = [
        tuples(measured.select("doc_id", quality.cascade(order).isNull())) for order in (rules, rules[::-1])
    ]
    assert kept[0] == kept[1]
    ordered = quality.ordered_by_yield(measured, rules)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in rules)


def test_rules_are_judged_and_skipped_by_their_raw_conditions(edge_docs):
    docs, yes, no = edge_docs.select("doc_id", "text"), F.lit(True), F.lit(False)
    rules = [quality.Rule("never", yes, no), quality.Rule("always", no, yes)]
    assert [r.name for r in quality.ordered_by_yield(docs, rules)] == ["always", "never"]
    fails = quality.Rule("fails", no, F.raise_error(F.lit("reached")).cast("boolean"))
    assert docs.where(quality.cascade([rules[1], fails], raw=True) != "always").count() == 0
    whole = quality.apply_rules(edge_docs).select("doc_id", "kept")
    same(tuples(quality.verdicts(edge_docs).select("doc_id", "kept")), tuples(whole))
    same(tuples(quality.verdicts(edge_docs, [quality.Rule("old", F.col("n_words") < 0)]).select("doc_id", "kept")),
         tuples(quality.apply_rules(edge_docs, []).select("doc_id", "kept")))
    measured = quality.measured(docs)
    for name in quality.MEASURES:
        assert measured.where(~F.col(name).eqNullSafe(quality.measure(name))).count() == 0


def test_rule_order_is_by_rejections_per_step_and_repeatable(spark):
    docs = spark.createDataFrame([(i, "word " * (10 if i % 2 else 60)) for i in range(40)], "doc_id long, text string")
    half = F.length("text") < 100
    rules = [
        quality.Rule("dear", half, half, ("words", "windows")), quality.Rule("idle", F.lit(False), F.lit(False), ()),
        quality.Rule("b", half, half, ("words",)), quality.Rule("a", half, half, ("words",)),
    ]
    for order in (rules, rules[::-1]):
        assert [rule.name for rule in quality.ordered_by_yield(docs, order)] == [
            "a", "b", "dear", "idle"]
    steps = {rule.name: rule.steps for rule in [*quality.base_rules(), *quality.prose_rules()]}
    assert steps["repeated_words"] == ("words", "windows") and steps["shouting"] == ("scan", "words", "word_chars")
    assert set().union(*steps.values()) == set(quality.STEPS)


def test_quality_of_no_documents(no_docs):
    assert quality.apply_rules(no_docs).count() == 0


def test_native_operators_run_no_python(spark, edge_docs):
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    for df in (quality.apply_rules(edge_docs), sharding.shard_documents(edge_docs), decontamination.contaminated(edge_docs, items)):
        shown = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in shown for word in ("Python", "Pandas", "Arrow"))
