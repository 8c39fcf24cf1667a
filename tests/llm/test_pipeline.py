"""The pipeline's stages, each on what its predecessor kept, against plain versions."""

import hashlib
import struct

import corpus_pipeline
from cadastra.llm import toxicity
from cadastra.llm.queries import tokenizer_path
from cadastra.llm.secrets import dismissal_levels, mask, secret_spans
from tests.llm import plain

SF_DIR = "/root/testdata/sf0.001"


def test_stages_are_named_and_ordered():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "bpe"]


def test_run_is_what_plain_stages_give(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    score = toxicity.fit(docs, labels).scorer()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if score(r["text"]) < toxicity.THRESHOLD]
    heads = {component for _, _, component in plain.near_duplicates(rows)}
    rows = [row for row in rows if row[0] in heads]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    leaky = {doc_id for doc_id, _ in plain.leaks(rows, items)}
    rows = [row for row in rows if row[0] not in leaky]
    levels = dismissal_levels(spark.createDataFrame(rows, "doc_id long, text string"))
    library, expected = Tokenizer.from_file(tokenizer_path()), []
    for doc_id, text in rows:
        ids = library.encode(mask(text, secret_spans(text, levels), "[secret]"), add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                         hashlib.sha256(shown.encode()).hexdigest()))
    found = [tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect()]
    assert sorted(found) == sorted(expected) and len(found) > 50


def test_stages_take_every_odd_row_and_return_the_columns(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, step in corpus_pipeline.STAGES:
            found = step(spark, docs, SF_DIR)
            if name != "bpe":
                assert found.columns == docs.columns, name
            assert found.count() <= docs.count(), name
