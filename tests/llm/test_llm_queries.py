"""The registered queries: against their SQL where there is one, against plain versions elsewhere."""

import pytest

from cadastra.checks.compare import connect, difference
from cadastra.llm.queries import ORACLES, QUERIES
from tests.llm import plain

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def given(connection):
    return connection.execute("SELECT doc_id, text FROM documents").fetchall()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SF_DIR).toArrow(), connection.execute(ORACLES[name]).to_arrow_table()) is None


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ORACLES])
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_one_query_per_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


def test_plain_versions(spark, given):
    def found(name, *columns):
        return sorted((tuple(r) for r in QUERIES[name](spark, SF_DIR).select(*columns).collect()), key=repr)

    assert found("op4_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(plain.substring(given), key=repr)
    assert found("op6_simhash_near_dedup", "doc_id", "fingerprint", "component_id") == sorted(
        plain.near_duplicates(given), key=repr)
    assert found("op10_suffix_array_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(
        plain.suffix(given), key=repr)


def test_leaks_match_all_windows(spark, given, connection):
    items = connection.execute("SELECT item_id, text FROM benchmark").fetchall()
    found = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9)
             for r in QUERIES["op1_benchmark_decontamination"](spark, SF_DIR).collect()}
    assert found == {k: round(v, 9) for k, v in plain.leaks(given, items).items()}
