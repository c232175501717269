"""The registered queries over whole tables: against SQL where there is some."""

import pytest

import __spark_entry__ as entry
from check_queries import canonical, open_tables
from lodestar.llm.queries import ORACLES, QUERIES

CONTRACT = {
    "op1": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op2": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op3": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op4": ["doc_id", "n_shingles", "component_id"],
    "op5": ["doc_id", "held_out", "lang_pred", "score"],
    "op6": ["record_id", "refers_to", "outcome", "headers"],
    "op7": ["page_id", "host", "path", "rule", "verdict"],
    "op8": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op10": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op11": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op12": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
}


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == CONTRACT.keys()
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, sf, name):
    got = QUERIES[name](spark, sf)
    wanted = CONTRACT[name.split("_")[0]]
    assert set(wanted) <= set(got.columns)
    if name in ORACLES:
        expected = canonical(open_tables(sf).execute(ORACLES[name]).df())
        assert canonical(got.toPandas()) == expected
    else:
        assert got.count() >= 200
