from lodestar.operators.keys import assign_surrogate_keys, max_key, split_new_existing
from lodestar.operators.lookup import Lookup, build_fact, lookup_keys
from lodestar.operators.merge import merge_rows, upsert, upsert_pruned
from lodestar.operators.quality import expect_all_or_drop, expectation_report
from lodestar.operators.ranking import dedup_latest, rank_within, top_within
from lodestar.operators.scd1 import scd1_rows, scd1_upsert
from lodestar.operators.scd2 import scd2_apply, scd2_create, versions
from lodestar.operators.splice import scd2_splice

__all__ = [
    "Lookup",
    "assign_surrogate_keys",
    "build_fact",
    "dedup_latest",
    "expect_all_or_drop",
    "expectation_report",
    "lookup_keys",
    "max_key",
    "merge_rows",
    "rank_within",
    "scd1_rows",
    "scd1_upsert",
    "scd2_apply",
    "scd2_create",
    "scd2_splice",
    "split_new_existing",
    "top_within",
    "upsert",
    "upsert_pruned",
    "versions",
]
