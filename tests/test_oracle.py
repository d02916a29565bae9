"""A part of the registered queries against their SQL; ``python -m checks.compare`` runs them all."""

import pytest

import __spark_entry__ as entry
from checks import fixtures
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
PART = [
    "src_3_json_decode", "src_5_current_table", "prj_5_record_json", "prj_6_version_cast", "prj_10_ten_fields",
    "flt_2_3_validation", "flt_5_version_filter", "flt_5_shared_state", "rte_5_pattern_route", "vc_3_apply_classified",
    "app_4_win_4_merge_on_read", "app_6_upsert_mode", "agg_5_duplicates_across_events", "agg_8_low_watermark",
    "met_1_summary_entries", "met_7_row_trace", "joi_5_offsets_by_ancestry", "fn_1_list_split",
]


@pytest.fixture(scope="module")
def base():
    return connect(SF)


@pytest.mark.parametrize("name", PART)
def test_query(spark, base, name):
    assert compare(spark, base, SF, name) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["iceberg_table", "dedup_key", "type", "version"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_half_prices_round_as_in_sql(spark, base, tmp_path):
    # Half to even: 10.5 is version 10, which is not newer than 10; 11.5 is version 12.
    orders = [(1, 1, "F", 10.0, "x"), (2, 1, "F", 10.5, "x"), (3, 1, "F", 11.5, "x"), (4, 1, "F", 12.0, "x")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"
                          ).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    found = entry.queries()["flt_5_shared_state"](spark, str(tmp_path))
    assert sorted(r.o_orderkey for r in found.collect()) == [1, 3]


@pytest.mark.parametrize("name", ["str_11_final_states", "str_9_states_kept", "str_8_stale_rows", "flt_5_version_filter"])
def test_filter_moves_only_what_is_asked_for(spark, name):
    def packs_records(rows):
        return "record, record#" in rows._jdf.queryExecution().optimizedPlan().toString()

    assert packs_records(fixtures.accepted_rows(spark, SF))
    assert not packs_records(entry.queries()[name](spark, SF))


@pytest.mark.parametrize("name", ["met_7_row_trace", "joi_3_file_lineage", "vc_3_apply_classified", "snk_7_unknown_tables",
                                  "srt_2_order_by_key"])
def test_messages_are_parsed_once(spark, name):
    # What has been written is read from there, however many branches need it.
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "from_json" not in plan


def test_records_are_decoded_once(spark):
    plan = entry.queries()["snk_9_typed_items"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "parseJson" not in plan and "from_json" not in plan


def test_bucket_batch_is_not_parsed_again(spark, monkeypatch):
    from tidelog.sources import published
    plans, own = [], published.apply_to_buckets

    def seen(session, path, changes, *how, **more):
        plans.append(changes._jdf.queryExecution().executedPlan().toString())
        return own(session, path, changes, *how, **more)

    monkeypatch.setattr(published, "apply_to_buckets", seen)
    entry.queries()["app_3_changed_buckets"](spark, SF)
    assert len(plans) == 1 and "from_json" not in plans[0]
