"""Guards for the scale rules: no driver round trips in operators, no local checkpoints,
no cross joins; scans keep pushdown and pruning."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1]
LIB = ROOT / "stocklens"


def _sources(folder):
    """Without the training-data operators, whose guards are tests of their own."""
    return {p: p.read_text(encoding="utf-8") for p in folder.rglob("*.py") if LIB / "llm" not in p.parents}


def test_no_driver_collection_in_library():
    banned = re.compile(r"\.(collect|toPandas|toLocalIterator)\(|localCheckpoint|crossJoin|\.rdd\b")
    hits = [str(p) for p, src in _sources(LIB).items() if banned.search(src)]
    assert hits == []


def test_no_broadcast_without_size_check():
    for p, src in _sources(LIB / "operators").items():
        for m in re.finditer(r"F\.broadcast\(", src):
            window = src[max(0, m.start() - 600): src.find("\n", m.start())]
            assert "BROADCAST:" in window or "# BROADCAST" in src[m.start(): src.find("\n", m.start())], p


def test_scan_pushdown_and_pruning(spark):
    from stocklens.plans.fixtures import Inputs
    from stocklens.sources import testdata

    i = Inputs(spark, "/root/testdata/sf0.001")
    plan = i.stock._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    li = testdata.table(spark, "/root/testdata/sf0.001", "lineitem").select("l_orderkey", "l_quantity")
    text = li._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_no_expand_for_distinct_counts(spark):
    from stocklens.plans.registry import REGISTRY

    for name in ("a2_sales_stats", "v5_run_summary", "a9_distinct_count", "g3_plan_profile"):
        assert "Expand" not in _plan(REGISTRY[name](spark, "/root/testdata/sf0.001")), name


def test_both_sales_scans_are_pruned(spark):
    from stocklens.plans.registry import REGISTRY

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = REGISTRY["j1_join_value_quantity"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in text.splitlines() if "PushedFilters" in line and "l_shipdate" in line]
    assert len(scans) >= 2 and all("GreaterThanOrEqual(l_shipdate" in line for line in scans)


def test_no_coalesce_and_no_row_caps_in_operators():
    for p, src in _sources(LIB / "operators").items():
        assert ".coalesce(1" not in src and "sample_size" not in src, p
        for m in re.finditer(r"\.limit\(", src):
            assert re.match(r"\.limit\(k\)", src[m.start():]), p  # top-k only
