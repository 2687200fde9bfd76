"""Physical-plan properties the design relies on (checked on sf0.001)."""

from conftest import SF001
from ledgerlake.plans.registry import load_all

REG = load_all()


def plan(spark, name):
    df = REG[name][0](spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_scoring_has_no_shuffle(spark):
    p = plan(spark, "sentiment_score")
    assert "Exchange" not in p


def test_clip_prunes_unused_columns(spark):
    p = plan(spark, "clip_iqr")
    scan = [line for line in p.splitlines() if "FileScan parquet" in line]
    assert scan and all("l_shipdate" not in s and "l_returnflag" not in s for s in scan)


def test_star_join_preaggregates_lineitem(spark):
    p = plan(spark, "star_inner_join")
    # lineitem is partially aggregated per order before it meets orders
    lines = p.splitlines()
    li_scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "l_orderkey" in line)
    above = "\n".join(lines[max(0, li_scan - 4):li_scan])
    assert "partial_sum" in above


def test_global_fill_keyless_exchanges_only_carry_bounded_tables(spark):
    """The only single-partition exchanges of a global fill feed the
    one-row-per-partition offset table and the one-row-per-block carry
    table; the rows themselves never go through one."""
    lines = plan(spark, "fill_forward").splitlines()
    found = 0
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            found += 1
            child = next(x for x in lines[i + 1:] if x.strip(" :|+-"))
            assert "Aggregate(" in child and ("_pid" in child or "_blk" in child), child
    assert found > 0
