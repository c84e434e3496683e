"""Physical plans: what must not appear anywhere, and what single operators must show."""

import os
import re

import pytest

import __spark_entry__ as entry
from studytrail.plans.catalog import catalog

SF = "/root/testdata/sf0.001"
if not os.path.isdir(SF):
    pytest.skip("no test tables here", allow_module_level=True)

BATCH = [n for n in sorted(catalog().queries) if not n.startswith("st_")]


def plan(spark, name):
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow"):
        assert word not in text
    # A single partition only for totals that combine first, never for a window.
    assert not re.search(r"Window.*\n(?:.*(?:Sort|Project).*\n)*.*Exchange SinglePartition", text)


@pytest.mark.parametrize("name", ["lb_topk", "lb_range_page", "wc_08", "wc_09", "wc_12", "set_random", "ls_remove_head"])
def test_rows_are_limited_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(spark, name))


@pytest.mark.parametrize("name", [n for n in BATCH if re.match(r"rep_.*_(summary|cells)", n)])
def test_a_report_reads_the_answers_once(spark, name):
    scans = [line for line in plan(spark, name).splitlines() if "FileScan" in line and "event_id" in line]
    with_answers = [s for s in scans if "event_type#" in s and "signup" not in s]
    assert len(with_answers) == 1


@pytest.mark.parametrize("name", [n for n in BATCH if re.match(r"ses_.*_(clean|compat)$", n)])
def test_a_session_job_shuffles_its_rows_once(spark, name):
    text = plan(spark, name)
    assert text.count("Exchange hashpartitioning") == 1 and text.count("FileScan") == 2


def test_sliced_sessions_shuffle_their_rows_once(spark):
    """The pieces that meet again are a second, small exchange over the same first one."""
    text = plan(spark, "ses_course_clean_sliced")
    first = re.findall(r"Exchange hashpartitioning\([^)]*__slice[^)]*\)", text)
    assert first and text.count("Exchange hashpartitioning") <= 3


def test_filters_reach_the_scan(spark, tmp_path):
    from studytrail.operators import cellfilters as C
    from studytrail.plans import fixtures as X

    path = str(tmp_path / "cells")
    X.cells(X.tables(spark, SF)("events")).write.parquet(path)
    cells = spark.read.parquet(path)
    for made in (C.inclusive_stop(cells, "u3"), C.prefix_filter(cells, "u1"), C.get_rows(cells, ["u1", "u2"]), C.scan_family(cells, "course")):
        text = made._jdf.queryExecution().executedPlan().toString()
        pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
        assert re.search(r"LessThanOrEqual|StringStartsWith|In\(|EqualTo", pushed)
