from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from helpers import at, day, plan_of, tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import StructField, StructType, TimestampType

from tidemark.operators.scd2 import scd2_history, scd2_merge
from tidemark.schemas import COMPANY_CHECK_COLUMNS, COMPANY_SEED, COMPANY_SNAPSHOT
from tidemark.sources.snapshots import SnapshotTable

SPAN = ["ticker", "sector", "dbt_valid_from", "dbt_valid_to"]


def seed(spark, rows, effective="2026-01-01"):
    data = [(t, f"{t} Inc.", s, "X", day(effective)) for t, s in rows]
    return spark.createDataFrame(data, COMPANY_SEED)


def merge(history, incoming, as_of):
    closed = history.filter("dbt_valid_to is not null")
    decided = scd2_merge(
        history.filter("dbt_valid_to is null"), incoming, "ticker", COMPANY_CHECK_COLUMNS, at(as_of)
    )
    return closed.unionByName(decided)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], COMPANY_SNAPSHOT)


def test_first_run_opens_everything(spark, empty):
    result = merge(empty, seed(spark, [("A", "Tech"), ("B", None)]), "2026-01-01T10:00:00")
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in COMPANY_SNAPSHOT
    ]
    start = at("2026-01-01T10:00:00")
    assert tuples(result, *SPAN) == [("A", "Tech", start, None), ("B", None, start, None)]


def test_changed_new_unchanged_and_vanished_keys(spark, empty):
    first = merge(empty, seed(spark, [("A", "Tech"), ("B", "Tech"), ("C", "Tech")]), "2026-01-01")
    second = merge(first, seed(spark, [("A", "Health"), ("B", "Tech"), ("D", "Tech")]), "2026-02-01")
    one, two = at("2026-01-01"), at("2026-02-01")
    assert tuples(second, *SPAN) == [
        ("A", "Health", two, None),
        ("A", "Tech", one, two),
        ("B", "Tech", one, None),
        ("C", "Tech", one, None),  # missing from the new data: stays open
        ("D", "Tech", two, None),
    ]


def test_other_columns_do_not_open_versions(spark, empty):
    first = merge(empty, seed(spark, [("A", "Tech")]), "2026-01-01")
    second = merge(first, seed(spark, [("A", "Tech")], effective="2026-05-01"), "2026-02-01")
    assert tuples(second, "effective_date", "dbt_valid_to") == [(day("2026-01-01"), None)]


def test_null_to_value_is_a_change_and_null_to_null_is_not(spark, empty):
    first = merge(empty, seed(spark, [("A", None), ("B", None)]), "2026-01-01")
    second = merge(first, seed(spark, [("A", "Tech"), ("B", None)]), "2026-02-01")
    assert second.filter("ticker = 'A'").count() == 2
    assert second.filter("ticker = 'B'").count() == 1


def test_repeated_input_changes_nothing(spark, empty):
    data = seed(spark, [("A", "Tech"), ("B", "Health")])
    first = merge(empty, data, "2026-01-01")
    assert tuples(merge(first, data, "2026-02-01"), *SPAN) == tuples(first, *SPAN)


def test_closing_keeps_the_identity_of_a_version(spark, empty):
    first = merge(empty, seed(spark, [("A", "Tech")]), "2026-01-01")
    second = merge(first, seed(spark, [("A", "Health")]), "2026-02-01")
    old, new = first.first(), {r["sector"]: r for r in second.collect()}
    assert new["Tech"]["dbt_scd_id"] == old["dbt_scd_id"] != new["Health"]["dbt_scd_id"]
    assert new["Tech"]["dbt_updated_at"] == old["dbt_updated_at"]


runs = st.lists(
    st.dictionaries(st.sampled_from("ABC"), st.sampled_from(["Tech", "Health", None])),
    min_size=1,
    max_size=5,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(runs)
def test_replay_equals_single_runs_and_intervals_are_sound(spark, empty, runs):
    history, recorded = empty, []
    for month, rows in enumerate(runs, start=1):
        moment = datetime(2026, month, 1)
        history = merge(history, seed(spark, list(rows.items())), moment.isoformat()).checkpoint()
        recorded += [(t, f"{t} Inc.", s, "X", day("2026-01-01"), moment) for t, s in rows.items()]
    schema = StructType([*COMPANY_SEED.fields, StructField("run_at", TimestampType())])
    snapshots = spark.createDataFrame(recorded, schema)
    replay = scd2_history(snapshots, "ticker", COMPANY_CHECK_COLUMNS, "run_at")
    assert tuples(replay.select(history.columns), "*") == tuples(history, "*")
    by_key = {}
    for ticker, _, start, end in tuples(history, *SPAN):
        by_key.setdefault(ticker, []).append((start, end))
    for spans in by_key.values():
        spans.sort(key=lambda span: span[0])
        assert [end for _, end in spans[:-1]] == [start for start, _ in spans[1:]]
        assert spans[-1][1] is None


def test_stored_snapshot(spark, tmp_path):
    table = SnapshotTable(f"{tmp_path}/snap", COMPANY_SNAPSHOT, "ticker", COMPANY_CHECK_COLUMNS)
    assert table.history(spark).isEmpty()
    table.run(seed(spark, [("A", "Tech"), ("B", "Tech")]), at("2026-01-01"))
    table.run(seed(spark, [("A", "Health"), ("B", "Tech")]), at("2026-02-01"))
    table.run(seed(spark, [("A", "Energy"), ("B", "Tech")]), at("2026-03-01"))
    one, two, three = at("2026-01-01"), at("2026-02-01"), at("2026-03-01")
    expected = [
        ("A", "Energy", three, None),
        ("A", "Health", two, three),
        ("A", "Tech", one, two),
        ("B", "Tech", one, None),
    ]
    assert tuples(table.history(spark), *SPAN) == expected
    # Repeating the last run has no further effect; repeating an older one is refused.
    table.run(seed(spark, [("A", "Energy"), ("B", "Tech")]), three)
    assert tuples(table.history(spark), *SPAN) == expected
    with pytest.raises(ValueError, match="later"):
        table.run(seed(spark, [("A", "Tech")]), two)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(runs, st.randoms(use_true_random=False))
def test_runs_in_any_order_leave_the_same_versions(spark, tmp_path_factory, runs, random):
    table = SnapshotTable(
        str(tmp_path_factory.mktemp("late") / "snap"), COMPANY_SNAPSHOT, "ticker", COMPANY_CHECK_COLUMNS
    )
    snapshots = [(datetime(2026, month, 1), rows) for month, rows in enumerate(runs, start=1)]
    schema = StructType([*COMPANY_SEED.fields, StructField("run_at", TimestampType())])
    recorded = [(t, f"{t} Inc.", s, "X", day("2026-01-01"), m) for m, rows in snapshots for t, s in rows.items()]
    replay = scd2_history(spark.createDataFrame(recorded, schema), "ticker", COMPANY_CHECK_COLUMNS, "run_at")
    random.shuffle(snapshots)
    for moment, rows in snapshots:
        table.run(seed(spark, list(rows.items())), moment)
    history = table.history(spark)
    assert tuples(replay.select(history.columns), "*") == tuples(history, "*")


def test_a_late_run_reaches_views_and_dies_without_a_trace(spark, tmp_path):
    table = SnapshotTable(
        f"{tmp_path}/snap", COMPANY_SNAPSHOT, "ticker", COMPANY_CHECK_COLUMNS, f"{tmp_path}/published"
    )
    one, two, three = at("2026-01-01"), at("2026-02-01"), at("2026-03-01")
    table.run(seed(spark, [("A", "Tech")]), one)
    table.run(seed(spark, [("A", "Tech")]), three)  # changes nothing, but is when A was seen again
    table.run(seed(spark, [("A", "Energy")]), two)
    expected = [("A", "Energy", two, three), ("A", "Tech", one, two), ("A", "Tech", three, None)]
    assert tuples(table.history(spark), *SPAN) == expected
    assert tuples(spark.sql(table.query()), *SPAN) == expected
    with pytest.raises(ValueError, match="completed"):
        table.run(seed(spark, [("A", "Tech")]), one)
    # had the late run died before it completed, readers would see the state before it
    late = table.runs(spark)[-1]
    (tmp_path / "snap" / f"run={late}" / "_COMPLETE").unlink()
    assert tuples(table.history(spark), *SPAN) == [("A", "Tech", one, None)]
    (tmp_path / "snap" / f"run={late}" / "_COMPLETE").touch()
    # the next run builds on the spliced versions and removes what lies before them
    four = three + timedelta(days=1)
    table.run(seed(spark, [("A", "Health")]), four)
    expected[2:] = [("A", "Health", four, None), ("A", "Tech", three, four)]
    assert tuples(table.history(spark), *SPAN) == sorted(expected, key=str)
    assert tuples(spark.sql(table.query()), *SPAN) == sorted(expected, key=str)
    assert len(table.runs(spark)) == 2


def test_an_unfinished_run_is_ignored(spark, tmp_path):
    table = SnapshotTable(f"{tmp_path}/snap", COMPANY_SNAPSHOT, "ticker", COMPANY_CHECK_COLUMNS)
    table.run(seed(spark, [("A", "Tech")]), at("2026-01-01"))
    table.run(seed(spark, [("A", "Health")]), at("2026-02-01"))
    (tmp_path / "snap" / "run=2026-02-01T00-00-00-000000" / "_COMPLETE").unlink()
    assert tuples(table.history(spark), *SPAN) == [("A", "Tech", at("2026-01-01"), None)]
    table.run(seed(spark, [("A", "Health")]), at("2026-02-01"))
    assert tuples(table.history(spark), "sector") == [("Health",), ("Tech",)]


def test_a_new_run_reads_only_open_rows(spark, tmp_path):
    table = SnapshotTable(f"{tmp_path}/snap", COMPANY_SNAPSHOT, "ticker", COMPANY_CHECK_COLUMNS)
    for month in (1, 2, 3):
        table.run(seed(spark, [("A", str(month))]), datetime(2026, month, 1))
    previous = table.open_rows(spark, table.runs(spark)[-1])
    assert previous.count() == 1
    plan = plan_of(previous)
    assert "PartitionFilters: [isnotnull(is_open" in plan and "PushedFilters: []" in plan
