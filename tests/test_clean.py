"""Cleaning: P1-P3, W1, F5-F7, the whole clean() and its report."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation

from creditlake.operators.clean import (
    CleanOptions,
    clean,
    cleaning_report,
    first_org_per_user,
    observed_report,
    prepare,
    single_org_filter,
)
from conftest import raw_rows, ts


def _firsts(spark, rows):
    return {r.user_id: r.first_org for r in first_org_per_user(prepare(raw_rows(spark, rows))).collect()}


def test_first_org_orders_by_time_then_file_order(spark):
    rows = [
        # u1: first row has a null org; the earliest parsed row wins
        (None, "u1", "t", "add", "1", "2024-01-01 00:00:00"),
        ("org_b", "u1", "t", "add", "1", "2024-01-03 00:00:00"),
        ("org_a", "u1", "t", "add", "1", "2024-01-02 00:00:00"),
        # u2: an unparsed timestamp earliest in the file sorts last
        ("org_x", "u2", "t", "add", "1", "garbage"),
        ("org_y", "u2", "t", "add", "1", "2024-05-01 00:00:00"),
        # u3: two orgs at the same timestamp -> file order
        ("org_p", "u3", "t", "add", "1", "2024-01-01 00:00:00"),
        ("org_q", "u3", "t", "add", "1", "2024-01-01 00:00:00"),
        # u4: only null orgs -> no first org
        (None, "u4", "t", "add", "1", "2024-01-01 00:00:00"),
        # u5: org variants differing only in case are different raw values
        ("ORG_1", "u5", "t", "add", "1", "2024-01-01 00:00:00"),
        ("org_1", "u5", "t", "add", "1", "2024-01-02 00:00:00"),
    ]
    assert _firsts(spark, rows) == {"u1": "org_a", "u2": "org_y", "u3": "org_p", "u5": "ORG_1"}


def test_single_org_filter_drops_missing_ids_and_other_orgs(spark):
    rows = [
        (None, None, "t", "add", "1", "2024-01-01 00:00:00"),  # both missing
        ("org_a", None, "t", "add", "1", "2024-01-01 00:00:00"),  # user missing
        (None, "u1", "t", "add", "1", "2024-01-01 00:00:00"),  # org missing
        ("org_a", "u1", "t", "add", "1", "2024-01-02 00:00:00"),
        ("org_b", "u1", "t", "add", "1", "2024-01-03 00:00:00"),  # second org
        ("ORG_A", "u1", "t", "add", "1", "2024-01-04 00:00:00"),  # raw variant
    ]
    kept = single_org_filter(prepare(raw_rows(spark, rows))).collect()
    assert [(r.org_id, r.user_id, r.seq) for r in kept] == [("org_a", "u1", 3)]


def test_clean_fills_and_normalises(spark):
    rows = [
        (" ORG_A ", "U1", None, "ADD ", None, None),
        (" ORG_A ", "U1", "   ", " Deduct", "2.5", "1990-01-01 00:00:00"),
        (" ORG_A ", "U1", "Type_1", None, "12d", "2024-01-01 10:00:00"),
    ]
    out = sorted(clean(raw_rows(spark, rows), keep_seq=True).collect(), key=lambda r: r.seq)
    assert [tuple(r)[:6] for r in out] == [
        ("org_a", "u1", "default", "add", 1.0, ts("1990-01-01 00:00:00")),
        ("org_a", "u1", "", "deduct", 2.5, ts("1990-01-01 00:00:00")),
        ("org_a", "u1", "type_1", None, 1.0, ts("2024-01-01 10:00:00")),
    ]
    assert clean(raw_rows(spark, rows)).columns == [
        "org_id", "user_id", "credit_type", "action", "credits", "timestamp",
    ]


def test_rule_runs_before_normalisation_by_default(spark):
    rows = [
        ("org_1", "u1", "t", "add", "1", "2024-01-01 00:00:00"),
        (" ORG_1 ", "u1", "t", "add", "1", "2024-01-02 00:00:00"),
        ("org_2", "u1 ", "t", "add", "1", "2024-01-01 00:00:00"),
    ]
    raw = raw_rows(spark, rows)
    default = clean(raw, keep_seq=True).collect()
    # ' ORG_1 ' is another raw org and drops; 'u1 ' is another raw user whose own
    # first org is org_2, so after normalising one user sits in two orgs.
    assert sorted((r.org_id, r.user_id) for r in default) == [("org_1", "u1"), ("org_2", "u1")]
    first = clean(raw, CleanOptions(normalise_first=True), keep_seq=True).collect()
    assert sorted((r.org_id, r.user_id, r.seq) for r in first) == [("org_1", "u1", 0), ("org_1", "u1", 1)]


def test_cleaning_report_counts_each_rule(spark):
    rows = [
        (None, None, "t", "add", "1", "x"),
        ("org_a", None, "t", "add", "1", "x"),
        ("org_a", "u1", "t", "add", "1", "2024-01-01 00:00:00"),
        ("org_b", "u1", "t", "add", "1", "2024-01-02 00:00:00"),
        ("org_c", "u2", "t", "add", "1", "2024-01-02 00:00:00"),
    ]
    r = cleaning_report(raw_rows(spark, rows)).collect()[0]
    assert (r.rows_in, r.dropped_missing_ids, r.dropped_org_rule, r.rows_out) == (5, 1, 2, 2)
    assert (r.dropped_org_missing, r.dropped_user_missing, r.dropped_other_org) == (0, 1, 1)


_text = st.sampled_from(["org_1", " ORG_1 ", "Org_2", None, "u1", "U1 ", "add", " Deduct", "x"])
_stamp = st.sampled_from(["2024-01-01 00:00:00", "02-01-2024", "1700000000", "bad", None])
_row = st.tuples(_text, _text, _text, _text, st.sampled_from(["1", "2.5", None, "z"]), _stamp)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_row, min_size=1, max_size=12))
def test_normalise_first_is_idempotent(spark, rows):
    opts = CleanOptions(normalise_first=True)
    once = clean(raw_rows(spark, rows), opts, keep_seq=True)
    as_text = once.selectExpr(
        "org_id", "user_id", "credit_type", "action", "cast(credits as string) as credits",
        "cast(timestamp as string) as timestamp", "seq",
    )
    twice = clean(as_text, opts, keep_seq=True)
    key = lambda r: r.seq
    assert sorted(once.collect(), key=key) == sorted(twice.collect(), key=key)


def test_dedup_flag_keeps_the_first_row_per_key(spark):
    rows = [
        ("org_1", "u1", "t", "add", "1", "2024-01-01 00:00:00"),
        ("org_1", "u1", "t", "deduct", "2", "2024-01-01 00:00:00"),  # same key, later in the file
        ("org_1", "u1", "t", "add", "3", None),
        ("org_1", "u1", "t", "add", "4", "bad"),  # both become the 1990 sentinel: same key
    ]
    raw = raw_rows(spark, rows)
    assert clean(raw).count() == 4
    kept = sorted((r.seq, r.credits) for r in clean(raw, CleanOptions(dedup=True), keep_seq=True).collect())
    assert kept == [(0, 1.0), (2, 3.0)]
    assert clean(raw, CleanOptions(dedup=True)).columns == [
        "org_id", "user_id", "credit_type", "action", "credits", "timestamp",
    ]


def test_rule_again_after_normalising(spark):
    rows = [
        ("org_1", "u1", "t", "add", "1", "2024-01-02 00:00:00"),
        ("org_2", "u1 ", "t", "add", "1", "2024-01-01 00:00:00"),  # another raw user, own first org
        ("org_2", "u1 ", "t", "add", "1", None),  # unparsed: sentinel 1990 after filling
    ]
    raw = raw_rows(spark, rows)
    once = sorted((r.seq, r.org_id) for r in clean(raw, keep_seq=True).collect())
    assert once == [(0, "org_1"), (1, "org_2"), (2, "org_2")]  # 'u1' sits in two orgs
    twice = clean(raw, CleanOptions(rule_again_after_normalise=True), keep_seq=True).collect()
    # normalised, 'u1' has one history; its earliest row is the 1990 sentinel row in org_2
    assert sorted((r.seq, r.org_id) for r in twice) == [(1, "org_2"), (2, "org_2")]


def test_rule_again_breaks_ties_by_organisation(spark):
    """The notebook's rows are sorted by (org_id, user_id) before its second pass, and its sorts are stable."""
    rows = [
        ("org_2", "u1 ", "t", "add", "1", None),
        ("org_1", "u1", "t", "add", "1", None),
    ]
    twice = clean(raw_rows(spark, rows), CleanOptions(rule_again_after_normalise=True), keep_seq=True).collect()
    assert [(r.seq, r.org_id) for r in twice] == [(1, "org_1")]


def test_counts_observed_during_cleaning_equal_the_report(spark):
    rows = [
        (None, None, "t", "add", "1", "2024-01-01 00:00:00"),
        ("org_a", None, "t", "add", "12d", "2024-01-01 00:00:00"),
        (None, "u1", "t", "add", "1", None),
        ("org_a", "u1", "t", "add", "abc", "2024-01-02 00:00:00"),
        ("org_b", "u1", "t", "add", None, "soon"),
        ("org_a", "u1", "t", "add", "1", "later"),
    ]
    raw = raw_rows(spark, rows)
    for n, options in enumerate((CleanOptions(), CleanOptions(normalise_first=True), CleanOptions(hot_rows=1))):
        counts = Observation(f"counts-{n}")
        out = clean(raw, options, counts=counts)
        found = observed_report(counts, out.count(), raw, options)
        expected = cleaning_report(raw, options).first().asDict()
        assert found == {**expected, "unparsed_timestamps": 2, "unparsed_credits": 2}
    for n, none_kept in enumerate((raw.where("false"), raw.where("seq = 1"))):
        counts = Observation(f"counts-none-{n}")
        out = clean(none_kept, counts=counts)
        found = observed_report(counts, out.count(), none_kept)
        assert {k: found[k] for k in found if not k.startswith("unparsed")} == cleaning_report(none_kept).first().asDict()
