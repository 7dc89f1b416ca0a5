from datetime import datetime

from conftest import rows

from doclathe.operators.snapshots import snapshot_changes, validity_intervals

S = "snapshot_no int, rule_id string, title string, description string, loaded_at timestamp"
AT = [datetime(2025, 1, d) for d in range(1, 20)]


def changes(spark, data, schema=S):
    return rows(snapshot_changes(spark.createDataFrame(data, schema)).select("snapshot_no", "key", "change"))


def test_added_removed_changed_and_back(spark):
    data = [(1, "R1", "a", "x", AT[1]), (2, " r1 ", "a", "y", AT[2]), (4, "R1", "a", "y", AT[4]), (3, "R2", "b", "b", AT[3]), (4, "R2", "b", "b", AT[4]), (1, "R3", "c", "c", AT[1]), (2, "R3", "C ", "c ", AT[2])]
    assert changes(spark, data) == [(2, "R1", "changed"), (3, "R1", "removed"), (3, "R2", "added"), (3, "R3", "removed"), (4, "R1", "added")]


def test_latest_row_counts_and_composition(spark):
    data = [(1, "R1", "é", "x", AT[1]), (2, "R1", "old", "x", AT[2]), (2, "R1", "é", "X", AT[9]), (2, "R1", "é", "X", AT[9])]
    assert changes(spark, data) == []


def test_null_equals_empty_and_keys_without_value(spark):
    data = [(1, "R1", "a", None, AT[1]), (2, "R1", "a", "", AT[2]), (2, None, "a", "b", AT[2]), (2, "  ", "a", "b", AT[2]), (None, "R9", "a", "b", AT[2])]
    assert changes(spark, data) == []


def test_only_the_snapshot_one_less_counts(spark):
    data = [(1, "R1", "a", "x", AT[1]), (3, "R1", "a", "y", AT[3]), (3, "R2", "a", "y", AT[3]), (4, "R1", "a", "y", AT[4])]
    assert changes(spark, data) == [(4, "R2", "removed")]


def test_ties_have_one_result_and_empty_table(spark):
    data = [(1, "R1", "a", "x", AT[1]), (2, "R1", "a", "x", None), (2, "R1", "a", "z", AT[2]), (2, "R1", "a", "y", AT[2])]
    assert changes(spark, data) == changes(spark, data[::-1]) == [(2, "R1", "changed")]
    assert changes(spark, []) == []


def test_hot_key_and_extra_columns(spark):
    data = [(1 + i % 2, "HOT", "a", "x" if i % 2 else "y", AT[i % 5], "key", "h") for i in range(2000)] + [(n, f"R{i}", "a", "b", AT[1], "", "") for i in range(50) for n in (1, 2)]
    assert changes(spark, data, S + ", key string, row_hash string") == [(2, "HOT", "changed")]


def test_intervals_are_maximal(spark):
    states = spark.createDataFrame([(1, "k", "a"), (2, "k", "a"), (3, "k", "b"), (5, "k", "b")], "snapshot_no int, key string, row_hash string")
    assert rows(validity_intervals(states).select("key", "row_hash", "valid_from", "valid_to")) == [("k", "a", 1, 2), ("k", "b", 3, 3), ("k", "b", 5, 5)]
