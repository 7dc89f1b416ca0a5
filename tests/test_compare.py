from datetime import datetime

from conftest import rows

from doclathe.operators.compare import compare_copies

S = "entity_id string, entity_name string, services array<struct<type:string,description:struct<en:string,ro:string>,is_presented:boolean>>, updated_at timestamp, name string, side int"
T0, T1 = datetime(2025, 1, 1), datetime(2025, 2, 1)


def svc(kind, en="text", ro="t", flag=True):
    return (kind, (en, ro), flag)


def diff(spark, a, b, **k):
    make = lambda data: spark.createDataFrame([(*r, "clash", 7) for r in data], S)
    return rows(compare_copies(make(a), make(b), **k))


def test_rows_names_and_services(spark):
    a = [("E1", "Name", [svc("A b"), svc("c")], T0), ("E2", "x", None, T0), ("E4", "same  name", [svc(" Q ")], T0)]
    b = [("E1", "Other", [svc("a_b", en="more"), svc("d")], T0), ("E3", "x", [], T0), ("E4", "same name ", [svc("q"), svc("Q")], T0)]
    assert diff(spark, a, b) == [("E1", "", "entity_name", "differs"), ("E1", "a_b", "description_en", "differs"), ("E1", "c", "service", "only_clean"), ("E1", "d", "service", "only_store"), ("E2", "", "row", "only_clean"), ("E3", "", "row", "only_store")]


def test_latest_state_counts(spark):
    a = [("E1", "old", [], T0), ("E1", "new", [], T1), ("E1", "new", [], T1)]
    assert diff(spark, a, [("E1", "new", None, T0)]) == []


def test_null_and_composition(spark):
    a = [("E1", None, [svc("a", en=None, ro="é", flag=None), None], T0), (None, "x", [], T0)]
    b = [("E1", "", [svc("a", en="", ro="é", flag=False)], T0)]
    assert diff(spark, a, b) == [("E1", "a", "is_presented", "differs")]


def test_empty_sides(spark):
    assert diff(spark, [], []) == []
    assert diff(spark, [("E1", "x", [], T0)], []) == [("E1", "", "row", "only_clean")]


def test_control_characters_and_case(spark):
    assert diff(spark, [("E1", "a\x1db", [svc("t", en="x\x1ey")], T0)], [("E1", "a b", [svc("t", en="X y")], T0)]) == [("E1", "t", "description_en", "differs")]


def test_hot_key_many_partitions(spark):
    a = [("HOT", f"n{i}", [], T0) for i in range(3000)] + [(f"E{i}", "x", [svc("a")], T0) for i in range(200)]
    b = [(f"E{i}", "x", [svc("a", ro="other")], T0) for i in range(100, 300)]
    got = diff(spark, a, b, partitions=7)
    assert len(got) == 1 + 100 + 100 + 100 and ("HOT", "", "row", "only_clean") in got
