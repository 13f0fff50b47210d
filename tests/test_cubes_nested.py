"""Metric cubes against the plain metrics of each group, and JSON profiles of odd documents."""

import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from millrace.operators import nested
from millrace.operators.cubes import metrics_cube, total_only
from millrace.operators.evaluation import binary_metrics, regression_metrics
from millrace.operators.nested import JsonColumns, JsonSettings, column_name, column_types, json_columns, json_profile


@pytest.fixture(scope="module")
def judged(spark):
    random.seed(7)
    rows = [(random.choice(["a", "b", None]), random.choice([1, 2]), math.nan if i % 11 == 0 else random.gauss(0, 1), None if i % 13 == 0 else random.gauss(0, 1),
             i % 2, random.random()) for i in range(200)]
    return spark.createDataFrame(rows, "g string, h int, y double, p double, hit int, prob double").cache()


@pytest.mark.parametrize("kind, truth, guess, plain", [("regression", "y", "p", regression_metrics), ("binary", "hit", "prob", binary_metrics)])
def test_every_subtotal_equals_its_group_alone(judged, kind, truth, guess, plain):
    cube = metrics_cube(judged, truth, guess, ["g", "h"], kind).collect()
    names = [c for c in plain(judged, truth, guess).columns if c in cube[0].asDict()]
    assert len(names) >= 6
    for size in range(3):
        for totals in combinations(["g", "h"], size):
            by = [c for c in ("g", "h") if c not in totals]
            own = [r for r in cube if r["grouping"] == total_only(["g", "h"], totals)]
            expected = plain(judged, truth, guess, by).collect()
            assert len(own) == len(expected)
            for e in expected:
                match = [r for r in own if all(r[c] == e[c] for c in by)]
                assert len(match) == 1
                for c in names:
                    assert match[0][c] == pytest.approx(e[c], abs=1e-9) if e[c] is not None else match[0][c] is None


def test_confusion_and_listed_sets(judged):
    cube = metrics_cube(judged, "hit", "h", ["g"], "confusion", [["g"], []])
    assert cube.columns == ["g", "y_true", "y_pred", "grouping", "n"]
    assert cube.where(F.col("grouping") == 7).first()["n"] == 200
    assert sum(r["n"] for r in cube.where(F.col("grouping") == 4).collect()) == 200
    some = metrics_cube(judged, "y", "p", ["g", "h"], sets=[["h"], []])
    assert {r["grouping"] for r in some.collect()} == {2, 3} and some.count() == 3
    for wrong in (dict(by=["g", "g"]), dict(by=["absent"]), dict(by=["g"], sets=[["h"]]), dict(by=["g"], kind="other")):
        with pytest.raises(ValueError):
            metrics_cube(judged, "y", "p", **wrong)


def test_cube_of_nothing_and_without_columns(judged):
    assert metrics_cube(judged, "y", "p", []).count() == 1
    empty = metrics_cube(judged.limit(0), "y", "p", ["g"]).collect()
    assert len(empty) <= 1 and all(r["n"] in (0, None) for r in empty)


DOCS = [
    '{"a": 1, "b": {"c": [1, 2.5, {"d": null}], "e f": "x"}, "it\'s": true}', '{"a": 2.5}', '{"a": "t", "b": []}', '{"a": null}', "[1, [2]]", '"text"', "17", "{",
    "", None, "null", '{"a": ' + '{"a": ' * 20 + "1" + "}" * 21,
]


def test_profile_of_odd_documents(spark):
    df = spark.createDataFrame([(d,) for d in DOCS], "doc string")
    found = {(r["path"], r["type"]): r["n"] for r in json_profile(df, "doc").collect()}
    assert found["$", "object"] == 5 and found["$", "invalid"] == 2 and found["$", "array"] == 1 and found["$", "null"] == 1
    assert found["$.a", "bigint"] == 1 and found["$.a", "decimal"] == 1 and found["$.a", "string"] == 1 and found["$.a", "null"] == 1 and found["$.a", "object"] == 1
    assert found["$.b.c[*]", "object"] == 1 and found["$.b.c[*].d", "null"] == 1 and found["$.b['e f']", "string"] == 1
    assert found["$['it\\'s']", "boolean"] == 1 and found["$[*][*]", "bigint"] == 1 and found["$" + ".a" * 21, "bigint"] == 1
    shares = {}
    for r in json_profile(df, "doc").collect():
        shares[r["path"]] = shares.get(r["path"], 0) + r["share"]
    assert all(v == pytest.approx(1) for v in shares.values())


def test_documents_are_made_and_parsed_once(spark):
    """Up to five levels; the column may be the end of a long computation."""
    made = spark.sparkContext.accumulator(0)
    make = F.udf(lambda i: made.add(1) or ["{", '{"a": {"b": [1, {"c": null}]}}', None, '"t"'][i % 4], "string")
    found = json_profile(spark.range(40).select(make("id").alias("doc")), "doc").collect()
    assert {(r["path"], r["type"]): r["n"] for r in found} == {
        ("$", "invalid"): 10, ("$", "object"): 10, ("$", "string"): 10, ("$.a", "object"): 10, ("$.a.b", "array"): 10,
        ("$.a.b[*]", "bigint"): 10, ("$.a.b[*]", "object"): 10, ("$.a.b[*].c", "null"): 10}
    assert made.value == 40


@pytest.mark.parametrize("levels", [1, 3, 64])
def test_passes_of_any_depth_find_the_same(spark, monkeypatch, levels):
    df = spark.createDataFrame([(d,) for d in DOCS], "doc string")
    found = sorted(map(tuple, json_profile(df, "doc").collect()))
    monkeypatch.setattr(nested, "LEVELS_A_PASS", min(levels, 12))
    monkeypatch.setattr(nested, "MOST_LEVELS", 22 if levels == 1 else 64)
    assert sorted(map(tuple, json_profile(df, "doc").collect())) == found
    monkeypatch.setattr(nested, "MOST_LEVELS", 3)
    depth = {p: p.count(".a") for p, *_ in map(tuple, json_profile(df, "doc").collect()) if p.startswith("$.a")}
    assert max(depth.values()) == 2


def test_columns_have_types_that_all_values_fit(spark):
    rows = [('{"i": 1, "n": 1, "t": true, "m": 1, "o": {"x": "y"}, "l": [1]}',), ('{"i": -5, "n": 2.5, "t": false, "m": "one", "o": {"x": "z"}}',), ("broken",), (None,)]
    df = spark.createDataFrame(rows, "doc string")
    types = column_types(json_profile(df, "doc"))
    assert types == {"$.i": "bigint", "$.n": "double", "$.t": "boolean", "$.m": "string", "$.o.x": "string", "$.l": "string"}
    model = JsonColumns(JsonSettings(("doc", "absent"), drop=True)).fit(df)
    out = model.transform(df)
    assert sorted(out.columns) == sorted(["doc_i", "doc_n", "doc_t", "doc_m", "doc_o_x", "doc_l"])
    first, second = out.collect()[:2]
    assert (first["doc_i"], first["doc_n"], first["doc_m"], first["doc_l"], second["doc_n"], second["doc_m"]) == (1, 1.0, "1", "[1]", 2.5, "one")
    assert all(v is None for r in out.collect()[2:] for v in r)


def test_names_of_columns(spark):
    assert column_name("p", "$.a['b c'].d") == "p_a_b c_d"
    df = spark.createDataFrame([('{"a": 1}', 1)], "doc string, doc_a int")
    with pytest.raises(ValueError):
        json_columns(df, "doc", {"$.a": "bigint"})
    assert json_columns(df, "doc", {"$.a": "bigint"}, ".").columns == ["doc", "doc_a", "doc.a"]
    assert json_profile(df.limit(0), "doc").count() == 0
