"""Typed profile of attribute bags: nested paths, types, unusable values."""

from __future__ import annotations

from abx.operators.profile import attribute_profile

ROWS = [
    ("a", '{"k": 1, "o": {"x": [1, 2.5, "s", null, {"y": true}]}}'), ("a", '{"k": "t", "e": {}, "f": []}'), ("b", "nope"),
    ("b", None), ("b", ""), ("b", "[1]"), ("b", '{"k": 1.0}'), ("b", '{"k": -3}'), (None, '{"k": 123456789012345678901234}'),
]


def test_paths_types_and_counts(spark):
    df = spark.createDataFrame(ROWS, "path string, p string")  # a group column named like one of the result's own
    got = {tuple(r[:3]): tuple(r[3:]) for r in attribute_profile(df.withColumnRenamed("path", "g"), "p", ["g"]).collect()}
    assert got == {
        ("a", "$", "object"): (2, None, None), ("a", "$.k", "integer"): (1, 1.0, 1.0), ("a", "$.k", "string"): (1, None, None),
        ("a", "$.o", "object"): (1, None, None), ("a", "$.e", "object"): (1, None, None), ("a", "$.f", "array"): (1, None, None),
        ("a", "$.o.x", "array"): (1, None, None), ("a", "$.o.x[*]", "integer"): (1, 1.0, 1.0),
        ("a", "$.o.x[*]", "number"): (1, 2.5, 2.5), ("a", "$.o.x[*]", "string"): (1, None, None),
        ("a", "$.o.x[*]", "null"): (1, None, None), ("a", "$.o.x[*]", "object"): (1, None, None),
        ("a", "$.o.x[*].y", "boolean"): (1, None, None), ("b", "$", "invalid"): (2, None, None), ("b", "$", "missing"): (1, None, None),
        ("b", "$", "array"): (1, None, None), ("b", "$[*]", "integer"): (1, 1.0, 1.0), ("b", "$", "object"): (2, None, None),
        ("b", "$.k", "integer"): (2, -3.0, 1.0), (None, "$", "object"): (1, None, None),
        (None, "$.k", "integer"): (1, float("123456789012345678901234"), float("123456789012345678901234")),
    }


def test_without_groups_and_without_rows(spark):
    df = spark.createDataFrame(ROWS, "g string, p string")
    assert {r.path: r.n_values for r in attribute_profile(df, "p").filter("value_type = 'integer'").collect()}["$.k"] == 4
    assert attribute_profile(df.limit(0), "p").collect() == []
