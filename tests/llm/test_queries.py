"""Registered queries against their SQL, and licence scans on a small tree."""

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strataflow.llm import licenses, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    columns, got = compare.spark_rows(queries.QUERIES[name](spark, SF))
    wanted_columns, want = compare.oracle_rows(compare.oracle_connection(SF), queries.ORACLES[name])
    assert columns == wanted_columns
    assert got == want, compare.difference(got, want)


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


TREE = [
    ("LICENSE", "Released under the MIT License."), ("src/LICENSE", "Licensed under the Apache License, Version 2.0."),
    ("src/COPYING", "Licensed under the Apache License, Version 2.0"), ("src/a/b/x.py", "code"), ("src/y.py", "code"),
    ("src/z.py", "first\n# This work is licensed under the GNU General Public License, version 3.\nlast"), ("docs/deep/er/t.md", None),
    ("docs/LICENSE", "All rights reserved by nobody in particular"), ("other.txt", ""), (None, "no path"), (None, "Licensed under CC BY 4.0"),
    ("src/y.py", "code"), ("src2/q", "mentions a license somewhere in a long line of quite different words about fish"),
]


def scan(spark, rows):
    df = spark.createDataFrame(
        [(i, p, t, "o", 1) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string, origin string, license int"
    )
    return licenses.scan(df, F.col("path"), F.regexp_extract("path", "[^/]*$", 0).isin("LICENSE", "COPYING"))


def test_tree(spark):
    got = {r["doc_id"]: (r["license"], r["origin"]) for r in scan(spark, TREE).collect()}
    assert got == {
        0: ("MIT", "own"), 1: ("Apache-2.0", "own"), 2: ("Apache-2.0", "own"), 3: ("Apache-2.0", "inherited"),
        4: ("Apache-2.0", "inherited"), 5: ("GPL-3.0", "own"), 6: ("MIT", "inherited"), 7: ("MIT", "inherited"),
        8: ("MIT", "inherited"), 9: (None, "none"), 10: ("CC-BY-4.0", "own"), 11: ("Apache-2.0", "inherited"), 12: ("MIT", "inherited"),
    }


MIT = next(t for name, t in licenses.TEMPLATES if name == "MIT" and len(t) > 1000)
GPL_HEADER = """# Copyright (C) 2020 Some One
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of

import os
"""
WORDS = " ".join(f"word{i}" for i in range(60))


def test_whole_texts_and_headers(spark):
    wrapped = "Copyright (c) 2020 Some One\r\n\r\n" + MIT.replace(". ", ".\r\n")
    rows = [
        ("a/LICENSE.txt", wrapped), ("a/b/code.c", "int main"), ("c/main.py", f"{GPL_HEADER}{WORDS}"), ("c/other.py", "import os"),
        ("d/LICENSE", f"Released under the MIT License\n{WORDS}"), ("d/x", "x"), ("e/notes", f"{WORDS}\nReleased under the MIT License"), ("e/x", "x"),
        ("f/deep/er/apache.java", "/*\n * Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use this file except in "
         "compliance with the License.\n * You may obtain a copy of the License at\n *\n *     http://www.apache.org/licenses/LICENSE-2.0\n */\nclass X {}"),
        ("g/any", next(t for n, t in licenses.TEMPLATES if n == "BSD-3-Clause" and len(t) > 1000)), ("g/h/i/j", "x"), ("g/h/COPYING", "Licensed under CC BY 4.0"),
    ]
    got = {r["path"]: (r["license"], r["origin"]) for r in scan(spark, rows).collect()}
    assert got == {
        "a/LICENSE.txt": ("MIT", "own"), "a/b/code.c": ("MIT", "inherited"), "c/main.py": ("GPL-3.0", "own"), "c/other.py": (None, "none"),
        "d/LICENSE": ("MIT", "own"), "d/x": ("MIT", "inherited"), "e/notes": ("MIT", "own"), "e/x": (None, "none"),
        "f/deep/er/apache.java": ("Apache-2.0", "own"), "g/any": ("BSD-3-Clause", "own"), "g/h/i/j": ("CC-BY-4.0", "inherited"),
        "g/h/COPYING": ("CC-BY-4.0", "own"),
    }


def test_any_column_names(spark):
    names = ["inherited", "_own", "_own_id", "_own_key", "directory", "given", "id", "text_key", "named", "whole", "unit", "best", "own_id", "n"]
    df = spark.createDataFrame([(1, "x/LICENSE", TREE[0][1], *names), (2, "x/y", None, *names)], ["doc_id", "path", "text", *names])
    got = licenses.scan(df, F.col("path"), F.lit(False)).orderBy("doc_id").collect()
    assert [r["license"] for r in got] == ["MIT", "MIT"] and all(r[n] == n for r in got for n in names)


def test_no_python_in_plan(spark):
    plan = scan(spark, TREE)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_empty_and_repeated(spark):
    assert scan(spark, TREE).limit(0).count() == 0
    df = spark.createDataFrame([], "doc_id long, path string, text string")
    assert licenses.scan(df, F.col("path"), F.lit(False)).count() == 0
    twice = spark.createDataFrame([(None, "a/x", TREE[0][1])] * 3 + [(None, "b/y", "none")], "doc_id long, path string, text string")
    got = licenses.scan(twice, F.col("path"), F.lit(False)).collect()
    assert sorted(r["origin"] for r in got) == ["none", "own", "own", "own"]
