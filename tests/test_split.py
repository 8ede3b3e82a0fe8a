"""Readers of files whose records cross lines: any cut of a file gives the records of the whole file."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F, types as T

from strataflow import contracts
from strataflow.sources import files, split
from strataflow.sources.split import BEGINS, ENDS, WHOLE, CsvLines, JsonElements

CONTRACT = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b", "c")])


def cut_everywhere(form, text, pieces):
    """Records of a text that is dealt into the given chunks, with start states as the readers find them."""
    state, depth, base, out, open_ = 0, 0, form.base(pieces[0]), [], None
    for piece in pieces:
        for place, value in form.cut(piece, state, depth, base):
            if place == WHOLE:
                out.append(value)
            elif place == BEGINS:
                assert open_ is None
                open_ = value
            else:
                open_ += value
                after, change = form.after(piece, state)
                done = after == 0 and (form is CsvLines or depth + change <= base or not piece.endswith(value))
                if done or not piece.startswith(value) or value != piece:
                    out.append(open_)
                    open_ = None
        after, change = form.after(piece, state)
        state, depth = after, depth + change
    return out + ([open_] if open_ is not None else [])


def chunked(rng, text, separator):
    parts = text.split(separator)
    if parts[-1] == "":
        parts.pop()
    out = [[]]
    for part in parts:
        if out[-1] and rng.random() < 0.5:
            out.append([])
        out[-1].append(part + separator)
    return ["".join(p) for p in out]


FIELDS = ["", "x", "two words", 'quo"te', '""', "a,b", "line\nbreak", "\n", '"\n"', "é\r\nü", " lead", "5' 3\""]


def test_csv_records_for_any_chunks():
    rng = random.Random(2)
    for _ in range(400):
        rows = [[rng.choice(FIELDS) for _ in range(3)] for _ in range(rng.randint(1, 8))]
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator="\n").writerows([["h", "h", "h"], *rows])
        text = out.getvalue()
        if rng.random() < 0.3:
            text += '5" pipe,x"y",z\n"a"b,c,d\n'
            rows += [['5" pipe', 'x"y"', "z"], ["ab", "c", "d"]]
        found = cut_everywhere(CsvLines, text, chunked(rng, text, "\n"))
        whole = [v for _, v in CsvLines.cut(text, 0, 0, 0)]
        assert found == whole and len(found) == 1 + len(rows)


def test_json_elements_for_any_chunks():
    rng = random.Random(3)
    values = [1, None, "x", 'q"uo\\te', "br{ace}s[", "é\n", {"n": {"m": [1, {"k": "}"}]}}, [], {}, [[{"a": 1}]], "\\", '"', '\\"}']
    for _ in range(400):
        rows = [{k: rng.choice(values) for k in rng.sample("abc", rng.randint(0, 3))} for _ in range(rng.randint(0, 7))]
        if rng.random() < 0.3:
            rows.append([1, {"a": 2}])
        text = json.dumps(rows, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5)
        found = cut_everywhere(JsonElements, text, chunked(rng, text, "}"))
        assert [json.loads(v) for v in found] == rows
    for one in ('{"a": {"b": "}"}}', ' {"a": 1}\n', "[]", "[ ]\n"):
        found = cut_everywhere(JsonElements, one, chunked(rng, one, "}"))
        assert [json.loads(v) for v in found] == ([json.loads(one)] if "a" in one else [])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_equals_one_task(spark, tmp_path):
    """One file in many blocks and chunks, against the reader that takes the file as one."""
    rng = random.Random(4)
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(CONTRACT.names)
    for i in range(4000):
        writer.writerow([f"{i}", rng.choice(FIELDS) + f"{i}", "\n".join(["x" * rng.randint(0, 9)] * rng.randint(1, 40)) + "."])
        if i % 500 == 0:
            out.write(f"{i},too,many,fields\n\n{i},few\n")
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "one.csv").write_bytes(out.getvalue().encode())
    wanted = spark.read.schema(T.StructType([*CONTRACT, T.StructField(files.CORRUPT, T.StringType())])).options(
        header=True, quote='"', escape='"', multiLine=True, columnNameOfCorruptRecord=files.CORRUPT
    ).csv(str(folder))
    got = files.read_csv(spark, str(folder), CONTRACT, multi_line=True, split_bytes=20_000, chunk_chars=3_000)
    assert rows_of(got.drop("_source_file")) == rows_of(wanted)
    assert got.where(F.col("_source_file").endswith("one.csv")).count() == got.count() == 4016
    chunks = split.write_chunks(spark, str(folder), CsvLines, 20_000, 3_000)
    places = chunks.groupBy("block").agg(F.count("*").alias("n")).collect()
    assert len(places) > 10 and max(r["n"] for r in places) > 3
    assert {r["state"] for r in split.start_states(chunks).collect()} == {0, 1}


def test_csv_header_must_match(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿a,b,c\n1,2,3\na,b,c\n")
    assert rows_of(files.read_csv(spark, str(tmp_path), CONTRACT, multi_line=True).select("a", "b")) == [("1", "2"), ("a", "b")]
    (tmp_path / "b.csv").write_text("a,c,b\n1,2,3\n")
    with pytest.raises(Exception, match="header differs"):
        files.read_csv(spark, str(tmp_path), CONTRACT, multi_line=True).collect()


def test_csv_unclosed_quote_and_empty(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,c\r\n1,"open\r\nline,3\r\n4,5,6\r\n')
    (tmp_path / "b.csv").write_text("a,b,c\r\n7,8,9\r\n")
    (tmp_path / "c.csv").write_text("")
    got = rows_of(files.read_csv(spark, str(tmp_path), CONTRACT, multi_line=True, split_bytes=8, chunk_chars=4).select("a", "b", "c"))
    assert ("7", "8", "9") in got and len(got) == 2 and any(r[0] == "1" and "5,6" in r[1] for r in got)


@pytest.mark.parametrize("indent", [None, 4])
def test_json_equals_one_task(spark, tmp_path, indent):
    rng = random.Random(5)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType()), T.StructField(
        "n", T.ArrayType(T.StructType([T.StructField("x", T.StringType())])))])
    for name, n in (("a", 3000), ("b", 1), ("empty", 0)):
        rows = [
            {"id": i, "t": rng.choice(FIELDS) * rng.randint(0, 30), "n": [{"x": rng.choice(['}"{', "[", "\\", "é"])}] * rng.randint(0, 3)}
            for i in range(n)
        ]
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    (tmp_path / "object.json").write_text(json.dumps({"id": -1, "t": "one"}, indent=indent))
    wanted = spark.read.schema(schema).options(multiLine=True).json(str(tmp_path))
    got = files.read_json_array(spark, str(tmp_path), schema, split_bytes=30_000, chunk_chars=5_000)
    assert rows_of(got.drop("_source_file")) == rows_of(wanted) and got.count() == 3002
    assert split.write_chunks(spark, str(tmp_path), JsonElements, 30_000, 5_000).select("file", "block").distinct().count() > 5


def test_json_damage_costs_only_the_damaged(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType())])
    (tmp_path / "cut.json").write_text('[{"a": 1}, {"a": 2}, 7, {"a": "x}')
    got = [r["a"] for r in files.read_json_array(spark, str(tmp_path), schema).collect()]
    assert sorted(x for x in got if x is not None) == [1, 2] and got.count(None) == 2


def test_contract_columns(spark, tmp_path):
    (tmp_path / "d.csv").write_text('DepartmentID,DepartmentName,FacilityName\n1,"a\nb",c\n')
    got = files.read_csv(spark, str(tmp_path), contracts.DEPARTMENTS, multi_line=True)
    assert got.columns == [*contracts.DEPARTMENTS.names, files.CORRUPT, "_source_file"]
    assert files.with_provenance(got, "EHR").first()["_source_file"].endswith("d.csv")


def test_a_task_reads_many_small_blocks(spark, tmp_path):
    """Hundreds of blocks in two files, which a bounded number of tasks write as chunks; the records are those of csv."""
    rng = random.Random(9)
    rows = [[rng.choice(FIELDS) for _ in range(3)] for _ in range(4000)]
    wanted = []
    for n, part in enumerate((rows[:2500], rows[2500:])):
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows([list("abc"), *part])
        (tmp_path / f"{n}.csv").write_text(out.getvalue(), newline="")
        wanted += part
    blocks = sum(-(-f.stat().st_size // 200) for f in tmp_path.glob("*.csv"))
    chunks = split.write_chunks(spark, str(tmp_path), CsvLines, 200, 100)
    assert blocks > 300 and chunks.select("file", "block").distinct().count() > 200
    assert len(chunks.inputFiles()) <= split.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    got = [next(csv.reader(io.StringIO(r.value, newline=""))) for r in split.records(chunks, CsvLines).where("NOT first").collect()]
    assert sorted(got) == sorted(wanted)
