"""Files whose records cross lines, read by many tasks each: CSV with line breaks in quotes, and JSON arrays.

Where a record ends depends on everything before it in the file, so a task that starts in the middle cannot know. It can
know what its stretch does to each state it may start in. Three steps:

1. *Chunks.* Tasks read their blocks of the files and write them as chunks of a few MB of text. With each chunk goes the map
   from the state at the start of its block to the state at its own start; the block's last chunk has the block's map.
2. *States.* The maps of a file's blocks, one small row each, are composed in the order of the blocks, which gives the state
   at every block's start.
3. *Records.* With its start state a chunk is cut into records on its own. What a chunk begins or ends in the middle of is a
   fragment; fragments, at most two per chunk, are joined in file order.

The chunks are written once to the shared scratch folder, so both later steps see the same blocks whatever the number of executors.
No step holds more than a chunk and the record that crosses it, or the maps of one file's blocks.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..session import scratch_path, share_package

SPLIT_BYTES = 128 << 20
CHUNK_CHARS = 4 << 20
# A task reads several blocks where they are smaller than this and there are more of them than this for every core.
TASK_BYTES = 32 << 20
TASKS_PER_CORE = 4

# Places of a piece of text: it ends a record from before, is one, or begins one.
ENDS, WHOLE, BEGINS = 0, 1, 2

_CHUNKS = "file string, block long, chunk int, value string, before array<long>, whole array<long>, base int"
_STATES = "file string, block long, state long, depth long, base int"
_PIECES = "file string, block long, chunk int, place int, value string, first boolean"


class CsvLines:
    """Lines of a CSV file with doubled quotes. State 1: inside quotes at the start of a line.

    A quote opens a quoted field only as the field's first character; behind a closing quote a field runs on to the
    next comma or line end. Elsewhere quotes are text.
    """

    separator = "\n"
    _open = re.compile(r'(?:\A|(?<=[,\n]))"')
    _close = re.compile(r'(?:[^"]|"")*+"')

    @classmethod
    def _quoted(cls, text: str, state: int) -> Iterator[tuple[int, int]]:
        """Stretches inside quotes; the last one ends beyond the text if it is not closed."""
        at, inside = 0, bool(state)
        while True:
            if not inside:
                found = cls._open.search(text, at)
                if found is None:
                    return
                at = found.end()
            start = at
            closed = cls._close.match(text, at)
            if closed is None:
                yield start, len(text) + 1
                return
            at, inside = closed.end(), False
            yield start, at

    @classmethod
    def after(cls, text: str, state: int) -> tuple[int, int]:
        """State behind a text of whole lines, and the change of depth (none)."""
        end = 0
        for _, end in cls._quoted(text, state):
            pass
        return int(end > len(text)), 0

    @classmethod
    def cut(cls, text: str, state: int, depth: int, base: int) -> Iterator[tuple[int, str]]:
        start, before, first = 0, 0, bool(state)
        spans = [s for s in cls._quoted(text, state) if "\n" in text[s[0] : s[1]]]
        for opened, closed in [*spans, (len(text), len(text))]:
            lines = text[before:opened].split("\n")
            if len(lines) > 1:
                yield (ENDS if first else WHOLE), text[start:before] + lines[0]
                first = False
                for line in lines[1:-1]:
                    yield WHOLE, line
                start = opened - len(lines[-1])
            before = min(closed, len(text))
        if start < len(text):
            yield (ENDS if first else BEGINS), text[start:]

    @staticmethod
    def base(text: str) -> int:
        return 0


class JsonElements:
    """The objects of one JSON array, or one object. State 1: inside a string; depth counts open brackets.

    Text is read up to each closing brace, so that it splits with or without line breaks. Elements that are no objects come
    out as records of their own, for the parser to refuse.
    """

    separator = "}"
    _string = re.compile(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)
    _rest = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)
    _token = re.compile(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"?|[{}\[\]]', re.S)
    _between = " \t\r\n,[]\ufeff"

    @classmethod
    def after(cls, text: str, state: int) -> tuple[int, int]:
        if state:
            rest = cls._rest.match(text)
            if rest is None:
                return 1, 0
            text = text[rest.end() :]
        plain = cls._string.sub("", text)
        # A quote that is left opens a string that does not close here. No text ends within an escape: it ends with a brace.
        opened = plain.find('"')
        if opened >= 0:
            plain = plain[:opened]
        return int(opened >= 0), plain.count("{") + plain.count("[") - plain.count("}") - plain.count("]")

    @classmethod
    def cut(cls, text: str, state: int, depth: int, base: int) -> Iterator[tuple[int, str]]:
        at = start = 0
        inside = depth > base or bool(state)
        place = ENDS if inside else WHOLE
        if state:
            rest = cls._rest.match(text)
            if rest is None:
                yield ENDS, text
                return
            at = rest.end()
        for token in cls._token.finditer(text, at):
            mark = token[0]
            if mark in "{[":
                if depth == base and (base or mark == "{"):
                    between = text[start : token.start()].strip(cls._between)
                    if between:
                        yield WHOLE, between
                    start, inside, place = token.start(), True, WHOLE
                depth += 1
            elif mark in "}]":
                # The last piece of a file is given a brace that is not in it.
                depth = max(depth - 1, 0)
                if inside and depth == base:
                    yield place, text[start : token.end()]
                    start, inside, place = token.end(), False, WHOLE
        if inside:
            yield (ENDS if place == ENDS else BEGINS), text[start:]
        else:
            between = text[start:].strip(cls._between + "}")
            if between:
                yield WHOLE, between

    @staticmethod
    def base(text: str) -> int:
        return int(text.lstrip(" \t\r\n\ufeff").startswith("["))


def _chain(first: list[int], second: list[int]) -> list[int]:
    """One map after the other. A map has the end state and the change of depth for start states 0 and 1."""
    out = []
    for s in (0, 1):
        state, depth = first[2 * s], first[2 * s + 1]
        out += [second[2 * state], depth + second[2 * state + 1]]
    return out


_SAME = [0, 0, 1, 0]


def write_chunks(
    spark: SparkSession, path: str | list[str], form: type, split_bytes: int = SPLIT_BYTES, chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """The files as chunks of whole lines (or stretches up to a closing brace), written."""
    share_package(spark)
    # A session of its own has the block size for this scan only.
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", str(min(split_bytes, 4 << 20)))
    lines = session.read.option("lineSep", form.separator).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, size, number, before = None, [], 0, 0, _SAME

        def chunk(last: bool) -> pa.RecordBatch:
            nonlocal held, size, number, before
            text = form.separator.join(held) + form.separator
            own = [x for s in (0, 1) for x in form.after(text, s)]
            after = _chain(before, own)
            row = pa.RecordBatch.from_pylist([{
                "file": place[0], "block": place[1], "chunk": number, "value": text, "before": before,
                "whole": after if last else None, "base": form.base(text) if place[1] == 0 and number == 0 else 0,
            }], schema=schema)
            held, size, number, before = [], 0, number + 1, after
            return row

        for batch in batches:
            values, files, blocks = (batch.column(i) for i in range(3))
            rest = batch.num_rows - 1
            turns = pc.or_(pc.not_equal(files[1:], files[:rest]), pc.not_equal(blocks[1:], blocks[:rest]))
            starts = [0, *(i + 1 for i in pc.indices_nonzero(turns).to_pylist()), batch.num_rows] if batch.num_rows else []
            for start, end in itertools.pairwise(starts):
                now = files[start].as_py(), blocks[start].as_py()
                if place != now:
                    if held:
                        yield chunk(True)
                    place, number, before = now, 0, _SAME
                for value in values[start:end].to_pylist():
                    if size >= chunk_chars:
                        yield chunk(False)
                    held.append(value)
                    size += len(value) + 1
        if held:
            yield chunk(True)

    schema = pa.schema([
        ("file", pa.string()), ("block", pa.int64()), ("chunk", pa.int32()), ("value", pa.string()),
        ("before", pa.list_(pa.int64())), ("whole", pa.list_(pa.int64())), ("base", pa.int32()),
    ])
    place = scratch_path(spark, "chunks")
    # Blocks may be far smaller than what a task is worth; those of a task come one after the other.
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length").alias("n")).first()["n"] or 0
    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    lines.coalesce(tasks).mapInArrow(run, _CHUNKS).write.parquet(place)
    return spark.read.schema(_CHUNKS).parquet(place)


def start_states(chunks: DataFrame) -> DataFrame:
    """(file, block, state, depth, base): the state at the start of each block."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["block", "whole", "base"]).to_pylist(), key=lambda r: r["block"])
        base = rows[0]["base"]
        out, now = [], [0, 0]
        for row in rows:
            out.append({"file": table.column("file")[0].as_py(), "block": row["block"], "state": now[0], "depth": now[1], "base": base})
            step = row["whole"]
            now = [step[2 * now[0]], now[1] + step[2 * now[0] + 1]]
        return pa.Table.from_pylist(out, schema=pa.schema([
            ("file", pa.string()), ("block", pa.int64()), ("state", pa.int64()), ("depth", pa.int64()), ("base", pa.int32()),
        ]))

    # A block has its map on the last chunk and the kind of its file on the first one.
    blocks = chunks.groupBy("file", "block").agg(
        F.max_by("whole", "chunk").alias("whole"), F.max("base").alias("base")
    )
    return blocks.groupBy("file").applyInArrow(lambda table: run(table), _STATES)


def records(chunks: DataFrame, form: type) -> DataFrame:
    """(file, value, first): every record with its file, and whether it is the first that is not blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                state, depth = row["before"][2 * row["state"]], row["depth"] + row["before"][2 * row["state"] + 1]
                found = list(form.cut(row["value"], state, depth, row["base"]))
                n, first = len(found), [False] * len(found)
                if row["block"] == 0 and row["chunk"] == 0:
                    first = [i == next((k for k, (_, v) in enumerate(found) if v.strip()), -1) for i in range(n)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["file"]] * n, pa.string()), pa.array([row["block"]] * n, pa.int64()),
                    pa.array([row["chunk"]] * n, pa.int32()), pa.array([p for p, _ in found], pa.int32()),
                    pa.array([v for _, v in found], pa.string()), pa.array(first, pa.bool_()),
                ], names=["file", "block", "chunk", "place", "value", "first"])

    known = chunks.select("file", "block", "chunk", "value", "before").join(start_states(chunks), ["file", "block"])
    pieces = known.mapInArrow(run, _PIECES)
    whole = pieces.where(F.col("place") == WHOLE).select("file", "value", "first")
    parts = pieces.where(F.col("place") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", "chunk", "place")
    begun = F.last(F.when(F.col("place") == BEGINS, F.struct("block", "chunk")), ignorenulls=True).over(order)
    joined = parts.withColumn("begun", begun).groupBy("file", "begun").agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("block", "chunk", "place", "value"))), lambda p: p["value"]
        ), "").alias("value"), F.max("first").alias("first"),
    ).select("file", "value", "first")
    return whole.unionByName(joined)


def read_csv_split(
    spark: SparkSession, path: str | list[str], contract: T.StructType, corrupt: str, split_bytes: int = SPLIT_BYTES,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """CSV with header whose quoted fields may hold line breaks; a file is read by as many tasks as it has blocks.

    Every column is text; rows with surplus or missing fields keep their text in ``corrupt``, as is ``_source_file``, the file a row
    comes from. A header that differs from the contract is an error. Empty lines between records are left out.
    """
    cut = records(write_chunks(spark, path, CsvLines, split_bytes, chunk_chars), CsvLines)
    text = F.regexp_replace(F.regexp_replace("value", "[\r\n]+$", ""), "^\ufeff", "")
    lines = cut.select("file", text.alias("value"), "first").where("value <> ''")
    wanted = ",".join(contract.names).lower()
    other = F.raise_error(F.concat(F.lit("header differs from the contract in "), "file")).cast("boolean")
    header = F.when(F.lower(F.replace("value", F.lit('"'), F.lit(""))) == wanted, False).otherwise(other)
    schema = ", ".join(f"`{name}` STRING" for name in [*contract.names, corrupt])
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    rows = lines.where(F.when(F.col("first"), header).otherwise(True))
    return rows.select(F.from_csv("value", schema, options).alias("row"), F.col("file").alias("_source_file")).select("row.*", "_source_file")


def read_json_split(
    spark: SparkSession, path: str | list[str], contract: T.StructType, split_bytes: int = SPLIT_BYTES, chunk_chars: int = CHUNK_CHARS,
    **options: str,
) -> DataFrame:
    """The objects of JSON array files (or files of one object), indented or in one line, and ``_source_file``.

    What is no object, or is cut off, gives a row of NULLs.
    """
    cut = records(write_chunks(spark, path, JsonElements, split_bytes, chunk_chars), JsonElements)
    row = F.from_json("value", contract, options)
    return cut.select(row.alias("row"), F.col("file").alias("_source_file")).select("row.*", "_source_file")
