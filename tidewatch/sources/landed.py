"""Landed JSON in any mix of files: one record a line, or records over several lines, or one array a file of any size.

The form is found per file, by its first line. Files with a record per line
are left to Spark's reader, which splits them at line ends. A file that begins
with ``[``, or with a line that is ``{`` alone, has no such place: a line end
can be anywhere, or nowhere in 10 GB. It is cut into its records in two passes
over byte ranges.

Spark's text reader, told that lines end with ``}``, deals each file's byte
ranges out to tasks. Whether such a ``}`` ends a record depends on all that
came before: the depth of braces and whether it stands in a string. Pass one
finds for each range, for both cases of its start (inside a string or not),
how its end stands to its start. A range begins after a ``}``, so never inside
an escape. Composing these few rows along each file gives every range its true
start. Pass two then cuts the records; the pieces of a record that crosses
ranges, two a range at most, are put together by file.

A record is an object that is not inside another one. Its text is parsed with
the given schema; what cannot be parsed is kept as ``_corrupt_record``, as for
records by line. Text after an array's last record is not looked at.

Text goes to Python in pieces of bounded length and is put together there, one
fragment or record at a time, so a batch of rows is bounded in bytes too,
however long the records are; what Python gives back is bounded likewise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, materialise

CORRUPT = "_corrupt_record"

# What changes the state inside a string, and outside of one.
_IN = re.compile(r'\\.|"', re.S)
_OUT = re.compile(r'["{]')
_MOVED = "byte ranges differ between the two passes"
_BLANK = "\ufeff \t\r\n"
PIECE_CHARS = 2048  # of a row that goes to Python
SLICE_ROWS = 500  # of a batch that are Python objects at a time
BATCH_CHARS, BATCH_ROWS = 4_000_000, 5000  # of what Python gives back at a time

_RANGES = "file string, start long, cut boolean, out_in boolean, out_depth long, in_in boolean, in_depth long"
_PIECES = "file string, start long, part int, opens boolean, text string"


def _fragments(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The files' text up to each ``}``, with the file and the byte range it was read from."""
    return spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _pieces(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the column ``text`` last, cut into pieces that follow each other, and whether a piece ends its text."""
    cut = F.when(F.length(text) > PIECE_CHARS, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0))).otherwise(F.array(text))
    others = [c for c in df.columns if c != text]
    dealt = df.select(*others, cut.alias("_p")).select(*others, F.size("_p").alias("_n"), F.posexplode_outer("_p").alias("_i", text))
    return dealt.select(*others, text, (F.col("_i") == F.col("_n") - 1).alias("last"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of ``_pieces`` with their whole texts, one at a time."""
    held = []
    for batch in batches:
        for at in range(0, len(batch), SLICE_ROWS):
            for *others, piece, last in zip(*(c.to_pylist() for c in batch.slice(at, SLICE_ROWS).columns)):
                held.append(piece)
                if last:
                    text, held = held[0] if len(held) == 1 else "".join(held), []
                    yield (*others, text)


def _walk(text: str, inside: bool) -> tuple[bool, list[int]]:
    """(inside a string at the end, places of the braces that open) of a fragment that begins ``inside`` or not."""
    at, opens = 0, []
    while True:
        found = (_IN if inside else _OUT).search(text, at)
        if found is None:
            return inside, opens
        at = found.end()
        if found[0] == '"':
            inside = not inside
        elif found[0] == "{":
            opens.append(found.start())


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """(file, start, fragments) of each byte range; a range's rows follow each other."""
    for (file, start), group in groupby(_joined(batches), lambda r: r[:2]):
        yield file, start, (v for _, _, v in group)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range, from a start outside and inside of a string: where its end stands, and the change of depth."""
    for file, start, fragments in _by_range(batches):
        begin, state = "", [[False, 0], [True, 0]]
        for text in fragments:
            begin = begin or text.lstrip(_BLANK)[:4096]
            for s in state:
                s[0], opens = _walk(text, s[0])
                s[1] += len(opens) - (not s[0])
        cut = begin[:1] == "[" or begin[:1] == "{" and "\n" in begin and not begin[1:begin.index("\n")].strip()
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((file, start, cut, *state[0], *state[1]), _schema(_RANGES))],
                                         schema=_schema(_RANGES))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _starts(ranges: DataFrame) -> DataFrame:
    """(file, start, inside, depth): the true state at the start of each range of the files to cut.

    One row a range; a file's ranges are folded in order, in one array that is
    as long as the file has ranges.
    """
    first = F.struct(F.lit(False).alias("inside"), F.lit(0).cast("long").alias("depth"))
    step = lambda s, r: F.struct(
        F.when(s["inside"], r["in_in"]).otherwise(r["out_in"]).alias("inside"),
        F.greatest(F.lit(0).cast("long"), s["depth"] + F.when(s["inside"], r["in_depth"]).otherwise(r["out_depth"])).alias("depth"))
    rows = ranges.groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct("start", "cut", "out_in", "out_depth", "in_in", "in_depth"))).alias("r")).where(F.col("r")[0]["cut"])
    before = F.aggregate("r", F.array(first), lambda acc, r: F.concat(acc, F.array(step(F.element_at(acc, -1), r))))
    return rows.select("file", F.inline(F.arrays_zip(F.col("r.start").alias("start"), F.slice(before, F.lit(1), F.size("r")).alias("state")))).select(
        "file", "start", "state.inside", "state.depth")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records (part 0) and the pieces of those that cross ranges (part 1 ends one, part 2 begins one or goes on)."""
    for (file, start), group in groupby(_joined(batches), lambda r: r[:2]):
        out, chars, held, depth, inside, whole = [], 0, [], None, False, True
        for _, _, was_inside, was_depth, text in group:
            if depth is None:
                depth, inside = was_depth, was_inside
                whole = depth == 0
            inside, opens = _walk(text, inside)
            if depth:
                held.append(text)
            elif opens:
                held.append(text[opens[0]:])
            depth += len(opens)
            if inside:
                if depth:
                    held.append("}")
                continue
            if depth:
                held.append("}")
                depth -= 1
                if depth == 0:
                    out.append((file, start, 0 if whole else 1, whole, "".join(held)))
                    held, whole, chars = [], True, chars + len(out[-1][-1])
            if len(out) >= BATCH_ROWS or chars >= BATCH_CHARS:
                yield _rows(out)
                out, chars = [], 0
        if depth:
            out.append((file, start, 2, whole, "".join(held)))
        if out:
            yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _schema(_PIECES))], schema=_schema(_PIECES))


def cut_records(spark: SparkSession, files: list[str], ranges: DataFrame) -> DataFrame:
    """``text`` of every record of the files that must be cut, of ``files``; ``ranges`` as from ``_summed`` over the same files."""
    starts, n = materialise(_starts(ranges), "json-starts", counted=True)
    fragments = _fragments(spark, files).withColumn("n", F.monotonically_increasing_id())
    if n <= DEFAULT_MAX_BROADCAST_ROWS:  # a row per range: tens of TB of arrays; the fragments keep their order
        cut_files, starts = F.broadcast(starts.select("file").distinct()), F.broadcast(starts)
    else:
        cut_files = starts.select("file").distinct()
    fragments = fragments.join(cut_files, "file").join(starts, ["file", "start"], "left")
    if n > DEFAULT_MAX_BROADCAST_ROWS:
        fragments = fragments.repartition("file", "start").sortWithinPartitions("file", "start", "n")
    fragments = fragments.withColumn("depth", F.coalesce("depth", F.raise_error(F.lit(_MOVED)).cast("long")))
    # Stored once: the records and the pieces are two reads of the same cuts.
    cut = materialise(_pieces(fragments.select("file", "start", "inside", "depth", "value"), "value").mapInArrow(_cut, _PIECES), "json-records")
    in_order = Window.partitionBy("file").orderBy("start", "part")
    pieces = cut.where("part > 0").withColumn("record", F.sum(F.col("opens").cast("int")).over(in_order))
    joined = pieces.groupBy("file", "record").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("start", "part", "text"))), lambda p: p["text"]), "").alias("text"))
    return cut.where("part = 0").select("text").unionByName(joined.select("text"))


def read_landed_json(spark: SparkSession, path: str | list[str], schema: T.StructType, with_corrupt: bool = False,
                     again: int = 3) -> DataFrame:
    """Records of all JSON files under ``path``, whichever form each has, with an explicit schema.

    How Spark cuts files into ranges depends on the executors it has. If that
    changed between the passes (a range without a state), they are run again.
    """
    # Both passes read one list of files, so that files which land meanwhile change no range.
    files = [unquote(f) for f in spark.read.option("recursiveFileLookup", "true").text(path).inputFiles()]
    ranges = materialise(_pieces(_fragments(spark, files), "value").mapInArrow(_summed, _RANGES), "json-ranges") if files else spark.createDataFrame([], _RANGES)
    forms = ranges.groupBy("file").agg(F.min_by("cut", "start").alias("cut")).collect()  # a row per file
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = [unquote(r.file) for r in forms if not r.cut]
    out = spark.read.schema(full).option("columnNameOfCorruptRecord", CORRUPT).json(lines) if lines else spark.createDataFrame([], full)
    if len(lines) < len(forms):
        try:
            texts = cut_records(spark, files, ranges)
        except Exception as e:
            if _MOVED not in str(e) or again < 1:
                raise
            return read_landed_json(spark, files, schema, with_corrupt, again - 1)
        parsed = texts.select(F.from_json("text", full, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}).alias("r")).select("r.*")
        out = out.unionByName(parsed)
    return out if with_corrupt else out.drop(CORRUPT)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """Append files that each hold one JSON array, one per task."""
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, out, chars = "[", [], 0
        for (text,) in _joined(batches):
            out.append(before + text)
            before, chars = ",", chars + len(text)
            if len(out) >= BATCH_ROWS or chars >= BATCH_CHARS:
                yield pa.RecordBatch.from_pydict({"value": out})
                out, chars = [], 0
        yield pa.RecordBatch.from_pydict({"value": [*out, "[]" if before == "[" else "]"]})

    records = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    _pieces(records, "value").mapInArrow(lines, "value string").write.mode("append").option("lineSep", "\n").text(path)
