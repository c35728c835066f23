"""The three file feeds under ``<root>/matchid=<n>/<file>``, batch or streaming.

``matchid`` comes from the ``matchid=<n>`` directory of the file's path. CSV
columns are bound by the names in each file's own header line, in any order:
absent ones are NULL, and values are cast to the contract types. Values that do
not fit, and those of unknown columns, can be kept in a ``rescued`` map. Each row
carries its file path as ``source_file``, the run id as ``Batchid`` and the load time.

Lines are parsed by Spark's own CSV parser. The contract is one file per match, so a
CSV file is read as one value and split at its line ends in the plan; its size is that of a match.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from pitchlake import constants as K
from pitchlake import schemas
from pitchlake.session import NO_CHECKSUM_FILES, compiled, in_few_tasks, listing


def _bronze(df: DataFrame, columns: tuple[str, ...], run_id: str) -> DataFrame:
    return df.select(
        F.lit(run_id).alias("Batchid"),
        *columns,
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("load_timestamp"),
    )


def _reader(spark: SparkSession, streaming: bool, max_files: int | None,
            archive_dir: str | None = None) -> DataFrameReader | DataStreamReader:
    """Batch or streaming reader.

    ``max_files`` bounds each micro-batch of a large backlog. ``archive_dir``
    moves every processed file there after its batch commits, so the listing
    each trigger performs stays proportional to the files not yet ingested
    (one file per match adds up to millions of files over the years).
    """
    if streaming:
        r = spark.readStream
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        if archive_dir:
            r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
        return r
    return spark.read


#: Most columns a CSV file may have; a wider header fails the read rather than losing columns.
MAX_COLUMNS = 64


def _columns(line: Column, escape: str | None) -> Column:
    """The texts of a CSV line's fields, MAX_COLUMNS of them (NULL where empty or absent), by Spark's CSV parser.

    A quote within quotes is escaped by ``escape``. None tells the two usual ways apart line by line: a backslash (what
    Spark writes), or, in lines without one, a doubled quote.
    """
    names = [f"c{i}" for i in range(MAX_COLUMNS)]
    schema = ", ".join(f"{c} string" for c in names)
    parse = lambda by: F.from_csv(line, F.lit(schema), {"escape": by})
    row = F.when(line.contains("\\"), parse("\\")).otherwise(parse('"')) if escape is None else parse(escape)
    return row


def _as_array(row: str) -> Column:
    return F.array(*[F.col(f"{row}.c{i}") for i in range(MAX_COLUMNS)])


def _named(head: Column) -> Column:
    """Number of columns up to the last one with a name."""
    return F.array_max(F.transform(head, lambda h, i: F.when(h != "", i + 1).otherwise(F.lit(0))))


def _lacks(head: Column, line: Column) -> Column:
    """Columns that a line under this header is short of MAX_COLUMNS."""
    return F.when(line.startswith("\0"), F.lit(0)).otherwise(F.lit(MAX_COLUMNS) - _named(head))  # the parser may skip such a line


def _whole(line: Column, lacks: Column) -> Column:
    """The line after as many empty columns as it lacks.

    Spark's parser raises an error inside for each column that is missing at the end, which took most of its time. It begins every
    column in the same state, so empty ones in front change nothing in how the others are read.
    """
    return F.concat(F.repeat(F.lit(","), lacks), line)


def matchid_of(path: Column) -> Column:
    """Match id of the ``matchid=<n>`` directory in a file path; NULL when absent or not a number."""
    return F.regexp_extract(path, r"matchid=([^/]+)/[^/]*$", 1).try_cast("bigint")


def _with_header(files_: DataFrame, escape: str | None) -> DataFrame:
    """(path, head, lines) of CSV files given as (value, path): column names in lower case, and all lines."""
    lines = F.split(F.regexp_replace("value", "^\\uFEFF", ""), r"\r\n|\n|\r")
    first = F.element_at("lines", 1)
    wide = F.length(first) - F.length(F.replace(first, F.lit(","))) >= MAX_COLUMNS
    checked = F.when(wide, F.raise_error(F.concat(F.lit(f"more than {MAX_COLUMNS} columns in the header of "), "path"))).otherwise(first)
    split = files_.select("path", lines.alias("lines")).select("path", "lines", checked.cast("string").alias("first"))
    named = split.select("path", "lines", _columns(F.col("first"), escape).alias("row")).select("path", "lines", _as_array("row").alias("names"))
    return named.select("path", "lines", F.transform("names", lambda x: F.lower(F.trim(F.coalesce(x, F.lit(""))))).alias("head"))


def by_header(files_: DataFrame, schema: T.StructType, escape: str | None = None) -> DataFrame:
    """Rows of CSV files given as (value, path): one column per schema field, matched by header name.

    Names are compared without case and surrounding blanks; of two columns of one name the first counts.
    ``rescued`` maps the names of values that found no place to their texts: those that do not fit their
    column's type (NULL there), and those of columns outside the schema; NULL when there are none.
    """
    data = [f for f in schema.fields if f.name != "matchid"]
    known = F.array(*[F.lit(f.name.lower()) for f in data])
    rows = _with_header(files_, escape).select(
        "path", "head",
        F.explode(F.expr("filter(slice(lines, 2, greatest(size(lines) - 1, 0)), l -> l <> '')")).alias("line"),
    )
    rows = rows.withColumn("lacks", _lacks(F.col("head"), F.col("line")))
    rows = rows.select("path", "head", "lacks", _columns(_whole(F.col("line"), F.col("lacks")), escape).alias("row")).select(
        "path", "head", F.slice(_as_array("row"), F.col("lacks") + 1, F.lit(MAX_COLUMNS)).alias("fields"))
    raw = lambda f: F.try_element_at("fields", F.nullif(F.array_position("head", f.name.lower()), F.lit(0)).cast("int"))
    rows = rows.select("path", "head", "fields", *[raw(f).alias(f"raw_{f.name}") for f in data])
    value = lambda f: F.col(f"raw_{f.name}").try_cast(f.dataType)
    entry = lambda name, text, keep: F.when(keep & text.isNotNull(), F.struct(name.alias("name"), text.alias("text")))
    misfits = F.array(*[entry(F.lit(f.name), F.col(f"raw_{f.name}"), value(f).isNull()) for f in data])
    named = F.zip_with("head", "fields", lambda h, x: F.struct(h.alias("h"), x.alias("x")))
    others = F.transform(named, lambda c, i: entry(
        c["h"], c["x"], (c["h"] != "") & ~F.array_contains(known, c["h"]) & (F.array_position("head", c["h"]) == i + 1)))
    left_over = F.filter(F.concat(misfits, others), lambda e: e.isNotNull())
    return rows.select(
        *[value(f).alias(f.name) for f in data],
        matchid_of(F.col("path")).alias("matchid"), F.col("path").alias("source_file"),
        F.when(F.size(left_over) > 0, F.map_from_entries(left_over)).alias("rescued"),
    )


def _csv_files(spark: SparkSession, root: str, streaming: bool, file_name: str, max_files: int | None, archive_dir: str | None,
               skip_copies: bool = False) -> DataFrame:
    """(value, path) of CSV files; with ``skip_copies`` the first of a match's files of equal content only.

    On a stream the digests of all files are kept in its state, one row a file, so content that
    is delivered again under another name, in the same run or a later one, adds nothing.
    """
    with listing(spark):
        raw = (_reader(spark, streaming, max_files, archive_dir).schema("value string").option("wholetext", True)
               .option("pathGlobFilter", file_name).format("text").load(root))
    raw = in_few_tasks(raw.select("value", F.col("_metadata.file_path").alias("path")))
    if skip_copies:
        keyed = raw.withColumns({"match": matchid_of(F.col("path")), "digest": F.sha2("value", 256)})
        raw = keyed.dropDuplicates(["match", "digest"]).select("value", "path")
    return raw


def _csv(spark: SparkSession, root: str, schema: T.StructType, columns: tuple[str, ...], run_id: str, streaming: bool, file_name: str,
         max_files: int | None, archive_dir: str | None, escape: str | None, rescued: bool, skip_copies: bool) -> DataFrame:
    rows = by_header(_csv_files(spark, root, streaming, file_name, max_files, archive_dir, skip_copies), schema, escape)
    return rows.select(F.lit(run_id).alias("Batchid"), *columns, "source_file", F.current_timestamp().alias("load_timestamp"),
                       *(["rescued"] if rescued else []))


def headers(spark: SparkSession, root: str, feed: str, *, streaming: bool = True, file_name: str, run_id: str = K.DEFAULT_RUN_ID,
            max_files: int | None = None, escape: str | None = None) -> DataFrame:
    """(Batchid, feed, columns, source_file, load_timestamp) of every CSV file: its column names in order, joined by commas.

    De-duplicated by (feed, columns) it is the history of the feed's layouts.
    """
    found = _with_header(_csv_files(spark, root, streaming, file_name, max_files, None), escape)
    return found.select(
        F.lit(run_id).alias("Batchid"), F.lit(feed).alias("feed"), F.array_join(F.slice("head", 1, _named(F.col("head"))), ",").alias("columns"),
        F.col("path").alias("source_file"), F.current_timestamp().alias("load_timestamp"),
    )


def events(spark: SparkSession, root: str, *, streaming: bool = True, file_name: str = K.EVENTS_FILE,
           run_id: str = K.DEFAULT_RUN_ID, max_files: int | None = None, archive_dir: str | None = None,
           escape: str | None = None, rescued: bool = False, skip_copies: bool = False) -> DataFrame:
    return _csv(spark, root, schemas.EVENTS_FILE_SCHEMA, schemas.BRONZE_EVENTS_COLUMNS, run_id, streaming,
                file_name, max_files, archive_dir, escape, rescued, skip_copies)


def metadata(spark: SparkSession, root: str, *, streaming: bool = True, file_name: str = K.METADATA_FILE,
             run_id: str = K.DEFAULT_RUN_ID, max_files: int | None = None, archive_dir: str | None = None,
             multi_line: bool = False) -> DataFrame:
    """One JSON record per line by default; ``multi_line`` reads one (pretty-printed) object per file."""
    with listing(spark):
        df = (_reader(spark, streaming, max_files, archive_dir).schema(schemas.METADATA_FILE_SCHEMA)
              .option("pathGlobFilter", file_name).option("multiLine", multi_line).json(root))
    return in_few_tasks(_bronze(df, schemas.BRONZE_METADATA_COLUMNS, run_id))


def players(spark: SparkSession, root: str, *, streaming: bool = True, file_name: str = K.PLAYERS_FILE,
            run_id: str = K.DEFAULT_RUN_ID, max_files: int | None = None, archive_dir: str | None = None,
           escape: str | None = None, rescued: bool = False, skip_copies: bool = False) -> DataFrame:
    return _csv(spark, root, schemas.PLAYERS_FILE_SCHEMA, schemas.BRONZE_PLAYERS_COLUMNS, run_id, streaming,
                file_name, max_files, archive_dir, escape, rescued, skip_copies)


def _mounted(spark: SparkSession, root: str) -> str | None:
    """Path of a folder of a file system that is mounted (scheme ``file``); None elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _file_writer(root: str, write_id: str, suffix: str, head: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes one file a match from (matchid, line) rows that come match by match; a file gets its name when it is whole.

    A repeated task writes the same names again. The inner function travels to the workers by value, so they need not have
    this package.
    """
    no_match = NO_MATCH

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{write_id}.{suffix}"
        match, out = None, None

        def done() -> None:
            if out is not None:
                out.close()
                os.replace(out.name, os.path.join(os.path.dirname(out.name), name))

        for batch in batches:
            if not batch.num_rows:
                continue
            lines = batch.column("line").cast(pa.large_binary())
            at, text = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:], memoryview(lines.buffers()[2])
            matches, first = pc.run_end_encode(batch.column("matchid")), 0
            for m, end in zip(matches.values.to_pylist(), matches.run_ends.to_pylist()):
                if out is None or m != match:
                    done()
                    folder = os.path.join(root, f"matchid={no_match if m is None else m}")
                    os.makedirs(folder, exist_ok=True)
                    match, out = m, open(os.path.join(folder, f".{name}-{task.taskAttemptId()}"), "wb")
                    out.write(head)
                out.write(text[at[first]:at[end]])
                first = end
        done()
        yield from ()

    return write


#: What Spark's writers call the folder of rows without a match.
NO_MATCH = "__HIVE_DEFAULT_PARTITION__"
_WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def write_feed(df: DataFrame, root: str, fmt: str, mode: str = "overwrite", sort_by: tuple[str, ...] = ()) -> None:
    """Writes a feed in the ``matchid=<n>/`` layout, one file per match directory.

    Used to stage fixture feeds; files are named as Spark names them (``part-*``), so read
    them back with ``file_name="part-*"``. On a mounted file system the lines that Spark makes are written to
    plain files: Hadoop sets a new file's permissions by a process of its own there, which took longer than all the rest.
    """
    if fmt not in ("csv", "json"):
        raise ValueError(f"unsupported feed format {fmt!r}")
    spark = df.sparkSession
    # a file takes far longer than its few bytes: without a number, adaptive execution would leave all files to a few tasks
    df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "matchid")
    df = df.sortWithinPartitions("matchid", *sort_by)  # with sort_by, the same rows give the same file
    place = _mounted(spark, root)
    if place is None or not isinstance(df.schema["matchid"].dataType, _WHOLE_NUMBERS):
        writer = df.write.mode(mode).options(**NO_CHECKSUM_FILES).partitionBy("matchid")
        with compiled(spark):
            writer.option("header", True).csv(root) if fmt == "csv" else writer.json(root)
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if mode == "overwrite":
        fs.delete(path, True)
    fs.mkdirs(path)  # an empty feed is an empty folder
    names = [c for c in df.columns if c != "matchid"]
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    head = ""
    if fmt == "csv":
        head = spark.range(1).select(F.to_csv(F.struct(*[F.lit(c) for c in names]))).first()[0] + "\n"
    line = F.coalesce(F.to_csv(row) if fmt == "csv" else F.to_json(row), F.lit(""))
    write = _file_writer(place, uuid.uuid4().hex, fmt, head.encode())
    with compiled(spark):
        (df.select(F.col("matchid").cast("long").alias("matchid"), F.concat(line, F.lit("\n")).alias("line"))
         .mapInArrow(write, "matchid long").write.format("noop").mode("overwrite").save())


def source_dir(source_file_col: str = "source_file"):
    """The ``matchid=<n>`` directory of a source file path."""
    return F.regexp_extract(F.col(source_file_col), r"(matchid=[^/]+)/[^/]*$", 1)
