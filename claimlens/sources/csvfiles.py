"""CSV files by their headers, with file-order positions and no sort.

A CSV file is read as lines, which Spark can split. A first pass counts the records
of every file split, keeps each file's header line and sees whether a quote stays
open at a line's end; prefix sums over that table (one row a split) say how many
records lie before each split. The second pass parses the lines, picks the columns
by name with the file's own header, and adds its split's offset to a row's place in
the split: positions cost a broadcast join with the table of splits, no exchange.

A file in which a quote stays open at the end of a line has records of several
lines. Such a file can't be cut at line ends; it is read by one task.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.operators.stats import bounded_broadcast
from claimlens.session import stored

# ---------------------------------------------------------------------------
# The tokens pandas' CSV reader treats as missing by default.
PANDAS_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null")
# ---------------------------------------------------------------------------

#: A quote inside a quoted value is doubled; a backslash is an ordinary character.
OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "nullValue": "\u0000", "emptyValue": "",
           "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
SPLIT = ["source_ord", "_file", "_start", "_part"]


def header_names(line: str) -> list[str]:
    """Column names of a header line: a repeated name gets ``.1``, ``.2``; an empty
    one is ``Unnamed: k``; a byte order mark is no part of the first."""
    out: list[str] = []
    for k, name in enumerate(next(csv.reader([line.removeprefix("﻿")]), [])):
        name, n = name or f"Unnamed: {k}", 0
        own = name
        while own in out:
            n += 1
            own = f"{name}.{n}"
        out.append(own)
    return out


def _marked(df: DataFrame, k: int) -> DataFrame:
    """Rows with their source, file, split, partition and place in the partition."""
    return df.withColumns({
        "source_ord": F.lit(k), "_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start"),
        "_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})


def _lines(spark: SparkSession, paths, k: int) -> DataFrame:
    """Lines that hold anything; the place counts these alone."""
    own = spark.read.text(paths).select("value", "_metadata").where(F.length("value") > 0)
    return _marked(own, k).drop("_metadata")


def _counted(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.groupBy(*SPLIT).agg(F.count("*").alias("n"), F.min("_place").alias("_first"), *more)


def _tokens(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])


def records(spark: SparkSession, sources: list) -> tuple[DataFrame, dict[str, list]]:
    """The records of CSV files, and where to find a column in them.

    ``sources``: paths (a file, a folder or a list of them), in order; within a source files
    come by name. Returns rows (source_ord, row_index, _layout, _t), ``_t`` the values as text by
    place and ``_layout`` the number of the file's header, and for every column name
    [(layout, place)]. ``row_index`` counts the records of all sources from 0."""
    lines = [_lines(spark, paths, k) for k, paths in enumerate(sources)]
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    # with a set among them the aggregates are hashed by split; a line alone would have all lines sorted
    seen = stored(reduce(DataFrame.unionByName, [_counted(
        own, F.array_contains(F.collect_set(quotes % 2), 1).alias("_open"), F.min_by("value", "_place").alias("_line")) for own in lines]), "splits")
    files = seen.groupBy("source_ord", "_file").agg(F.max("_open").alias("_open"), F.min_by("_line", "_start").alias("_line"))
    # one row a file and one number a distinct header: as many as files were named or listed
    heads = [r["_line"] for r in files.select("_line").distinct().orderBy("_line").collect()]
    names = [header_names(h) for h in heads]
    width = max((len(n) for n in names), default=1)
    layout = spark.createDataFrame(list(enumerate(heads)), "_layout int, _line string")
    files = files.join(F.broadcast(layout), "_line").drop("_line")

    whole: dict[int, list] = {}
    for r in files.where("_open").orderBy("source_ord", "_file").collect():
        whole.setdefault(r["source_ord"], []).append(r["_file"])
    parsed = [own.select(*SPLIT, "_place", F.from_csv("value", _tokens(width).simpleString(), OPTIONS).alias("_t"), F.lit(False).alias("_open")) for own in lines]
    counts = seen.where("not _open").select(*SPLIT, "n", "_first", "_open")
    # a split without an open quote of a file that has one elsewhere is not read as lines either
    counts = counts.join(bounded_broadcast(files.where("_open").select("source_ord", "_file")), ["source_ord", "_file"], "left_anti")
    for k, own_files in whole.items():
        own = spark.read.schema(_tokens(width)).options(**OPTIONS).option("multiLine", True).csv(own_files)
        own = _marked(own.select("_metadata", F.struct(*[f"_c{i}" for i in range(width)]).alias("_t")), k).drop("_metadata").withColumn("_open", F.lit(True))
        parsed.append(own.select(*SPLIT, "_place", "_t", "_open"))
        counts = counts.unionByName(stored(_counted(own), "records").withColumn("_open", F.lit(True)).select(*counts.columns))

    head = (F.col("_start") == 0).cast("int")
    before = Window.orderBy("source_ord", "_file", "_start").rowsBetween(Window.unboundedPreceding, -1)  # one row a split
    splits = counts.join(bounded_broadcast(files.drop("_open")), ["source_ord", "_file"]) \
        .withColumn("_before", F.coalesce(F.sum(F.col("n") - head).over(before), F.lit(0)))
    splits = stored(splits, "offsets")
    rows = reduce(DataFrame.unionByName, parsed).join(bounded_broadcast(splits.drop("n")), [*SPLIT, "_open"])
    place = F.col("_place") - F.col("_first")
    rows = rows.where((F.col("_start") > 0) | (place > 0)).select(
        "source_ord", (F.col("_before") + place - head).cast("long").alias("row_index"), "_layout", "_t")
    where: dict[str, list] = {}
    for i, own in enumerate(names):
        for j, name in enumerate(own):
            where.setdefault(name, []).append((i, j))
    return rows, where


def column(where: list) -> Column:
    """The value of a column as text, by the row's own header; null where that lacks it."""
    by_place: dict[int, list] = {}
    for layout, place in where:
        by_place.setdefault(place, []).append(layout)
    out = F.lit(None).cast("string")
    for place, layouts in by_place.items():
        out = F.when(F.col("_layout").isin(layouts), F.col("_t")[f"_c{place}"]).otherwise(out)
    return F.when(~out.isin(*PANDAS_NA_TOKENS), out)


def typed(text: Column, kind: T.DataType) -> Column:
    """Text as ``kind``: a value that is none becomes NULL, never an error."""
    if isinstance(kind, T.StringType):
        return text
    value = F.trim(text).try_cast(kind)
    # other spellings of NaN are missing too
    return F.when(~F.isnan(value), value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def inferred(rows: DataFrame, columns: dict[str, Column]) -> dict[str, T.DataType]:
    """Types by all values, as pandas infers them: whole numbers (double where some are
    missing), numbers, true/false, else text; a column without a value is double. One aggregate."""
    if not columns:
        return {}
    aggs = []
    for i, c in enumerate(columns.values()):
        t = F.trim(c)
        aggs += [F.count_if(c.isNull()).alias(f"m{i}"), F.count_if(c.isNotNull() & ~t.rlike(r"^[+-]?[0-9]{1,18}$")).alias(f"i{i}"),
                 F.count_if(c.isNotNull() & t.try_cast("double").isNull()).alias(f"d{i}"),
                 F.count_if(~c.isin("True", "TRUE", "true", "False", "FALSE", "false")).alias(f"b{i}"), F.count(c).alias(f"n{i}")]
    r = rows.agg(*aggs).first()

    def kind(i):
        if not r[f"i{i}"] and not r[f"m{i}"] and r[f"n{i}"]:
            return T.LongType()
        if not r[f"d{i}"]:
            return T.DoubleType()
        return T.BooleanType() if not r[f"b{i}"] and not r[f"m{i}"] else T.StringType()
    return {name: kind(i) for i, name in enumerate(columns)}


def read_sources(spark: SparkSession, sources: list, schema: T.StructType | None) -> DataFrame:
    """The columns of ``schema`` by name, then those the headers have beyond it, by the
    header that names them first, with inferred types; ``source_ord`` and ``row_index`` besides.
    A column that a file lacks is NULL there. Without a schema all columns are inferred.
    An empty file has no records."""
    rows, where = records(spark, sources)
    known = {f.name: f.dataType for f in schema.fields} if schema else {}
    texts = {name: column(where.get(name, [])) for name in [*known, *[n for n in where if n not in known]]}
    kinds = known | inferred(rows, {n: c for n, c in texts.items() if n not in known})
    return rows.select(*[typed(c, kinds[n]).alias(n) for n, c in texts.items()], "source_ord", "row_index")
