"""File drops: discovery, the file contract, the all-text scan with row lineage, routing."""

from __future__ import annotations

from collections.abc import Callable, Collection
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.sources import pieces
from strataflow.spec import ENTITIES, EntitySpec

BYTE_ORDER_MARK = "﻿"
FILE_ERROR, STAGING_ERROR, RAW_ERROR = "FILE_VALIDATION_ERROR", "STAGING_LOAD_ERROR", "RAW_LOAD_ERROR"


def discover_files(spark: SparkSession, folder: str) -> DataFrame:
    """Top-level `*.csv` files of a folder (suffix in any case), listed without reading their content.

    A scan skips files without bytes, so the names come from the file listing and the lengths from the scan.
    """
    scan = spark.read.format("binaryFile").option("pathGlobFilter", "*.[cC][sS][vV]").load(folder)
    listed = [(unquote(f), unquote(f).rsplit("/", 1)[-1]) for f in scan.inputFiles()]
    names = spark.createDataFrame(listed, "file_path string, file_name string")
    lengths = scan.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")
    return (
        names.join(lengths, "file_name", "left")
        .select("file_path", "file_name", F.coalesce("length", F.lit(0)).alias("length"))
        .orderBy("file_path")
    )


def identify_source(file_name: Column) -> Column:
    """Entity whose name pattern matches the whole file name; the first match wins, none gives NULL."""
    expr = None
    for spec in ENTITIES.values():
        hit = file_name.rlike(spec.file_pattern)
        expr = F.when(hit, spec.name) if expr is None else expr.when(hit, spec.name)
    return expr


def file_heads(spark: SparkSession, folder: str) -> DataFrame:
    """Header line, whether a data line follows, and whether a quoted field holds a line break, per file.

    Files are read as lines; the head is the first line of the first block and the tests are maxima, so the
    lines are reduced inside the scan tasks and one row per file travels on. As long as no line ends inside
    quotes every line begins outside them, so the first line that does is told apart by itself.
    """
    lines = (
        spark.read.option("pathGlobFilter", "*.[cC][sS][vV]")
        .text(folder)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("line_id"),
            F.regexp_replace("value", f"^{BYTE_ORDER_MARK}", "").alias("line"),
        )
        .filter(F.length(F.trim("line")) > 0)
    )
    position = F.struct("block_start", "line_id")
    return lines.groupBy("file_path").agg(
        F.min_by("line", position).alias("header"), (F.count(F.lit(1)) > 1).alias("has_data"),
        F.bool_or(pieces.opens_quotes(F.col("line"))).alias("breaks_lines"),
    )


def _names(columns) -> Column:
    return F.array(*[F.lit(c) for c in columns])


def check_files(files: DataFrame, heads: DataFrame) -> DataFrame:
    """File contract: (file, entity, is_valid, errors), with what the head of the file told.

    A bad name or an empty file ends the check; otherwise column and data errors are all reported. Column
    order is free and optional columns may be absent.
    """
    # Both sides name the same files; the scan reports URL-escaped paths, so the name is the key here.
    told = [c for c in heads.columns if c != "file_path"]
    named = heads.select(F.element_at(F.split("file_path", "/"), -1).alias("head_name"), *told)
    df = files.withColumn("entity", identify_source(F.col("file_name"))).join(
        named, F.col("file_name") == F.col("head_name"), "left"
    )
    actual = F.transform(
        F.split(F.coalesce("header", F.lit("")), ","), lambda c: F.regexp_replace(F.trim(c), '^"|"$', "")
    )
    required, expected = None, None
    for spec in ENTITIES.values():
        mine = F.col("entity") == spec.name
        need, know = _names(spec.required), _names(spec.columns)
        required = F.when(mine, need) if required is None else required.when(mine, need)
        expected = F.when(mine, know) if expected is None else expected.when(mine, know)
    missing = F.array_except(required, actual)
    unexpected = F.array_except(actual, expected)

    def listed(prefix: str, names: Column) -> Column:
        return F.when(F.size(names) > 0, F.concat(F.lit(prefix), F.array_join(names, ", ")))

    empty = (F.col("length") == 0) | F.col("header").isNull()
    errors = (
        F.when(F.col("entity").isNull(), F.array(F.concat(F.lit("Invalid filename: "), F.col("file_name"))))
        .when(F.col("length") == 0, F.array(F.lit("File is empty")))
        .when(empty, F.array(F.lit("Unable to read CSV: no header line")))
        .otherwise(
            F.array_compact(
                F.array(
                    listed("Missing required columns: ", missing),
                    listed("Unexpected columns: ", unexpected),
                    F.when(~F.col("has_data"), "CSV file contains no data rows"),
                )
            )
        )
    )
    return df.select(
        "file_path", "file_name", "entity", errors.alias("errors"), *told,
    ).withColumn("is_valid", F.size("errors") == 0)


def validation_summary(checked: DataFrame) -> DataFrame:
    return checked.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if("is_valid").alias("valid_files"),
        F.count_if(~F.col("is_valid")).alias("invalid_files"),
    )


def file_errors(checked: DataFrame, batch_id: int, at: Column | None = None) -> DataFrame:
    """One error row per rejected file."""
    return checked.filter(~F.col("is_valid")).select(
        F.lit(batch_id).cast("long").alias("batch_id"),
        F.col("file_name").alias("source_file_name"),
        F.lit(None).cast("long").alias("source_row_number"),
        F.coalesce("entity", F.lit("UNKNOWN")).alias("table_name"),
        F.lit(None).cast("string").alias("gate_id"),
        F.lit(None).cast("string").alias("column_name"),
        F.lit(FILE_ERROR).alias("error_type"),
        F.array_join("errors", "; ").alias("error_message"),
        F.lit(None).cast("string").alias("raw_value"),
        (at if at is not None else F.localtimestamp()).alias("error_timestamp"),
    )


def load_error(spark: SparkSession, batch_id: int, entity: str, kind: str, message: str, at: Column) -> DataFrame:
    """The error row of an entity whose staging or raw load failed."""
    nothing = F.lit(None).cast("string")
    return spark.range(1).select(
        F.lit(batch_id).cast("long").alias("batch_id"), nothing.alias("source_file_name"),
        F.lit(None).cast("long").alias("source_row_number"), F.lit(entity).alias("table_name"), nothing.alias("gate_id"),
        nothing.alias("column_name"), F.lit(kind).alias("error_type"), F.lit(message).alias("error_message"),
        nothing.alias("raw_value"), at.alias("error_timestamp"),
    )


def month_folder(file_name: Column) -> Column:
    """`YYYY_MM` from the date in the file name, else `general`."""
    stamp = F.regexp_extract(file_name, r"([0-9]{4})([0-9]{2})[0-9]{2}", 0)
    return F.when(F.length(stamp) == 0, "general").otherwise(
        F.concat_ws("_", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2))
    )


def route_files(checked: DataFrame, batch_id: int) -> DataFrame:
    """Manifest of where each file belongs: processed or rejected, month folder, name with the batch."""
    stem = F.regexp_replace("file_name", r"[.][^.]*$", "")
    suffix = F.regexp_extract("file_name", r"[.][^.]*$", 0)
    return checked.select(
        "file_path", "file_name", "entity",
        F.when(F.col("is_valid"), "processed").otherwise("rejected").alias("route"),
        month_folder(F.col("file_name")).alias("month_folder"),
        F.concat(stem, F.lit(f"_batch{batch_id}"), suffix).alias("target_name"),
    )


def outcome_of() -> Column:
    return (
        F.when(F.col("total_files") == 0, "NO_FILES").when(F.col("invalid_files") > 0, "FAILED").otherwise("LOAD_RAW")
    )


def ingestion_outcome(checked: DataFrame) -> DataFrame:
    """Any bad file fails the batch and the raw load is skipped; a batch without files does nothing."""
    return validation_summary(checked).withColumn("outcome", outcome_of())


def staged_batches(staged: dict[str, DataFrame]) -> DataFrame:
    """Batches that at least one staged table holds, with the number of entities and rows."""
    out = None
    for entity, df in staged.items():
        part = df.groupBy("batch_id").agg(F.count(F.lit(1)).alias("staged_rows"))
        part = part.withColumn("entity", F.lit(entity))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("entities"), F.sum("staged_rows").alias("staged_rows")
    )


#: Of the delimited text: fields in quotes, a doubled quote inside them for one.
CSV = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def scan_lines(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """All-text scan of files that share a column order and hold one record per line, with file name, split and
    position in the split. Files are split and read in parallel."""
    rows = (
        spark.read.schema(_text_schema(columns)).options(**CSV)
        .option("header", True).option("encoding", "UTF-8").option("enforceSchema", False).csv(paths)
    )
    # The reader turns empty fields into NULL; a column that is in the file keeps them as empty text.
    return rows.select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in columns],
        F.col("_metadata.file_name").alias("source_file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("scan_id"),
    )


def scan_records(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """The same scan of files whose quoted fields may hold line breaks: split all the same, see `pieces`. Records are
    numbered per file already, so each file counts as one split."""
    found = pieces.csv_records(spark, paths).filter(F.col("record") > 1)
    fields = F.from_csv("value", _text_schema(columns).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), CSV)
    return found.select("file_name", "record", fields.alias("f")).select(
        *[F.coalesce(f"f.{c}", F.lit("")).alias(c) for c in columns],
        F.col("file_name").alias("source_file_name"), F.lit(0).cast("long").alias("block_start"),
        F.col("record").alias("scan_id"),
    )


def scan_text(spark: SparkSession, paths: list[str], columns: list[str], breaking: Collection[str] | None = None) -> DataFrame:
    """All-text scan of files that share a column order. `breaking` names those of them whose quoted fields hold line
    breaks, and may name other files; None stands for all of them."""
    broken = [p for p in paths if breaking is None or p in breaking]
    plain = [p for p in paths if p not in broken]
    parts = [scan_lines(spark, plain, columns)] if plain else []
    parts += [scan_records(spark, broken, columns)] if broken else []
    return reduce(DataFrame.unionByName, parts)


def number_rows(scanned: DataFrame, first: int = 2) -> DataFrame:
    """Dense row numbers per file, starting below the header line.

    Rows of one block come out of one task in file order, so the position inside a block is the scan id less
    the block's first scan id. Blocks get their start from a running sum over block counts, which is one row
    per block. No row is shuffled or sorted for its number, and no window ever holds a whole file.
    """
    blocks = scanned.groupBy("source_file_name", "block_start").agg(
        F.min("scan_id").alias("first_id"), F.count(F.lit(1)).alias("block_rows")
    )
    before = Window.partitionBy("source_file_name").orderBy("block_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = blocks.select(
        "source_file_name", "block_start", "first_id",
        F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("rows_before"),
    )
    number = F.col("rows_before") + (F.col("scan_id") - F.col("first_id")) + first
    return (
        scanned.join(starts, ["source_file_name", "block_start"])
        .withColumn("source_row_number", number.cast("long"))
        .drop("block_start", "scan_id", "first_id", "rows_before")
    )


def fill_columns(df: DataFrame, spec: EntitySpec, lineage: tuple[str, ...]) -> DataFrame:
    """Contract column order; absent optional columns become NULL."""
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in spec.columns], *lineage
    )


def land_entity(
    spark: SparkSession, spec: EntitySpec, headers: dict[str, tuple[str, ...]], batch_id: int,
    at: Column | None = None, breaking: Collection[str] | None = None,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The raw rows of one entity in a batch.

    `headers` maps each file to its column order. Files that share an order are scanned together, so the
    number of scans is the number of distinct header lines. `store` writes the scanned rows to the stage and
    reads them back; then they are numbered from what is stored, and no second scan has to split files alike.
    `breaking` names files with line breaks inside quotes, where that is known.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, columns in headers.items():
        groups.setdefault(columns, []).append(path)
    scanned = [
        fill_columns(scan_text(spark, sorted(paths), list(columns), breaking), spec, ("source_file_name", "block_start", "scan_id"))
        for columns, paths in groups.items()
    ]
    staged = reduce(DataFrame.unionByName, scanned)
    numbered = number_rows(staged if store is None else store(staged))
    stamped = numbered.withColumns(
        {
            "batch_id": F.lit(batch_id).cast("long"),
            "load_timestamp": at if at is not None else F.localtimestamp(),
        }
    )
    return fill_columns(stamped, spec, ("batch_id", "source_file_name", "source_row_number", "load_timestamp"))


def headers_of(checked: DataFrame, entity: str) -> dict[str, tuple[str, ...]]:
    """Column order of each valid file of an entity. One short row per file comes to the driver."""
    rows = checked.filter(F.col("is_valid") & (F.col("entity") == entity)).select("file_path", "header").collect()
    return {r.file_path: tuple(c.strip().strip('"') for c in r.header.split(",")) for r in rows}


def breaking_files(checked: DataFrame) -> set[str]:
    """Files with line breaks inside quotes."""
    return {r.file_path for r in checked.filter("is_valid AND breaks_lines").select("file_path").collect()}
