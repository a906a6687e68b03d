"""Running state over the pieces of split files: whether a piece begins inside quotes, and counts that depend on it.

A file is read as pieces (lines, or what stands between brackets) by as many tasks as it has splits. What a piece does to
the state is known alone: it keeps it, turns it, or sets it. Inside a split a window runs over its pieces, for both states
the split may begin in; one row per split then carries state and counts from split to split of a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.session import scratch_path

SPLIT = ("file_path", "block_start")


def read_pieces(spark: SparkSession, paths: list[str] | str, separator: str) -> DataFrame:
    """(file_path, file_name, block_start, piece_id, value): what stands between separators. Ids grow within a split."""
    return spark.read.option("lineSep", separator).text(paths).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("piece_id"), "value",
    )


def stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read back, so that ids and splits stay what they are."""
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _state(turns: Column, pinned: Column, start: Column) -> Column:
    """0 outside and 1 inside: the last state that a piece has set, or the one at the start, and the turns since."""
    return F.pmod(turns + F.coalesce(pinned, start), F.lit(2)).cast("int")


def _with_turns(rows: DataFrame, by: tuple[str, ...], order: str) -> DataFrame:
    """Adds turns and pinned: of the rows before; turns_to and pinned_to: with the row itself. `to_0` and `to_1` say in which
    state a row ends when it begins in 0 or 1."""
    through = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = Window.partitionBy(*by).orderBy(order)
    turned = rows.withColumn("turns_to", F.sum(F.when((F.col("to_0") == 1) & (F.col("to_1") == 0), 1).otherwise(0)).over(through))
    sets = F.when(F.col("to_0") == F.col("to_1"), F.pmod(F.col("to_0") + F.col("turns_to"), F.lit(2)))
    turned = turned.withColumn("pinned_to", F.last(sets, ignorenulls=True).over(through))
    return turned.withColumns({"turns": F.coalesce(F.lag("turns_to").over(each), F.lit(0)), "pinned": F.lag("pinned_to").over(each)})


def running(pieces: DataFrame, to_0: Column, to_1: Column, counts: dict[str, tuple[Column, Column]]) -> DataFrame:
    """The pieces with `state` (0 outside, 1 inside, where the piece begins) and, per count, its sum from the beginning of
    the file through the piece; a count has one expression for pieces that begin outside and one for those inside.
    `pieces` hold numbers, and `quotes` (whether there is a quote in the text), never the texts: all of it is shuffled by
    split and written once."""
    spark = pieces.sparkSession
    through = Window.partitionBy(*SPLIT).orderBy("piece_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = _with_turns(pieces.withColumns({"to_0": to_0.cast("int"), "to_1": to_1.cast("int")}), SPLIT, "piece_id")
    if_0, if_1 = (_state(F.col("turns"), F.col("pinned"), F.lit(s)) for s in (0, 1))
    sums = {f"{n}_{s}": F.sum(F.when(at == 0, c[0]).otherwise(c[1])).over(through) for n, c in counts.items() for s, at in ((0, if_0), (1, if_1))}
    rows = stored(spark, rows.withColumns(sums).drop("to_0", "to_1"), "runs")

    ends = rows.groupBy(*SPLIT).agg(
        F.max_by(F.struct("turns_to", "pinned_to", *sums), "piece_id").alias("end"), F.bool_or("quotes").alias("quotes")
    )
    ends = ends.select(*SPLIT, "quotes", *[F.col(f"end.{c}").alias(c) for c in ("turns_to", "pinned_to", *sums)])
    splits = ends.select(
        *SPLIT, "quotes", *[_state(F.col("turns_to"), F.col("pinned_to"), F.lit(s)).alias(f"to_{s}") for s in (0, 1)], *sums
    )
    splits = _with_turns(splits, ("file_path",), "block_start").withColumn("start", _state(F.col("turns"), F.col("pinned"), F.lit(0)))
    # Without an end to the quotes the rest of the file would be gathered as one text.
    lost = (F.col("start") == 1) & ~F.col("quotes")
    message = F.concat(F.lit("a quoted text covers a whole split, a quote is not closed: "), F.col("file_path"))
    splits = splits.withColumn("start", F.when(lost, F.raise_error(message).cast("int")).otherwise(F.col("start")))
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        *SPLIT, "start",
        *[F.coalesce(F.sum(F.when(F.col("start") == 0, F.col(f"{n}_0")).otherwise(F.col(f"{n}_1"))).over(before), F.lit(0)).alias(f"{n}_before") for n in counts],
    )
    known = rows.join(starts, list(SPLIT))
    return known.select(
        *pieces.columns, _state(F.col("turns"), F.col("pinned"), F.col("start")).alias("state"),
        *[(F.col(f"{n}_before") + F.when(F.col("start") == 0, F.col(f"{n}_0")).otherwise(F.col(f"{n}_1"))).alias(n) for n in counts],
    )


def joined(pieces: DataFrame, keys: list[str], separator: str) -> DataFrame:
    """(keys, file_name, block_start, piece_id, value): the pieces that share the keys, in order, with the separator between
    them; split and id are those of the first."""
    ordered = F.array_sort(F.collect_list(F.struct("block_start", "piece_id", "value")))
    gathered = pieces.groupBy(*keys, "file_name").agg(ordered.alias("all"))
    return gathered.select(
        *keys, "file_name", F.col("all")[0]["block_start"].alias("block_start"), F.col("all")[0]["piece_id"].alias("piece_id"),
        F.array_join(F.transform("all", lambda p: p["value"]), separator).alias("value"),
    )


# Delimited text ---------------------------------------------------------------------------------------------

# A quote opens a field only where the field begins; elsewhere outside it is a plain character. Within a quoted field a
# doubled quote stands for one.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:"{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+'
OPENS = rf'^{_FIELDS}"{_QUOTED}$'
STAYS = rf'^{_QUOTED}$'
REOPENS = rf'^{_QUOTED}"[^,]*+,{_FIELDS}"{_QUOTED}$'


def opens_quotes(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside them."""
    return line.contains('"') & line.rlike(OPENS)


def stays_quoted(line: Column) -> Column:
    """Whether a line that begins inside quotes ends inside them."""
    return ~line.contains('"') | line.rlike(STAYS) | line.rlike(REOPENS)


def csv_records(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(file_path, file_name, record, value): the records of delimited files whose quoted fields may hold line breaks,
    numbered from 1 per file. Lines outside quotes that are blank are none. Lines are numbered without their texts and meet
    them once; only records of several lines are gathered."""
    lines = read_pieces(spark, paths, "\n").withColumn("value", F.regexp_replace("value", "^﻿", ""))
    value = F.col("value")
    tested = {
        "quotes": value.contains('"'), "filled": F.when(F.length(F.trim(F.regexp_replace("value", "\r$", ""))) > 0, 1).otherwise(0),
        "opens": opens_quotes(value), "stays": stays_quoted(value),
    }
    lines = stored(spark, lines.withColumns(tested), "lines")
    known = running(
        lines.select(*SPLIT, "piece_id", *tested), F.col("opens"), F.col("stays"), {"record": (F.col("filled"), F.lit(0))}
    )
    ends_inside = F.when(F.col("state") == 0, F.col("opens")).otherwise(F.col("stays"))
    known = known.filter((F.col("state") == 1) | (F.col("filled") == 1))
    known = known.select("piece_id", "record", ((F.col("state") == 0) & ~ends_inside).alias("whole"))
    found = lines.select("file_path", "file_name", "block_start", "piece_id", "value").join(known, "piece_id")
    one = found.filter("whole").select("file_path", "record", "file_name", "value")
    several = joined(found.filter("NOT whole"), ["file_path", "record"], "\n").select(*one.columns)
    return one.unionByName(several).withColumn("value", F.regexp_replace("value", "\r$", ""))


# Lists in JSON ----------------------------------------------------------------------------------------------

def json_entries(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, block_start, piece_id, value): the arrays in a JSON list of arrays, as text, with the split and the piece
    in which they begin. The file is read in the pieces between closing brackets, whatever its line breaks. Texts are written
    once; what tells the entries apart is worked out from numbers. An entry of one piece stays where it was read; the
    pieces of others are looked up by their ids and gathered."""
    # Backslashes stand in strings only, and a piece never ends behind half an escape.
    parts = F.split(F.regexp_replace("value", r"\\.", ""), '"')

    def opened(outside: int) -> Column:
        """Opening brackets in the parts that lie outside strings: every other one."""
        return F.aggregate(
            F.filter(parts, lambda p, i: F.pmod(i, F.lit(2)) == outside), F.lit(0).cast("long"),
            lambda n, p: n + F.length(p) - F.length(F.replace(p, F.lit("["), F.lit(""))),
        )

    tested = {
        "quotes": F.col("value").contains('"'), "odd": F.pmod(F.size(parts) - 1, F.lit(2)),
        "opened_0": opened(0), "opened_1": opened(1),
    }
    pieces = stored(spark, read_pieces(spark, path, "]").withColumns(tested), "pieces")
    # The piece ends with a closing bracket, which counts if it stands outside: for pieces begun outside, after an even
    # number of quotes.
    odd = F.col("odd")
    deeper = (F.col("opened_0") - (1 - odd), F.col("opened_1") - odd)
    known = running(pieces.select(*SPLIT, "piece_id", *tested), odd, F.lit(1) - odd, {"depth": deeper})
    closes = F.pmod(F.col("state") + odd, F.lit(2)) == 0
    ends = closes & (F.col("depth") == 1)
    # An entry of one piece begins outside strings, at the beginning of the file or where the entry before it ended.
    whole = ends & (F.col("state") == 0) & (F.col("depth") - deeper[0] <= 1)
    known = known.select(*SPLIT, "piece_id", "quotes", F.when(ends, 1).otherwise(0).alias("ends"), whole.alias("whole"))
    numbered = running(known, F.lit(0), F.lit(0), {"ended": (F.col("ends"), F.col("ends"))})
    numbered = numbered.withColumn("entry", F.col("ended") - F.col("ends"))
    # What stands behind the last entry closes the list.
    last = numbered.groupBy("file_path").agg(F.max("ended").alias("entries"))
    numbered = numbered.filter("NOT whole").join(last, "file_path")
    cut = stored(spark, numbered.select("piece_id", "entry", (F.col("entry") < F.col("entries")).alias("inside")), "cut")

    found = pieces.select("file_path", "file_name", "block_start", "piece_id", "value").join(cut, "piece_id", "left")
    one = found.filter(F.col("inside").isNull()).select("file_path", "block_start", "piece_id", "value")
    several = joined(found.filter("inside"), ["file_path", "entry"], "]").select("file_path", "block_start", "piece_id", "value")
    value = F.concat(F.regexp_replace("value", r"^\s*(?:\[(?=\s*\[)|,)?\s*", ""), F.lit("]"))
    return one.unionByName(several).withColumn("value", value)
