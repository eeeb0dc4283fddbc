"""Readers. Raw files are read as text against a declared schema; numbers are made afterwards."""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.functions.columns import null_if_token, to_number

# Columns of a raw listings file, in file order.
RAW_COLUMNS = (
    "Unnamed: 0", "brand", "model", "color", "registration_date", "year", "price_in_euro", "power_kw",
    "power_ps", "transmission_type", "fuel_type", "fuel_consumption_l_100km", "fuel_consumption_g_km",
    "mileage_in_km", "offer_description",
)
NUMBERS = ("price_in_euro", "power_ps", "year", "mileage_in_km")


def text_schema(columns=RAW_COLUMNS) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


@dataclass(frozen=True)
class Scan:
    """A read of raw files: `kept` rows by column name, `quarantined` records as (file, reason, raw)."""

    kept: DataFrame
    quarantined: DataFrame


#: What stands between two quotes, doubled quotes included.
_QUOTED = '"([^"]|"")*"'


#: Complete fields at the beginning of a line that begins outside quotes, each with its comma; a quote opens a field only at its
#: beginning, and what follows a closing quote up to the comma still belongs to the field.
_FIELDS = r'^(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+)?+,)*+'
#: A field, or the rest of one, that is not closed on its line.
_OPEN_FIELD, _OPEN_REST = r'^"(?:[^"]++|"")*+\z', r'^(?:[^"]++|"")*+\z'
#: The rest of a quoted field that an earlier line began, to its comma.
_REST = r'^(?:[^"]++|"")*+"[^,]*+,?+'


def _lines(spark: SparkSession, path) -> DataFrame:
    """(file, block, at, value) of every line, whatever stands before its line feed: where its split of the file begins, and a
    number that grows within the split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def _layouts(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """(file, header, form) of every file, from one pass over its lines.

    A line break inside quotes leaves its line with an odd number of quotes. Files without such a line, `lines`, are split at
    line breaks like any text; in the others, `quoted`, a split can begin inside a record, see `_records`; they are `returned` if
    the first line ends with a carriage return too. Such a file with carriage returns inside its lines can't be split and is
    read by one task: `whole`. The driver gets a row for each file, as it does to plan any scan.
    """
    uneven = lambda x: (F.length(x) - F.length(F.replace(x, F.lit('"'), F.lit("")))) % 2 == 1
    returns = F.contains("value", F.lit("\r"))
    odd = F.when(returns, F.exists(F.split("value", "\r"), uneven)).otherwise(uneven(F.col("value")))
    head = F.when((F.col("block") == 0) & (F.translate("value", "\r", "") != ""), F.col("at"))
    found = _lines(spark, path).groupBy("file").agg(
        F.min_by("value", head).alias("header"), F.max(odd).alias("quoted"),
        F.max(F.when(returns, F.rlike("value", F.lit(r"\r(?!\z)")))).alias("inside"),
        F.min_by(F.endswith("value", F.lit("\r")), F.when(F.col("block") == 0, F.col("at"))).alias("returned"))
    first = lambda line: next(x for x in line.split("\r") if x)
    form = lambda r: "lines" if not r.quoted else "whole" if r.inside else "returned" if r.returned else "quoted"
    return [(r.file, first(r.header), form(r)) for r in found.orderBy("file").collect() if r.header is not None]


def _records(spark: SparkSession, files: list[str], returned: bool) -> DataFrame:
    """(_file, _text) of every record but the headers and empty lines, in files with line breaks inside quotes; `returned`: lines
    end with a carriage return.

    Whether a line begins inside quotes follows from the lines before it. A line either settles what it ends in, or keeps what it
    began with, or turns it round. So each split of a file is worked through by itself, a row for each split says what
    it does to its beginning, and these rows in order give every split its beginning. Then records are the lines from one
    that begins outside quotes to the next, and only the pieces at the ends of splits come from two of them.
    """
    opens = lambda text: F.regexp_replace(text, _FIELDS, "").rlike(_OPEN_FIELD)
    quoted = F.contains("value", F.lit('"'))
    after_out = quoted & opens(F.col("value"))
    after_in = ~quoted | F.col("value").rlike(_OPEN_REST) | opens(F.regexp_replace("value", _REST, ""))
    in_split, of_split = Window.partitionBy("file", "block"), Window.partitionBy("file", "block").orderBy("at")
    of_file = Window.partitionBy("file").orderBy("block")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    end = "\r" if returned else ""
    # Turns are counted; what a line settles is kept as it would have been at the beginning, without the turns since.
    turned = _lines(spark, files).withColumns({"_out": after_out.cast("int"), "_in": after_in.cast("int")}).withColumn(
        "_turns", F.sum(((F.col("_out") == 1) & (F.col("_in") == 0)).cast("int")).over(of_split)).withColumn(
        "_settled", F.when(F.col("_out") == F.col("_in"), (F.col("_out") + F.col("_turns")) % 2)).withColumns({
            "_turns_before": F.coalesce(F.lag("_turns").over(of_split), F.lit(0)),
            "_settled_before": F.last("_settled", ignorenulls=True).over(before(of_split)),
            "_first": F.min(F.when(~F.col("value").isin("", end), F.col("at"))).over(in_split)})
    turned = turned.withColumn("_odd", (F.coalesce("_settled_before", F.lit(0)) + F.col("_turns_before")) % 2)
    # Where nothing is settled yet, a line begins a record under one beginning of the split or under the other.
    splits = turned.groupBy("file", "block").agg(
        F.max("_turns").alias("turns"), F.max_by("_settled", F.when(F.col("_settled").isNotNull(), F.col("at"))).alias("settled"),
        F.min("_first").alias("first"),
        *[F.sum((F.when(F.col("_settled_before").isNull(), (F.col("_odd") + k) % 2).otherwise(F.col("_odd")) == 0).cast("int")).alias(f"records_{k}")
          for k in (0, 1)])
    splits = splits.withColumn("all_turns", F.sum("turns").over(of_file)).withColumns({
        "turns_before": F.col("all_turns") - F.col("turns"), "settles": (F.col("settled") + F.col("turns") + F.col("all_turns")) % 2})
    splits = splits.withColumn("begins", (F.coalesce(F.last("settles", ignorenulls=True).over(before(of_file)), F.lit(0)) + F.col("turns_before")) % 2)
    splits = splits.withColumn("records", F.when(F.col("begins") == 0, F.col("records_0")).otherwise(F.col("records_1"))).withColumns({
        # The record that goes on at the beginning of a split is the last one of an earlier split.
        "home": F.last(F.when(F.col("records") > 0, F.struct("block", F.col("records").alias("record"))), ignorenulls=True).over(before(of_file)),
        "header": F.min(F.when(F.col("first").isNotNull(), F.struct("block", F.col("first").alias("at")))).over(Window.partitionBy("file"))})
    begun = turned.join(splits.select("file", "block", "begins", "home", "header"), ["file", "block"]).withColumn(
        "_odd", F.when(F.col("_settled_before").isNull(), (F.col("_odd") + F.col("begins")) % 2).otherwise(F.col("_odd")))
    placed = begun.withColumn("record", F.sum((F.col("_odd") == 0).cast("int")).over(of_split)).withColumn(
        "_of", F.when(F.col("record") == 0, F.col("home")).otherwise(F.struct("block", "record")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), "\n")
    whole = placed.groupBy("file", "_of").agg(
        F.regexp_replace(text, rf"{end}\z", "").alias("_text"), F.bool_or((F.col("block") == F.col("header.block")) & (F.col("at") == F.col("header.at"))).alias("_header"))
    return whole.where("NOT _header AND _text != ''").select(F.col("file").alias("_file"), "_text")


def scan_records(spark: SparkSession, path: str, columns=RAW_COLUMNS) -> Scan:
    """Raw CSV files as text, columns by the names in each file's own header, in whatever order it has them.

    A record with fewer fields than the header has missing values at its end. A record with more fields, or with a quote
    that is never closed, is not guessed at: it goes to `quarantined` with its raw text. Quoted line breaks, separators and
    doubled quotes belong to their field. Every record is in one of the two tables. Columns that were not asked for
    are left out. A missing path, and a header that lacks a wanted column or repeats one, fail when the plan is built; files
    without a line hold no record.
    """
    groups: dict[tuple[tuple[str, ...], str], list[str]] = {}
    for file, header, form in _layouts(spark, path):
        names = tuple(next(csv.reader([header.removeprefix("\ufeff")])))
        missing, repeated = [c for c in columns if c not in names], [c for c in columns if names.count(c) > 1]
        if missing or repeated:
            raise ValueError(f"{file}: columns missing {missing}, repeated {repeated}")
        groups.setdefault((names, form), []).append(file)
    parts = [spark.createDataFrame([], text_schema([*columns, "_file", "_raw", "_reason"]))]
    for (names, form), files in sorted(groups.items()):
        places = [f"_{i}" for i in range(len(names))]
        schema, options = text_schema([*places, "_raw"]), {
            "multiLine": form != "lines", "escape": '"', "maxCharsPerColumn": -1, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw"}
        if form in ("quoted", "returned"):
            texts = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}
            fields = ", ".join(f"`{c}` string" for c in schema.names)
            # Spark's readers of files make a plain line break of one with a carriage return.
            said = F.replace("_text", F.lit("\r\n"), F.lit("\n")) if form == "returned" else F.col("_text")
            rows = _records(spark, files, form == "returned").select("_file", "_text", F.from_csv(said, fields, texts).alias("_r")).select(
                "_file", *[f"_r.{c}" for c in places], F.when(F.col("_r._raw").isNotNull(), F.col("_text")).alias("_raw"))
        else:
            # Without column pruning a record is parsed as a whole, whichever columns are asked for in the end.
            rows = spark.read.schema(schema).options(header=True, enforceSchema=True, columnPruning=False, **options).csv(files).withColumn(
                "_file", F.col("_metadata.file_path"))
        given = F.size(F.split(F.regexp_replace("_raw", _QUOTED, ""), ",", -1))
        quotes = F.length("_raw") - F.length(F.replace("_raw", F.lit('"'), F.lit("")))
        # Most records parse; naming a field here also lets Spark count the wrong ones without reading the others.
        reason = F.when(F.col("_raw").isNull() & F.col(places[0]).isNull(), F.lit(None)) \
            .when(quotes % 2 == 1, F.lit("unclosed quote")).when(given > len(names), F.lit("too many fields"))
        parts.append(rows.select(*[F.col(places[names.index(c)]).alias(c) for c in columns], "_file",
                                 F.when(reason.isNotNull(), F.col("_raw")).alias("_raw"), reason.alias("_reason")))
    records = reduce(DataFrame.unionByName, parts)
    kept = records.where("_reason IS NULL").select([null_if_token(F.col(f"`{c}`")).alias(c) for c in columns])
    return Scan(kept, records.where("_reason IS NOT NULL").select(
        F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_raw").alias("raw")))


def scan_audit(scan: Scan) -> DataFrame:
    """Records read, kept and quarantined, one row for each reason that occurred."""
    kept = scan.kept.agg(F.count(F.lit(1)).alias("kept"))
    wrong = scan.quarantined.groupBy("reason").agg(F.count(F.lit(1)).alias("records"))
    return wrong.select("reason", "records").unionByName(kept.select(F.lit("kept").alias("reason"), F.col("kept").alias("records"))) \
        .withColumn("read", F.sum("records").over(Window.partitionBy(F.lit(1))))


def scan_listings(spark: SparkSession, path: str, columns=RAW_COLUMNS, fmt: str = "csv") -> DataFrame:
    """Raw listings as text. A missing path fails when the plan is built. Of CSV files only the records that parse; those
    that do not are in `scan_records(...).quarantined`."""
    if fmt == "csv":
        return scan_records(spark, path, columns).kept
    raw = spark.read.schema(text_schema(columns)).format(fmt).load(path)
    return raw.select([null_if_token(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def coerce_numeric(df: DataFrame, columns=NUMBERS) -> DataFrame:
    """Text columns to doubles, unreadable values to NULL."""
    return df.withColumns({c: to_number(F.col(c)) for c in columns if c in df.columns})
