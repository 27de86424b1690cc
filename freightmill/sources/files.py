"""Raw CSV and JSON feeds, read by contract and stamped with their origin."""

from __future__ import annotations

import csv
import hashlib
from collections import Counter
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.contracts import FEEDS, TELEMATICS, Contract
from freightmill.functions.temporal import civil_date, civil_datetime
from freightmill.sources.json_records import array_records, line_records

SOURCE_FILE = "_source_file"
UNREADABLE = "_unreadable_columns"
CORRUPT = "_corrupt_record"
FLAW = "_flaw"
EXTRA = "_extra"
LANDING = "_landing"


def _typed(raw: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DateType):
        return civil_date(raw)
    if isinstance(dtype, T.TimestampNTZType):
        return civil_datetime(raw)
    return raw.try_cast(dtype)


def conform(raw: DataFrame, contract: Contract) -> DataFrame:
    """Cast a text frame to its contract by column name.

    Columns the contract does not know are kept as they came, missing ones become
    NULL, and a value that cannot be cast becomes NULL with its column listed in
    ``_unreadable_columns``.
    """
    present = set(raw.columns)
    typed, lost = [], []
    for a in contract.attributes:
        if a.name not in present:
            typed.append(F.lit(None).cast(a.dtype).alias(a.name))
            continue
        value = _typed(F.col(a.name), a.dtype)
        typed.append(value.alias(a.name))
        if not isinstance(a.dtype, T.StringType):
            lost.append(F.when(F.col(a.name).isNotNull() & value.isNull(), F.lit(a.name)))
    extra = [F.col(c) for c in raw.columns if c not in contract.columns]
    report = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
    return raw.select(*typed, *extra, report.alias(UNREADABLE))


def _with_source_file(raw: DataFrame) -> DataFrame:
    return raw.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def _blank_feed(spark: SparkSession) -> DataFrame:
    """What a feed without a single line reads as."""
    fields = [T.StructField(c, T.StringType()) for c in (CORRUPT, SOURCE_FILE)]
    return spark.createDataFrame([], T.StructType(fields))


def _column_names(header: str) -> tuple[list[str], bool]:
    """Names of a header line, and whether they stand in it as they are.

    A name that is missing or repeated gets its place for a name, as Spark's reader does it.
    """
    names = next(csv.reader([header]), [])
    seen = Counter(n.lower() for n in names)
    own = [
        f"_c{k}" if not n else f"{n}{k}" if seen[n.lower()] > 1 else n for k, n in enumerate(names)
    ]
    return own, own == names


def _first_lines(
    spark: SparkSession, path: str | list[str], check_quotes: bool
) -> dict[str, list[str]]:
    """Header line -> the files that begin with it, from one pass over the feed's lines.

    The pass leaves one row for each file, whose names the driver needs to read it anyway.
    With ``check_quotes`` a line with an odd number of quotes fails: read line by line, it
    would lose text.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            # Lines of one split come in their order, and splits name their first byte.
            F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"),
        )
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    written = F.when(F.col("value").rlike(r"\S"), F.col("at"))
    report = lines.groupBy("file").agg(
        F.min_by("value", written).alias("header"),
        F.max(F.when(quotes % 2 == 1, F.col("value"))).alias("odd"),
    )
    files: dict[str, list[str]] = {}
    for row in sorted(report.collect(), key=lambda r: r["file"]):
        if check_quotes and row["odd"] is not None:
            raise ValueError(
                "a quoted value goes on in the next line, use multi_line: "
                f"{row['odd']!r} in {row['file']}"
            )
        if row["header"] is not None:
            header = row["header"].removeprefix("\ufeff").rstrip("\r")
            # The file's name comes as a URI, and readers take plain paths.
            files.setdefault(header, []).append(unquote(row["file"]))
    return files


def _csv_text(spark: SparkSession, header: str, files: list[str], multi_line: bool) -> DataFrame:
    """Files that share one header, as text columns and the lines that do not fit it."""
    names, plain = _column_names(header)
    columns = [T.StructField(c, T.StringType()) for c in (*names, CORRUPT)]
    options = {
        "header": True, "quote": '"', "escape": '"', "multiLine": multi_line,
        "enforceSchema": not plain, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
        "columnPruning": False,
    }
    return _with_source_file(spark.read.options(**options).schema(T.StructType(columns)).csv(files))


def read_csv_text(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = False,
    check_quotes: bool = True,
) -> DataFrame:
    """A header CSV file, a list or a folder with any number of them, as text matched by column name.

    Quotes follow RFC 4180: a quote inside quotes is doubled. ``multi_line`` allows line breaks
    in quoted values (not in the header), at the price of files that cannot be split; without it
    such a file is refused (``check_quotes``). Rows with too few or too many fields come back
    with their text in ``_corrupt_record``. Headers may differ from file to file: one pass reads
    the files' first lines, and files with the same one are read together.
    """
    if not spark.read.option("recursiveFileLookup", True).text(path).inputFiles():
        raise FileNotFoundError(f"no file in {path}")
    groups = _first_lines(spark, path, check_quotes and not multi_line)
    frames = [_csv_text(spark, header, same, multi_line) for header, same in groups.items()]
    if not frames:
        return _blank_feed(spark)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def parse_json_text(
    raw: DataFrame, contract: Contract, array_document: bool = False
) -> DataFrame:
    """Records in ``value``: the contract's columns, other fields in the map ``_extra``, and the
    columns of ``raw`` besides ``value``.

    Whatever is no single object with fields named once comes back with its text in
    ``_corrupt_record`` and the reason in ``_flaw``, so nothing of the text is lost.
    """
    records = array_records(raw) if array_document else line_records(raw)
    known = F.array(*[F.lit(c) for c in contract.columns])
    return records.select(
        *[F.col("record")[c].alias(c) for c in contract.columns],
        F.map_filter("record", lambda k, _: ~F.array_contains(known, k)).alias(EXTRA),
        F.col("flawed_text").alias(CORRUPT),
        F.col("flaw").alias(FLAW),
        *[c for c in raw.columns if c != "value"],
    )


def read_json_text(
    spark: SparkSession, path: str | list[str], contract: Contract, array_document: bool = False
) -> DataFrame:
    """A JSON feed as text, see ``parse_json_text``.

    One record per line, which Spark can split. ``array_document`` reads files that each hold
    one JSON array; such a file is a single task, so land large feeds as lines.
    """
    raw = _with_source_file(spark.read.text(path, wholetext=array_document))
    return parse_json_text(raw, contract, array_document)


def read_csv_feed(
    spark: SparkSession, path: str, contract: Contract, multi_line: bool = False
) -> DataFrame:
    """Header CSV, typed. Types come from the contract, so there is no inference pass."""
    return conform(read_csv_text(spark, path, multi_line), contract)


def read_json_feed(
    spark: SparkSession, path: str, contract: Contract, array_document: bool = False
) -> DataFrame:
    """JSON feed, typed by contract."""
    return conform(read_json_text(spark, path, contract, array_document), contract)


def with_origin(feed: DataFrame, source_system: str) -> DataFrame:
    """Audit columns of a feed: which system it came from and when it was loaded."""
    return feed.withColumns(
        {"_ingested_at": F.current_timestamp(), "_source_system": F.lit(source_system)}
    )


def feed_path(raw_dir: str, name: str) -> str:
    return f"{raw_dir}/{name}.json" if FEEDS[name] is TELEMATICS else f"{raw_dir}/{name}.csv"


def landing_id(spark: SparkSession, path: str) -> str:
    """Name of what landed at ``path``: a digest of its files, their sizes and their times.

    One job over the listing; no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    marks = files.select(F.xxhash64("path", "length", "modificationTime").alias("mark"))
    n, total = marks.agg(F.count("*"), F.sum(F.col("mark").cast("decimal(38,0)"))).first()
    return hashlib.sha256(f"{n} {total}".encode()).hexdigest()[:16]


def read_landing(
    spark: SparkSession, raw_dir: str, array_document: bool = True, multi_line: bool = False
) -> dict[str, DataFrame]:
    """The five feeds of a landing folder as they came, in text, and stamped: Bronze.

    ``_landing`` names the files that a row landed with, so that the same files landed again are
    the same landing.
    """
    frames = {}
    for name, contract in FEEDS.items():
        path = feed_path(raw_dir, name)
        if contract is TELEMATICS:
            feed = read_json_text(spark, path, contract, array_document)
        else:
            feed = read_csv_text(spark, path, multi_line)
        landed = feed.withColumn(LANDING, F.lit(landing_id(spark, path)))
        frames[name] = with_origin(landed, contract.source_system)
    return frames
