"""Vendor CSV files: listing, schema discovery, tolerant reading.

A path carries exchange, stage and day, either as the vendor lays it out
(``.../TRTH/{EX}/{stage}/{date}/data/merged/{EX}-{date}-...csv.gz``) or as a
partitioned folder (``exchange={EX}/processing_stage={stage}/data_date={date}``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwell.dimensions import stage_dim
from tickwell.functions.scalar import base_name, first_date
from tickwell.sources.tables import schema_frame

CORRUPT = "_corrupt_record"

# Vendor header -> type.
VENDOR_TYPES = {
    "#RIC": "string", "Date-Time": "timestamp_ntz", "Type": "string", "Price": "double",
    "Volume": "bigint", "Exch Time": "string", "Qualifiers": "string",
}
# Columns every load adds.
LINEAGE = {
    "data_date": "date", "exchange": "string", "processing_stage": "string",
    "source_file": "string", "ingestion_timestamp": "timestamp",
}


# Columns of a listing.
LISTED = "source_file string, file_size_bytes bigint, modified_at timestamp, exchange string, processing_stage string, data_date date"


# --- paths -------------------------------------------------------------------------


def source_path(exchange, day, stage="ingestion", file_type: str = "Data", root: str = "lake") -> Column:
    """Vendor path of one file, as a column over a manifest."""
    def col(x):
        return x if isinstance(x, Column) else F.lit(x)
    ex, date = F.upper(col(exchange)), col(day).cast("date").cast("string")
    return F.format_string(
        f"{root.rstrip('/')}/LSEG/TRTH/%s/%s/%s/data/merged/%s-%s-NORMALIZEDMP-{file_type}-1-of-1.csv.gz",
        ex, col(stage), date, ex, date,
    )


def _first(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def file_uri(path: str | Column) -> Column:
    """One spelling for local files: listing and reading differ in slashes."""
    return F.regexp_replace(path, r"^file:/+", "file:///")


def read_from(encoded: str = "_metadata.file_path") -> Column:
    """The file a row was read from, spelled as the listing spells it: the reader encodes blanks and signs."""
    return file_uri(F.url_decode(F.replace(F.col(encoded), F.lit("+"), F.lit("%2B"))))


def literal_path(path: str) -> str:
    """A path that the reader takes for one file, whatever signs of a pattern it holds."""
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in path)


def exchange_of(path: Column) -> Column:
    return _first(path, r"(?:exchange=|TRTH/)([^/]+)")


def stage_of(path: Column) -> Column:
    return _first(path, r"(?:processing_stage=|TRTH/[^/]+/)([^/]+)")


def manifest(requests: DataFrame, root: str = "lake", file_type: str = "Data") -> DataFrame:
    """Path per (exchange, data_date, stage); stages an exchange lacks carry an error."""
    known = stage_dim(requests.sparkSession).withColumn("_ok", F.lit(True))
    joined = requests.join(F.broadcast(known), ["exchange", "processing_stage"], "left")
    path = source_path(F.col("exchange"), F.col("data_date"), F.col("processing_stage"), file_type, root)
    error = F.when(F.col("_ok").isNull(), F.concat_ws(" ", F.lit("stage"), "processing_stage", F.lit("not available for"), "exchange"))
    return joined.select(
        *requests.columns, F.when(F.col("_ok"), path).alias("source_file"), error.alias("error"))


# --- listing -----------------------------------------------------------------------


def list_files(spark: SparkSession, root: str, exchange: str | None = None, stage: str | None = None,
               start: str | None = None, end: str | None = None, file_type: str | None = "Data",
               glob: str = "*.csv.gz") -> DataFrame:
    """Files below ``root`` with size, time, exchange, stage and day; no content is read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        .load(root).select(
            file_uri("path").alias("source_file"),
            F.col("length").alias("file_size_bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )
    path = F.col("source_file")
    out = listed.withColumns({
        "exchange": exchange_of(path), "processing_stage": stage_of(path), "data_date": first_date(path),
    }).where(F.col("data_date").isNotNull())
    if file_type:
        out = out.where(is_kind(file_type))
    if exchange:
        out = out.where(F.col("exchange") == exchange.upper())
    if stage:
        out = out.where(F.col("processing_stage") == stage)
    if start:
        out = out.where(F.col("data_date") >= F.lit(start).cast("date"))
    if end:
        out = out.where(F.col("data_date") <= F.lit(end).cast("date"))
    return out


def is_kind(file_type: str) -> Column:
    """Whether a file is of the kind its name states; names that state none are data."""
    path = F.col("source_file")
    return ~path.rlike("NORMALIZEDMP") | path.contains(f"NORMALIZEDMP-{file_type}")


def with_file_sizes(loads: DataFrame, files: DataFrame) -> DataFrame:
    """Load records with the size of their source file; NULL when the file is unknown."""
    return loads.join(files.select("source_file", "file_size_bytes"), "source_file", "left")


def total_size(df: DataFrame) -> int:
    """Bytes of the files behind a file-based frame."""
    per_file = df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"))
    return per_file.groupBy("p").agg(F.first("s").alias("s")).agg(F.sum("s")).first()[0] or 0


# --- reading -----------------------------------------------------------------------


def read_csv(spark: SparkSession, path, schema: T.StructType | str | None = None, partitions: int | None = None,
             sampling_ratio: float = 1.0) -> DataFrame:
    """One or more CSV files with a header.

    Give a schema in production: inference reads the data twice.  A gzip file
    is one task, so ``partitions`` spreads its rows for the work that follows.
    """
    reader = spark.read.option("header", "true")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true").option("samplingRatio", sampling_ratio)
    df = reader.csv(path)
    return df.repartition(partitions) if partitions else df


def read_with_source(spark: SparkSession, path, schema=None) -> DataFrame:
    """Files by glob with their name and the day found in it."""
    df = read_csv(spark, path, schema)
    return df.select("*", read_from().alias("source_file")).withColumn(
        "data_date", first_date("source_file"))


def discover_schema(spark: SparkSession, path, sampling_ratio: float = 0.1) -> DataFrame:
    """Inferred (name, type, nullable) rows of a file."""
    return schema_frame(read_csv(spark, path, sampling_ratio=sampling_ratio))


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrower type that holds the values of both; text where there is none."""
    numbers = [T.IntegerType(), T.LongType(), T.DoubleType()]
    if a == b:
        return a
    if a in numbers and b in numbers:
        return max(a, b, key=numbers.index)
    times = [T.DateType(), T.TimestampNTZType(), T.TimestampType()]
    return max(a, b, key=times.index) if a in times and b in times else T.StringType()


def discover_union_schema(spark: SparkSession, listed: DataFrame, sampling_ratio: float = 0.1) -> DataFrame:
    """Inferred (name, type, nullable) rows over files with different headers, matched by name.

    Files of one header are inferred together.  Columns keep the order in
    which headers bring them, the longest header first.
    """
    found: dict[str, T.DataType] = {}
    for header, names in sorted(header_groups(listed).items(), key=lambda g: (-g[0].count(","), g[0])):
        if header:
            for field in read_csv(spark, [literal_path(n) for n in names], sampling_ratio=sampling_ratio).schema:
                found[field.name] = wider(found.get(field.name, field.dataType), field.dataType)
    return schema_frame(spark.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in found.items()])))


LARGE_FILE = 16 << 20  # bytes from which a file is left after its first lines


def _first_line(batches):
    """The first line of a partition that begins a file; nothing after it is read."""
    for batch in batches:
        if batch.num_rows:
            if batch["start"][0].as_py() == 0:
                yield batch.slice(0, 1).select(["path", "value"])
            return


def headers_of(spark: SparkSession, small: list[str], large: list[str] = ()) -> dict[str, str]:
    """The first line of every file that has one.

    Spark's own text source reads them, so any store and credentials that it
    knows will do.  Lines of small files are read to their end, many files a
    task.  A large file is a partition of its own and is left after its first
    lines, which costs a Python worker; should Spark pack it with others, it is
    read like a small one.  A file that is damaged further on has its header;
    reading its rows will fail.
    """
    def lines(session: SparkSession, names: list[str]) -> DataFrame:
        text = session.read.option("ignoreCorruptFiles", "true").text([literal_path(n) for n in names])
        return text.select(F.col("_metadata.file_path").alias("path"), "value", F.col("_metadata.file_block_start").alias("start"))

    def named(found: DataFrame) -> dict[str, str]:
        plain = F.regexp_replace(F.regexp_replace("value", "^\ufeff", ""), "\r$", "")
        return {r[0]: r[1] for r in found.select(read_from("path"), plain).collect()}

    heads: dict[str, str] = {}
    if large:
        own = spark.newSession()
        own.conf.set("spark.sql.files.openCostInBytes", "1t")
        heads = named(lines(own, large).mapInArrow(_first_line, "path string, value string"))
    rest = [*small, *(p for p in large if p not in heads)]
    if rest:
        # one task reads the block in which a file begins, from its first line on
        heads |= named(lines(spark, rest).where("start = 0").groupBy("path").agg(F.first("value").alias("value")))
    return heads


def file_headers(paths: DataFrame, column: str = "source_file") -> DataFrame:
    """(name, header) of every file that has a first line."""
    rows = [(name, header) for header, names in header_groups(paths, column).items() if header for name in names]
    return paths.sparkSession.createDataFrame(rows, f"{column} string, header string")


def header_groups(paths: DataFrame, column: str = "source_file", size: str = "file_size_bytes") -> dict[str, list[str]]:
    """File names per distinct header, under "" those without a line: names and first lines only, as the file index keeps the names."""
    groups: dict[str, list[str]] = {}
    length = F.col(size) if size in paths.columns else F.lit(None).cast("bigint")
    sizes = {row[0]: row[1] or 0 for row in paths.select(column, length).collect()}
    large = [n for n, many in sizes.items() if many >= LARGE_FILE]
    heads = headers_of(paths.sparkSession, [n for n, many in sizes.items() if many < LARGE_FILE], large)
    for name in sorted(sizes):
        groups.setdefault(heads.get(name, ""), []).append(name)
    return groups


def read_tolerant(spark: SparkSession, paths, header: str) -> DataFrame:
    """All columns as text; rows that do not fit the header keep their raw line."""
    names = [h.strip().strip('"') for h in header.split(",")]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    df = (
        spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false").csv([literal_path(p) for p in paths])
    )
    return df.select("*", read_from().alias("source_file"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Raw lines (value, path, start) of files with different headers, as text columns matched by name.

    The header of a file is the first line of its first block; lines equal to
    it are no rows.  One pass finds the headers, one parses: names and headers
    come to the driver and go to all executors, a row for each file in ``lines``.
    """
    plain = F.regexp_replace(F.regexp_replace("value", "^\ufeff", ""), "\r$", "")
    found = [tuple(r) for r in lines.where("start = 0").groupBy("path").agg(F.first(plain).alias("header")).toLocalIterator()]
    heads = lines.sparkSession.createDataFrame(found, "path string, header string")
    headers = sorted({header for _, header in found if header})
    names: dict[str, None] = {}
    layouts = []
    for header in headers:
        layout = [h.strip().strip('"') for h in header.split(",")]
        names |= dict.fromkeys(layout)
        layouts.append(layout)
    names[CORRUPT] = None
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    cases = F.lit(None)
    for header, layout in zip(headers, layouts, strict=True):
        schema = ", ".join(f"`{n}` string" for n in [*layout, CORRUPT])
        cell = F.from_csv("value", schema, options)
        row = F.struct(*[(cell[n] if n in (*layout, CORRUPT) else F.lit(None).cast("string")).alias(n) for n in names])
        cases = F.when(F.col("header") == header, row).otherwise(cases)
    body = lines.select("path", plain.alias("value")).join(F.broadcast(heads), "path").where("value <> header AND value <> ''")
    if not headers:
        return body.select(F.lit(None).cast("string").alias(CORRUPT), read_from("path").alias("source_file")).limit(0)
    return body.select(cases.alias("row"), read_from("path").alias("source_file")).select("row.*", "source_file")


def without_header(headers: dict[str, list[str]]) -> list[str]:
    """Files that have no line, or only blanks in their first one."""
    return [name for header, names in headers.items() if not header.strip() for name in names]


def unreadable(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Which files cannot be read to their end, and why; found by halving, so few bad files cost few passes."""
    try:
        spark.read.text([literal_path(p) for p in paths]).write.format("noop").mode("overwrite").save()
        return {}
    except Exception as e:
        if len(paths) <= 1:
            return {p: f"cannot be read: {e}" for p in paths}
    half = len(paths) // 2
    return unreadable(spark, paths[:half]) | unreadable(spark, paths[half:])


def read_grouped(spark: SparkSession, groups: dict[str, list[str]]) -> DataFrame:
    """Files by header as one frame of text columns, matched by name."""
    parts = [read_tolerant(spark, names, header) for header, names in sorted(groups.items()) if header.strip()]
    if not parts:
        raise FileNotFoundError("no files with a header line")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_union(spark: SparkSession, paths: DataFrame | list[str]) -> DataFrame:
    """Files with different columns as one frame of text columns, matched by name."""
    if isinstance(paths, list):
        paths = spark.createDataFrame([(p,) for p in paths], "source_file string").select(file_uri("source_file").alias("source_file"))
    return read_grouped(spark, header_groups(paths))


def to_vendor_types(raw: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Typed vendor columns, and ``is_rejected`` with the raw line for lines that could not be read.

    A value that is not of its type becomes NULL; a line with the wrong number
    of fields is rejected.
    """
    types = types or VENDOR_TYPES
    present = {f.name for f in raw.schema}
    cells = [
        (F.col(f"`{c}`").try_cast(t) if c in present else F.lit(None).cast(t)).alias(c) for c, t in types.items()
    ]
    # The reader refuses queries over the raw line alone, so the test names a second column.
    other = next(c for c in raw.columns if c not in (CORRUPT, "source_file"))
    broken = F.lit(False)
    if CORRUPT in present:
        broken = F.col(CORRUPT).isNotNull() | F.coalesce(F.length(f"`{other}`") < 0, F.lit(False))
    line = F.col(CORRUPT) if CORRUPT in present else F.lit(None).cast("string")
    return raw.select(*cells, broken.alias("is_rejected"), line.alias("raw_line"), "source_file")


def read_reports(spark: SparkSession, root: str, **where) -> DataFrame | None:
    """Daily report files as one frame; ``None`` when there are none."""
    return read_report_files(spark, list_files(spark, root, file_type="Report", **where))


def read_report_files(spark: SparkSession, listed: DataFrame) -> DataFrame | None:
    """The report files among ``listed`` as one frame; ``None`` when there are none."""
    groups = header_groups(listed.where(F.col("source_file").contains("-Report-")))
    if not any(header.strip() for header in groups):
        return None
    raw = read_grouped(spark, groups)
    path = F.col("source_file")
    return raw.withColumns({"exchange": exchange_of(path), "processing_stage": stage_of(path), "data_date": first_date(path)})


# --- inventories -------------------------------------------------------------------


def rows_per_file(df: DataFrame) -> DataFrame:
    return df.groupBy("source_file").agg(F.count("*").alias("row_count"))


def inventory(df: DataFrame) -> DataFrame:
    """Rows, base name and day per file, biggest first."""
    return rows_per_file(df).select(
        "source_file", "row_count", base_name("source_file").alias("file_basename"),
        first_date("source_file").alias("file_date"),
    ).orderBy(F.col("row_count").desc(), "source_file")


def inventory_totals(listed: DataFrame) -> DataFrame:
    return listed.agg(
        F.count("*").alias("total_files"), F.sum("row_count").alias("total_rows"),
        F.min("file_date").alias("first_date"), F.max("file_date").alias("last_date"),
    )
