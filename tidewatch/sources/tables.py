"""Reading and writing tables with declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewatch import vocabulary as v

TEXT = ["protocol_type", "service", "flag", "label"]
COUNTS = [
    "duration", "src_bytes", "dst_bytes", "land", "wrong_fragment", "urgent", "hot", "num_failed_logins",
    "logged_in", "num_compromised", "root_shell", "su_attempted", "num_root", "num_file_creations",
    "num_shells", "num_access_files", "num_outbound_cmds", "is_host_login", "is_guest_login", "count",
    "srv_count", "dst_host_count", "dst_host_srv_count",
]


#: Column of a malformed line's text while reading.
LINE = "_line"


class MissingSource(Exception):
    """The source path does not exist."""


def connection_schema() -> T.StructType:
    """The 42 raw columns: text, counts and flags, rates."""
    kinds = {**{c: T.StringType() for c in TEXT}, **{c: T.LongType() for c in COUNTS}, **{c: T.DoubleType() for c in v.RATES}}
    return T.StructType([T.StructField(c, kind) for c, kind in kinds.items()])


def _checked(path: str, read) -> DataFrame:
    try:
        return read(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition() or error):
            raise MissingSource(path) from error
        raise


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, bad_cells: str | None = None
) -> DataFrame:
    """CSV with a header, columns matched to `schema` by name.

    Types come from the schema, so nothing is inferred by an extra pass; without a schema
    every column is text, for batches that still have to be checked. Gaps and NaN become NULL.
    A cell that its type can't read becomes NULL too; name a column in `bad_cells` to keep such
    cells' texts (a map from column name to text, NULL for a sound row), or leave out the schema.
    Of a line with more cells than the header the surplus is lost here, and one with fewer ends in gaps;
    `read_csv_checked` keeps such lines apart.
    """
    return _typed(_checked(path, spark.read.option("header", True).csv), schema, bad_cells)


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType | None = None, bad_cells: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(table, quarantine): every data line is in exactly one of them.

    The table has the lines with as many cells as the header, as `read_csv` gives them. The quarantine has a row
    for each other line: file, line (its text), expected (cells of the header). Cells are counted by the rules of CSV, so
    a separator inside quotes parts nothing; empty lines are no lines.
    """
    names = _checked(path, spark.read.option("header", True).csv).columns
    # Cells are counted among the columns that a plan asks for, so all are asked for by a test that always holds. A test
    # for NULL would be pushed down and answered before the line is judged, hence one on the text.
    whole = T.StructType([T.StructField(c, T.StringType()) for c in [*names, LINE]])
    lines = spark.read.schema(whole).options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE).csv(path)
    lines = lines.where(F.concat_ws("", *names) >= "")
    line = F.coalesce(F.col(LINE), F.lit(""))
    bad = lines.where(line != "").select(F.input_file_name().alias("file"), F.col(LINE).alias("line"), F.lit(len(names)).alias("expected"))
    return _typed(lines.where(line == "").drop(LINE), schema, bad_cells), bad


def _typed(raw: DataFrame, schema: T.StructType | None, bad_cells: str | None) -> DataFrame:
    if schema is None:
        return raw
    wanted = {f.name: f.dataType for f in schema.fields if f.name in raw.columns}
    cells = [F.col(c).try_cast(wanted[c]).alias(c) if c in wanted else F.col(c) for c in raw.columns]
    typed = [c for c in wanted if not isinstance(wanted[c], T.StringType)]
    if bad_cells is not None and typed:
        lost = F.map_from_entries(F.array_compact(F.array(*[
            F.when(F.col(c).isNotNull() & F.col(c).try_cast(wanted[c]).isNull(), F.struct(F.lit(c).alias("key"), F.col(c).alias("value"))) for c in typed
        ])))
        cells.append(F.when(F.size(lost) > 0, lost).alias(bad_cells))
    return nan_to_null(raw.select(*cells))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; NaN becomes NULL."""
    return nan_to_null(_checked(path, spark.read.parquet))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


def normalise_raw(df: DataFrame) -> DataFrame:
    """Bytes become UTF-8 text, and the target column is called `label`."""
    decoded = {
        f.name: F.decode(F.col(f.name), "UTF-8") for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)
    }
    text = df.withColumns(decoded) if decoded else df
    for name in ("target", "labels"):
        if name in text.columns:
            return text.withColumnRenamed(name, "label")
    return text


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN from a foreign source becomes NULL, so that it is missing rather than the largest value."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def write_table(df: DataFrame, path: str, format: str = "parquet", partition_by: list[str] = ()) -> None:
    """Overwrite a table. Parquet keeps every float digit; CSV is for exchange only."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path, header=True) if format == "csv" else writer.format(format).save(path)


def write_report(findings: DataFrame, path: str, partition_by: str | None = "check") -> None:
    """Findings as JSON lines, one folder per check."""
    write_table(findings, path, "json", [partition_by] if partition_by else [])
