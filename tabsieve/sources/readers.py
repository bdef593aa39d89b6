"""Typed readers and writers.

* CSV scans read every field as text with a ``_rejected`` column that holds the
  raw line of a row that does not fit the header (and NULL otherwise): nothing
  is lost unseen.  :func:`read_csv` drops such rows or fails on them, as asked;
  :func:`count_rejected` counts them.  Types come from ``try_cast`` afterwards,
  so ``5.0`` in an integer column is 5 and a word is NULL; no row is dropped for
  its values.
* Files may lack columns (hidden splits have no label): absent ones are NULL.
* Column-oriented JSON (``{"movie": {"0": .., ..}, "director": {"0": .., ..}}``)
  is read as two maps and paired *by key*.  Such a file is one JSON document,
  hence one row and one task; convert it once to JSON Lines or Parquet when it
  is large.  Records are read as JSON Lines (a file is split by lines) or, when
  asked, as one JSON array per file.
* Optional inputs are probed through the Hadoop FileSystem of the path, so the
  same code works on local disk, HDFS or object stores.
* Splits are one table with a ``split`` column, written ``partitionBy('split')``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECTED = "_rejected"

# Column layout of the raw title CSV files (all read as text).
MOVIE_CSV_COLUMNS = ["tconst", "primaryTitle", "originalTitle", "startYear", "endYear",
                     "runtimeMinutes", "numVotes", "label"]


# Layouts of the public rating-site files the enrichment reads
# (DDL strings; identifiers stay as published).
EXTERNAL_CSV_SCHEMAS = {
    "links": "movieId BIGINT, imdbId BIGINT, tmdbId BIGINT",
    "movies": "movieId BIGINT, title STRING, genres STRING",
    "ratings": "userId BIGINT, movieId BIGINT, rating DOUBLE, timestamp BIGINT",
    "tags": "userId BIGINT, movieId BIGINT, tag STRING, timestamp BIGINT",
    "genome-scores": "movieId BIGINT, tagId INT, relevance DOUBLE",
    "genome-tags": "tagId INT, tag STRING",
}


def read_external_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of the rating-site CSVs with its published schema."""
    return read_csv(spark, path, T._parse_datatype_string(EXTERNAL_CSV_SCHEMAS[name]))


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` (a file, directory or glob) matches anything."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem access
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    matches = fs.globStatus(p)
    return matches is not None and len(matches) > 0


def read_optional(spark: SparkSession, path: str, reader) -> DataFrame | None:
    """``reader(spark, path)`` when the path exists, else None (skip the step)."""
    return reader(spark, path) if path_exists(spark, path) else None


def lenient(text: Column, to: T.DataType) -> Column:
    """Text -> ``to``, NULL where it does not fit; a whole number may be written
    with a decimal point."""
    if isinstance(to, T.StringType):
        return text
    out = F.trim(text).try_cast(to)
    if isinstance(to, T.IntegralType):
        exact = F.trim(text).try_cast("decimal(38,9)")
        out = F.coalesce(out, F.when(exact == F.floor(exact), exact).try_cast(to))
    return out


def scan_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, header: bool = True,
             **options) -> DataFrame:
    """Text columns of a CSV (file, directory or glob; one layout) and ``_rejected``.

    With a header its names decide which field is which; ``columns`` (default:
    all) picks and orders them, and absent ones are NULL.  Lines are parsed
    whole whatever columns are used: a parser that skips fields cannot see
    that there are too many or too few."""
    options = {"quote": '"', "escape": '"', "columnPruning": False} | options
    reader = spark.read.option("mode", "PERMISSIVE").option("header", header).options(**options)
    there = reader.csv(path).columns if header else list(columns)  # reads the first line
    df = reader.schema(string_schema([*there, REJECTED])) \
        .option("columnNameOfCorruptRecord", REJECTED).csv(path)
    wanted = there if columns is None else columns
    return df.select(*[(F.col(f"`{c}`") if c in there else F.lit(None).cast("string")).alias(c) for c in wanted],
                     REJECTED)


def count_rejected(scan: DataFrame) -> int:
    """Rows of a :func:`scan_csv` that do not fit the header."""
    # Spark refuses to read the raw line alone, so another column goes along
    return scan.agg(F.count(REJECTED).alias("n"), F.max(scan.columns[0])).first()["n"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | Sequence[str],
             header: bool = True, on_bad: str = "fail", null_value: str | None = None,
             multiline: bool = False, quote: str = '"', escape: str = '"') -> DataFrame:
    """CSV with an explicit schema.  Rows with more or fewer fields than the
    header make the read fail (``on_bad='fail'``) or are left out ('drop')."""
    if not isinstance(schema, T.StructType):
        schema = string_schema(schema)
    if on_bad not in ("fail", "drop"):
        raise ValueError("on_bad is 'fail' or 'drop'")
    options = {"multiLine": multiline, "quote": quote, "escape": escape}
    if null_value is not None:
        options["nullValue"] = null_value
    scan = scan_csv(spark, path, schema.names, header, **options)
    if on_bad == "drop":
        scan = scan.filter(F.col(REJECTED).isNull())
    else:
        first = schema.names[0]
        scan = scan.withColumn(first, F.when(F.col(REJECTED).isNotNull(), F.raise_error(F.concat(
            F.lit("malformed CSV row: "), REJECTED)).cast("string")).otherwise(F.col(first)))
    return scan.select(*[lenient(F.col(f.name), f.dataType).alias(f.name) for f in schema])


def read_movie_csv(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Raw title CSVs (glob) as text columns, plus an optional ``split``
    literal.  Malformed rows are skipped (count them with ``count_rejected(scan_csv(..))``);
    a hidden split without label gets a NULL one."""
    df = read_csv(spark, path, MOVIE_CSV_COLUMNS, on_bad="drop")
    return df.withColumn("split", F.lit(split)) if split else df


def read_csv_with_header(spark: SparkSession, path: str, **options) -> DataFrame:
    """CSV whose header drifts between versions: all columns as text under
    normalised names; malformed rows are left out."""
    scan = scan_csv(spark, path, None, True, **options)
    return normalize_headers(scan.filter(F.col(REJECTED).isNull()).drop(REJECTED))


def normalize_headers(df: DataFrame) -> DataFrame:
    """Byte-order mark dropped, runs of white space as one underscore, lower
    case; a name that comes again gets its ordinal."""
    names: list[str] = []
    for raw in df.columns:
        name = re.sub(r"\s+", "_", raw.lstrip("\ufeff").strip()).lower()
        n = sum(x == name or re.fullmatch(re.escape(name) + r"_\d+", x) is not None for x in names)
        names.append(f"{name}_{n + 1}" if n else name)
    return df.toDF(*names)


def read_column_json(spark: SparkSession, path: str, key_field: str, value_field: str,
                     key_out: str, value_out: str) -> DataFrame:
    """``{key_field: {i: k}, value_field: {i: v}}`` -> rows (k, v) paired by ``i``."""
    schema = T.StructType([
        T.StructField(key_field, T.MapType(T.StringType(), T.StringType())),
        T.StructField(value_field, T.MapType(T.StringType(), T.StringType()))])
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    return (raw.select(F.explode(key_field).alias("__i", key_out), F.col(value_field))
            .select(key_out, F.col(value_field)[F.col("__i")].alias(value_out)))


def read_records_json(spark: SparkSession, path: str, rename: dict[str, str],
                      schema: T.StructType | None = None, lines: bool = True) -> DataFrame:
    """JSON records -> selected, renamed columns: one record a line (files are
    split), or with ``lines=False`` one array of records a file (one task each)."""
    r = spark.read.option("multiLine", not lines).option("mode", "FAILFAST")
    if schema is not None:
        r = r.schema(schema)
    df = r.json(path)
    return df.select(*[F.col(src).alias(dst) for src, dst in rename.items()])


def read_curated_list(spark: SparkSession, path: str, columns: dict[str, str],
                      numeric: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Project + rename (``columns``: source -> target), coerce ``numeric``
    targets with ``try_cast``, drop rows missing any ``required`` target."""
    df = read_csv_with_header(spark, path)
    src = {c.lower(): c for c in df.columns}
    out = df.select(*[F.col(src[s.lower()]).alias(t) for s, t in columns.items()])
    for c in numeric:
        out = out.withColumn(c, F.col(c).try_cast("double"))
    return out.dropna(subset=list(required))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, overwrite, optional partition columns (e.g. ``split``).
    Never write to the path being read: give every step its own output."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_model(pipeline_model, path: str) -> None:
    """Persist a fitted pipeline: Spark ML stages under ``path/stage_<i>``, the
    encoder's tables as Parquet under ``path/encoder_<i>_<j>`` (one row per
    person: score, and the global mean that scores everyone else) and what they
    are for under ``path/encoders``; ``path/stages`` lists the stages in order.  Any
    Spark ML stage will do; one that cannot be written raises.  Fit-time lineage
    cuts leave nothing to save."""
    from ..operators.model import LineageCutModel, SmoothedEncoderModel
    spark, notes, kinds = SparkSession.active(), [], []
    for i, stage in enumerate(pipeline_model.stages):
        if isinstance(stage, SmoothedEncoderModel):
            for j, (_, person, out_col, count_col, scores, mean) in enumerate(stage._fitted):
                scores.select(person, "__score", mean.cast("double").alias("__mean")).write.mode("overwrite") \
                    .parquet(f"{path}/encoder_{i}_{j}")
                notes.append((i, j, stage._entity, person, out_col, count_col))
            kinds.append((i, "encoder"))
        elif not isinstance(stage, LineageCutModel):
            stage.write().overwrite().save(f"{path}/stage_{i}")
            kinds.append((i, "ml"))
    spark.createDataFrame(kinds, "stage int, kind string").coalesce(1).write.mode("overwrite").parquet(f"{path}/stages")
    if notes:
        spark.createDataFrame(notes, "stage int, place int, entity string, person string, out_col string, count_col string") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/encoders")


def load_model(spark: SparkSession, path: str, bridges: Sequence[DataFrame] = ()):
    """The saved pipeline as a fitted one; ``bridges`` are the encoder's bridge
    tables in their order (they are data, so they are not saved)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.util import DefaultParamsReader

    from ..operators.model import SmoothedEncoderModel
    kinds = spark.read.parquet(f"{path}/stages").collect()  # a row per stage
    # an encoder without bridges is a stage that does nothing
    stages = {r["stage"]: SmoothedEncoderModel("", []) for r in kinds if r["kind"] == "encoder"}
    if path_exists(spark, f"{path}/encoders"):
        notes = spark.read.parquet(f"{path}/encoders").orderBy("stage", "place").collect()  # a row per bridge
        for n, bridge in zip(notes, bridges, strict=True):
            table = spark.read.parquet(f"{path}/encoder_{n['stage']}_{n['place']}")
            mean = F.lit(table.first()["__mean"])
            stages[n["stage"]]._entity = n["entity"]
            stages[n["stage"]]._fitted.append(
                (bridge, n["person"], n["out_col"], n["count_col"], table.drop("__mean"), mean))
    for r in kinds:
        if r["kind"] == "ml":  # the stage's own metadata name its class
            stages[r["stage"]] = DefaultParamsReader.loadParamsInstance(f"{path}/stage_{r['stage']}", spark)
    return PipelineModel([stages[i] for i in sorted(stages)])
