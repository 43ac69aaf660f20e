"""Reading, writing and cutting plans at written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

_BOM = "\ufeff"
# A table up to this size may be dealt out anew to use all cores.
SPREAD_BYTES = 4 << 30


_named: dict[str, str] = {}


def use_folder(spark: SparkSession, path: str) -> None:
    """Name the folder for this application's tables where ``spark.checkpoint.dir`` is unset."""
    _named[spark.sparkContext.applicationId] = path


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``, or the one named."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or _named.get(spark.sparkContext.applicationId)
    if not folder:
        raise ValueError("set spark.checkpoint.dir, or name a folder that all executors share")
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy survives lost executors, cuts the lineage, and has a known size:
    a later join broadcasts it only if that size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges it otherwise.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def inline_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Fixed small dimension as a local relation, so its size is known to the planner."""
    import pyarrow as pa

    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = pa.table([list(c) for c in columns], schema=to_arrow_schema(fields))
    return spark.createDataFrame(arrow, fields)


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def with_missing_columns(df: DataFrame, names: list[str], kind: str = "string") -> DataFrame:
    """Add absent columns as NULL."""
    absent = {n: F.lit(None).cast(kind) for n in names if n not in df.columns}
    return df.withColumns(absent) if absent else df


def trimmed_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(_BOM, "").strip() for c in df.columns])


def _typed(name: str, field: T.StructField) -> Column:
    column = F.col(f"`{name}`")
    return column if isinstance(field.dataType, T.StringType) else column.try_cast(field.dataType)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, matched by name.

    Types come from ``schema``, not from inference (no extra pass). A byte-order
    mark and blanks in the header are ignored; absent columns are NULL. So are cells that
    are not of their type; :func:`read_csv_checked` tells which.
    """
    raw = trimmed_headers(
        spark.read.option("header", True).option("multiLine", False).option("escape", '"').csv(path)
    )
    columns = [
        (_typed(f.name, f) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ]
    return raw.select(*columns)


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV as :func:`read_csv` has them, and its rejects, from one pass over the text.

    A line is rejected whole if it has more or fewer cells than the header, or a cell that is
    not empty and not of its column's type. Rejects: ``file``, ``line`` (its text), ``reasons``
    (``cells``, or ``column: value``). The files of a folder need one header. No line is lost:
    each is in one of the two. A file of only a header gives two empty tables.
    """
    options = {"header": True, "multiLine": False, "escape": '"'}
    header = spark.read.options(**options).csv(path).columns
    names = [c.replace(_BOM, "").strip() for c in header]
    places = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))])
    lines = spark.read.schema(places.add("_line", "string")).options(
        **options, mode="PERMISSIVE", columnNameOfCorruptRecord="_line").csv(path)
    # Places are read by number, so the reader cannot leave out cells and then miss a broken line.
    place = {name: f"_{i}" for i, name in enumerate(names)}
    values, reasons = [], [F.when(F.col("_line").isNotNull(), F.lit("cells"))]
    for field in schema:
        if field.name not in place:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        text, value = F.col(place[field.name]), _typed(place[field.name], field)
        values.append(value.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            reasons.append(F.when((F.trim(text) != "") & value.isNull(),
                                  F.concat(F.lit(f"{field.name}: "), text)))
    cells = F.to_csv(F.struct(*[f"_{i}" for i in range(len(names))]), {"escape": '"'})
    read = materialize(lines.select(
        F.struct(*values).alias("row"), F.input_file_name().alias("file"),
        F.coalesce("_line", cells).alias("line"), F.array_compact(F.array(*reasons)).alias("reasons"),
    ).withColumn("line", F.when(F.size("reasons") > 0, F.col("line"))), "csv")
    bad = F.size("reasons") > 0
    return read.filter(~bad).select("row.*"), read.filter(bad).select("file", "line", "reasons")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", bom: bool = False) -> None:
    """CSV files with a header; with ``bom`` each begins with a byte-order mark."""
    if bom:
        df = df.toDF(_BOM + df.columns[0], *df.columns[1:])
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_offers(df: DataFrame, path: str, run_id: str) -> None:
    """Offer sink, one folder per run and date; a repeated run replaces its own offers only."""
    write_table(df, f"{path}/run_id={run_id}", by=["date"])


def read_offers(spark: SparkSession, path: str, run_ids: list[str]) -> DataFrame:
    """Offers of the given runs."""
    folders = [f"{path}/run_id={r}" for r in run_ids]
    return spark.read.option("basePath", path).parquet(*folders).drop("run_id")


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add (or replace) columns that later filters read instead of recomputing.

    A filter above a plain projection is pushed below it, expression and all,
    so a costly expression would run in the filter and again in the projection.
    Columns that come out of ``inline`` are ordinary attributes to the optimizer.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*[f"`{c}`" for c in kept], F.inline(F.array(row)))


def planned_bytes(df: DataFrame) -> int:
    """Bytes the planner expects of ``df``: known for a written table, large for a plan it cannot judge."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_scan(scan: DataFrame) -> DataFrame:
    """Deal a table of fewer splits than cores out to all cores.

    For work bound by computing. ``scan`` is a table as read: a small one comes
    in one or two splits, hence tasks. A table of more than ``SPREAD_BYTES`` is never
    shuffled for it, however many cores there are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    small = planned_bytes(scan) <= SPREAD_BYTES
    return scan.repartition(cores) if small and scan.rdd.getNumPartitions() < cores else scan
