"""CSV and Parquet tables at any Hadoop file system path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.functions import quoted
from classweave.sources.files import delete_path, recover, sibling, swap_in


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, sampling_ratio: float | None = None
) -> DataFrame:
    """CSV with a header row.

    Without `schema` the types are inferred, which reads the whole file once
    more, or with `sampling_ratio` about that share of its rows: a value that
    only others have may then not fit its column, and `read_csv_checked` shows
    them. Pass the schema for large files.
    """
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sampling_ratio)
    return spark.read.csv(path, header=True, schema=schema)


def read_csv_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sampling_ratio: float | None = None,
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(table, rejected): the rows that fit the schema, and (file, record) of those that don't.

    A record is rejected whole if it has too few or too many fields, or a value
    that its column's type can't hold; an empty value is NULL and fits. Every
    record is in one of both tables, whichever columns are selected later:
    records are always parsed in full, so this costs more than `read_csv` where
    few columns are needed. Each table is a scan of its own. Files without a
    header row need a schema.
    """
    if not header and schema is None:
        raise ValueError("without a header row the schema must be given")
    if schema is None:
        schema = read_csv(spark, path, sampling_ratio=sampling_ratio).schema
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    taken = {f.name.lower() for f in fields}
    record = "_record"
    while record in taken:
        record += "_"
    # Columns of the schema may hold NULL whatever it says: a record with a gap is no fault of the file.
    full = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in fields])
    reader = spark.read.schema(T.StructType([*full, T.StructField(record, T.StringType())]))
    parsed = reader.options(header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=record).csv(path)
    # True of every row, and needs all columns: faults in those that a query does not need would not be found otherwise.
    whole = parsed.filter(F.hash(*[F.col(quoted(f.name)) for f in full]) >= -(2**31))
    table = whole.filter(F.col(record).isNull()).drop(record)
    rejected = whole.filter(F.col(record).isNotNull()).select(F.input_file_name().alias("file"), F.col(record).alias("record"))
    return table, rejected


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the Parquet table at `path`, which `df` must not read from.

    The new table is written beside the old one, which stays in place until the
    job has ended well and is then exchanged by renames: a job that fails leaves
    it readable. A driver that dies between the two renames leaves it beside
    `path`; the next write brings it back first, and so does `recover`. Where
    the store has no cheap rename, see `write_version`.
    """
    if _reads_from(df, path):
        raise ValueError(f"{path} is read by the table to be written; write it elsewhere")
    spark = df.sparkSession
    recover(spark, path)
    fresh = sibling(spark, path, "new")
    try:
        df.write.parquet(fresh)
        swap_in(spark, fresh, path)
    finally:
        delete_path(spark, fresh)


def _reads_from(df: DataFrame, path: str) -> bool:
    """Whether a file relation of the plan, subqueries included, lies in the target or holds it. Looks at root paths only."""
    context = df.sparkSession.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(target):
        return False
    written = _place(files.makeQualified(target))
    plan = df._jdf.queryExecution().analyzed()
    subqueries = plan.subqueriesAll()
    for part in [plan, *(subqueries.apply(i) for i in range(subqueries.size()))]:
        leaves = part.collectLeaves()
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            if leaf.getClass().getSimpleName() != "LogicalRelation" or leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
                continue
            roots = leaf.relation().location().rootPaths()
            for root in (roots.apply(i) for i in range(roots.size())):
                read = _place(root.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(root))
                if read[:2] == written[:2] and (read[2].startswith(written[2]) or written[2].startswith(read[2])):
                    return True
    return False


def _place(path) -> tuple[str, str, str]:
    uri = path.toUri()
    return uri.getScheme(), uri.getAuthority() or "", uri.getPath().rstrip("/") + "/"
