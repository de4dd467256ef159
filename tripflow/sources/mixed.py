"""Raw files of different schemas: one scan for each schema, brought to the wanted columns.

A month may store a count as DOUBLE, a code as BIGINT, or lack a column. Spark reads all files of a
scan by one schema, so files are grouped by what their footers say and every group is read by its
own; columns are matched by name, whatever its case.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
)

from tripflow.schemas import RAW_TRIPS
from tripflow.session import durable
from tripflow.sources.footers import footers, list_parquet

#: Columns that say where a row comes from; ids are made of them.
PATH, PLACE = "_source_path", "_source_row"
#: Schemas in one folder beyond which something else must be wrong.
MOST_SCHEMAS = 1000

_RANGES = {
    ByteType: (-(1 << 7), (1 << 7) - 1),
    ShortType: (-(1 << 15), (1 << 15) - 1),
    IntegerType: (-(1 << 31), (1 << 31) - 1),
    LongType: (-(1 << 63), (1 << 63) - 1),
}


def checked(value: Column, held: str, field: StructField) -> Column:
    """`value`, of type `held` in the file, as the wanted column; what does not fit raises.

    Whole numbers may come as fractions or text; NaN, which some writers put for a missing number,
    is NULL there.
    """
    wanted = field.dataType
    if held == wanted.simpleString():
        return value
    shown = F.concat(F.lit(f"{field.name}: "), value.cast("string"), F.lit(f" is no {wanted.simpleString()}"))
    wrong = F.raise_error(shown).cast(wanted)
    limits = _RANGES.get(type(wanted))
    if limits and held in ("double", "float"):
        # 2**63 itself is a double, but no LONG.
        fits = (value == F.floor(value)) & (value >= float(limits[0])) & (value < float(limits[1] + 1))
        return F.when(value.isNull() | F.isnan(value), F.lit(None)).when(fits, value.cast(wanted)).otherwise(wrong)
    if isinstance(wanted, (DoubleType, FloatType)) and held not in ("string", "boolean"):
        return value.cast(wanted)
    cast = value.try_cast(wanted)
    return F.when(value.isNotNull() & cast.isNull(), wrong).otherwise(cast)


def _scan(spark: SparkSession, paths: list[str], held: dict[str, tuple[str, str]], wanted: StructType) -> DataFrame:
    """The files of one schema. `held`: name and type in the files, by the wanted column's name."""
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in held.values())
    rows = spark.read.schema(ddl).parquet(*paths) if ddl else spark.read.schema("`_none` int").parquet(*paths)
    columns = []
    for field in wanted.fields:
        if field.name in held:
            name, kind = held[field.name]
            columns.append(checked(F.col(f"`{name}`"), kind, field).alias(field.name))
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return rows.select(
        *columns,
        F.col("_metadata.file_path").alias(PATH),
        F.col("_metadata.row_index").alias(PLACE),
    )


def read_mixed(spark: SparkSession, path: str, wanted: StructType = RAW_TRIPS) -> DataFrame:
    """The wanted columns of all Parquet files below `path`, whatever types they are stored in.

    A column that a file lacks is NULL; others are not read. A value that does not fit the wanted
    type fails the read and is shown. Two columns beside the wanted ones, PATH and PLACE, tell rows
    apart. A folder without files gives no rows.
    """
    names = [f.name.lower() for f in wanted.fields]
    kept = F.filter("columns", lambda c: F.lower(c["name"]).isin(names))
    found = durable(footers(list_parquet(spark, path)).select("path", kept.alias("held")), "footers")
    groups = found.select("held").distinct().limit(MOST_SCHEMAS + 1).collect()
    if len(groups) > MOST_SCHEMAS:
        raise ValueError(f"{path} holds files of more than {MOST_SCHEMAS} schemas")
    scans = []
    for group in groups:
        of = {c["name"].lower(): (c["name"], c["type"]) for c in group["held"]}
        held = {f.name: of[f.name.lower()] for f in wanted.fields if f.name.lower() in of}
        chosen = found.join(spark.createDataFrame([group], found.select("held").schema), "held")
        # Spark's own scan holds this list of paths, too.
        paths = [row["path"] for row in chosen.select("path").collect()]
        scans.append(_scan(spark, sorted(paths), held, wanted))
    if not scans:
        extra = StructType([*wanted.fields]).add(PATH, "string").add(PLACE, "long")
        return spark.createDataFrame([], extra)
    return reduce(DataFrame.unionByName, scans)
