"""Writers.  All go through the committers of the built-in sinks: a failed write leaves nothing half done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltloom.common import exists

#: Fixed value: the six text columns of a vision record.
VISION_SCHEMA = "folder_name string, png_content string, jpg_content string, ets_content string, txt_content string, generated_xml string"


def per_group_json(df: DataFrame, path: str, *groups: str, mode: str = "overwrite") -> None:
    """JSON lines in one folder per group value; full paths as groups, so equal base names do not collide."""
    df.write.mode(mode).partitionBy(*groups).json(path)


def append(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Adds rows without reading what is there."""
    df.write.mode("append").format(kind).save(path)


def explicit_parquet(df: DataFrame, path: str, schema: str = VISION_SCHEMA) -> None:
    """Parquet with exactly the schema's columns and types; missing ones are null."""
    from pyspark.sql.types import _parse_datatype_string

    fields = _parse_datatype_string(schema).fields
    df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]).write.mode("overwrite").parquet(path)


def by_category(df: DataFrame, path: str, category: str = "category") -> None:
    df.write.mode("overwrite").partitionBy(category).json(path)


def save_table(df: DataFrame, name: str, mode: str = "append") -> None:
    """Rows as a table; values are never put into statement text."""
    df.write.mode(mode).saveAsTable(name)


def vector_collection(df: DataFrame, path: str, key: str = "id") -> None:
    """Appends to a collection the entries whose key it lacks."""
    spark = df.sparkSession
    if not exists(spark, path):
        df.write.parquet(path)
        return
    known = spark.read.parquet(path).select(key)
    df.join(known, key, "left_anti").write.mode("append").parquet(path)


def sources_text(imports: Column, name: Column, members: Column) -> Column:
    """A struct file: imports, head, indented members."""
    lines = F.array_join(F.transform(members, lambda m: F.concat(F.lit("  "), F.replace(m, F.lit("\n"), F.lit("\n  ")))), "\n")
    return F.concat_ws("\n", F.array_join(imports, "\n"), F.concat(F.lit("@Component\nstruct "), name, F.lit(" {")), lines, F.lit("}"))


def move_status(df: DataFrame, ready: Column) -> DataFrame:
    """What a move or delete would do, as a column; nothing is destroyed."""
    return df.withColumn("status", F.when(ready, "move").otherwise("keep"))
