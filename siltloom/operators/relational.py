"""Filters, joins, aggregates, windows and set operations as DataFrame functions of built-in expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltloom.common import durable
from siltloom.functions.text import sdk_version_passes

# filters and projections


def project_fields(df: DataFrame, names: list[str], kind: str = "string") -> DataFrame:
    """The named columns in this order; one that is missing is null."""
    return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast(kind).alias(n) for n in names])


def prefix_filter(df: DataFrame, column: str, prefixes: list[str]) -> DataFrame:
    """Rows whose text begins with any of the prefixes; null texts go."""
    return df.where(reduce(or_, [F.col(column).startswith(p) for p in prefixes], F.lit(False)))


def test_files(df: DataFrame, column: str, dry_run: bool = False) -> DataFrame:
    """Rows that are no test files; with ``dry_run`` those that would go."""
    named = F.coalesce(F.col(column).contains(".test"), F.lit(False))
    return df.where(named if dry_run else ~named)


def sdk_gate(df: DataFrame, column: str) -> DataFrame:
    return df.where(sdk_version_passes(F.col(column)))


def has_key(df: DataFrame, column: str, key: str = "compatibleSdkVersion") -> DataFrame:
    """Rows whose configuration text has the key on any level."""
    return df.where(F.col(column).rlike(rf"[\"']?{key}[\"']?\s*:"))


#: What takes the place of bare SDK numbers and of the open runtime.
SDK_NAMES = {"10": "4.0.0(10)", "12": "5.0.0(12)"}
RUNTIME_NAMES = {"OpenHarmony": "HarmonyOS"}


def rewrite_products(products: Column) -> Column:
    """Where any product is built for version 10 or 12 of the open runtime, all lose compileSdkVersion and get the names
    of SDK_NAMES and RUNTIME_NAMES for bare values; else the list stays, with texts as versions."""

    def named(value: Column, names: dict[str, str]) -> Column:
        return F.coalesce(F.get(F.map_values(F.map_filter(F.create_map(*[F.lit(x) for p in names.items() for x in p]), lambda k, _: k == value)), F.lit(0)), value)

    hit = F.exists(products, lambda p: p["compileSdkVersion"].cast("string").isin(*SDK_NAMES) & p["runtimeOS"].isin(*RUNTIME_NAMES))
    changed = F.transform(products, lambda p: p.withField("compileSdkVersion", F.lit(None).cast("string")).withField("compatibleSdkVersion", named(p["compatibleSdkVersion"].cast("string"), SDK_NAMES)).withField("runtimeOS", named(p["runtimeOS"], RUNTIME_NAMES)))
    kept = F.transform(products, lambda p: p.withField("compileSdkVersion", p["compileSdkVersion"].cast("string")).withField("compatibleSdkVersion", p["compatibleSdkVersion"].cast("string")))
    return F.when(hit, changed).otherwise(kept)


def origin_only(df: DataFrame, modules: str = "modules") -> DataFrame:
    """Rows all of whose modules begin with @, also those without any."""
    return df.where(F.forall(F.coalesce(modules, F.array().cast("array<string>")), lambda m: m.startswith("@")))


def with_context(df: DataFrame) -> DataFrame:
    """Rows for which an import or a variable was found."""
    return df.where("size(imports) > 0 or size(variables) > 0")


def at_least(df: DataFrame, column: str, least: int) -> DataFrame:
    return df.where(F.col(column) >= least)


def tiny(df: DataFrame, column: str, chars: int = 30) -> DataFrame:
    """Rows whose text is shorter than ``chars``, null counting as empty."""
    return df.where(F.length(F.coalesce(F.col(column), F.lit(""))) < chars)


def api_calls_only(df: DataFrame, column: str = "class") -> DataFrame:
    return prefix_filter(df, column, ["android.", "androidx."])


def project_roots(files: DataFrame, path: str = "path", markers: tuple[str, str] = ("build-profile.json5", "hvigorfile.ts")) -> DataFrame:
    """Folders that hold both marker files and lie below no other such folder."""
    folder, name = F.regexp_extract(path, r"^(.*)/[^/]*$", 1), F.regexp_extract(path, r"([^/]*)$", 1)
    roots = files.select(folder.alias("root"), name.alias("n")).where(F.col("n").isin(*markers)).groupBy("root").agg(F.count_distinct("n").alias("c")).where(F.col("c") == len(markers)).select("root")
    parts = F.split("root", "/")
    above = roots.select("root", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("up")).where("up <> root")
    return roots.join(above.join(roots.select(F.col("root").alias("up")), "up", "left_semi").select("root").distinct(), "root", "left_anti")


def having_extension(files: DataFrame, group: str, path: str = "path", extension: str = ".ets") -> DataFrame:
    """(group, has): whether any file of the group has the extension."""
    return files.groupBy(group).agg(F.bool_or(F.col(path).endswith(extension)).alias("has"))


def ready_folders(files: DataFrame, inputs: tuple[str, ...] = ("ets", "txt"), target: str = "json") -> DataFrame:
    """Numbered folders that hold every input and no target yet, in order of their number."""
    found = files.where(F.col("folder").rlike("^[0-9]+$")).groupBy("folder").agg(*[F.bool_or(F.col("ext") == e).alias(e) for e in (*inputs, target)])
    wanted = reduce(lambda a, b: a & b, [F.col(e) for e in inputs], ~F.col(target))
    return found.where(wanted).select(F.col("folder").cast("bigint").alias("folder")).orderBy("folder")


def second_elements(df: DataFrame, column: str) -> DataFrame:
    """Adds ``second``: the second element of each list, '' where there is none."""
    return df.withColumn("second", F.coalesce(F.get(F.col(column), F.lit(1)), F.lit("")))


# joins


def uses(units: DataFrame, symbols: DataFrame, group: str = "file", boundary: bool = False, alias: str | None = None) -> DataFrame:
    """(unit_id, symbol columns): symbols of the same file whose name occurs in the unit's content.

    An equi-join on the file, then containment as residual; ``boundary`` asks for whole words, ``alias`` for the alias
    where there is one.  Empty names match nothing.
    """
    name = F.coalesce(F.nullif(F.col(alias), F.lit("")), F.col("name")) if alias else F.col("name")
    joined = units.select("unit_id", group, "content").join(symbols.withColumn("__n", name), group).where("__n <> ''")
    if boundary:
        hit = F.rlike(F.col("content"), F.concat(F.lit(r"(?<![A-Za-z0-9_])\Q"), F.col("__n"), F.lit(r"\E(?![A-Za-z0-9_])")))
    else:
        hit = F.contains(F.col("content"), F.col("__n"))
    return joined.where(hit).drop("content", "__n")


def merged_imports(used: DataFrame) -> DataFrame:
    """(unit_id, imports): one statement per module in order of first use, its components in order, none left out."""
    modules = used.groupBy("unit_id", "module_name").agg(F.min("pos").alias("first"), F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("parts"))
    line = F.concat(F.lit("import { "), F.array_join(F.transform("parts", lambda p: p["name"]), ", "), F.lit(" } from '"), F.col("module_name"), F.lit("';"))
    return modules.withColumn("line", line).groupBy("unit_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "line"))), lambda p: p["line"]).alias("imports"))


def union_imports(imports: DataFrame) -> DataFrame:
    """(module_name, default_name, names): per library the alphabetically first default and all named parts, sorted."""
    return imports.groupBy("module_name").agg(F.min(F.when(F.col("import_type") == "default", F.col("name"))).alias("default_name"), F.array_sort(F.collect_set(F.when(F.col("import_type") != "default", F.col("name")))).alias("names")).orderBy("module_name")


def code_with_context(units: DataFrame, imports: DataFrame, variables: DataFrame, origin: bool = False) -> DataFrame:
    """(unit_id, content, imports, variables) of the units that use at least one import or variable of their file.

    With ``origin`` units that use a relative import are left out.
    """
    used = uses(units, imports.select("file", "pos", "name", "module_name"))
    if origin:
        units = units.join(used.where(F.col("module_name").startswith(".")).select("unit_id").distinct(), "unit_id", "left_anti")
    named = uses(units, variables.select("file", "pos", "name", "full_variable")).groupBy("unit_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "full_variable"))), lambda p: p["full_variable"]).alias("variables"))
    empty = F.array().cast("array<string>")
    out = units.select("unit_id", "content").join(merged_imports(used), "unit_id", "left").join(named, "unit_id", "left")
    return with_context(out.withColumns({"imports": F.coalesce("imports", empty), "variables": F.coalesce("variables", empty)}))


def unprocessed(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is in no finished row."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def without_reserved(df: DataFrame, reserved: DataFrame, column: str = "name") -> DataFrame:
    """Rows whose name is no reserved word; the list is a bounded reference table."""
    return df.join(reserved.select(F.col("word").alias(column)), column, "left_anti")


def last_declared(declarations: DataFrame, calls: DataFrame, imports: DataFrame) -> DataFrame:
    """Calls with the full class of their variable: the last declaration of a name wins, an unknown name stands for itself."""
    held = declarations.groupBy("file", "name").agg(F.max_by("class", "order").alias("class"))
    out = calls.join(held, ["file", "name"], "left").withColumn("class", F.coalesce("class", "name"))
    return out.join(imports.select("file", F.col("name").alias("class"), "full"), ["file", "class"], "left").withColumn("full", F.coalesce("full", "class"))


def sibling_files(files: DataFrame, extensions: tuple[str, ...]) -> DataFrame:
    """One row per folder with the content of the last file of each extension; folders that lack one go."""
    out = files.groupBy("folder").agg(*[F.max_by(F.when(F.col("ext") == e, F.col("content")), F.when(F.col("ext") == e, F.col("name"))).alias(e) for e in extensions])
    return out.where(reduce(lambda a, b: a & b, [F.col(e).isNotNull() for e in extensions]))


# aggregates, windows, sets


def nested_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """The number of elements in each list column over all rows."""
    return df.agg(*[F.coalesce(F.sum(F.when(F.col(c).isNotNull(), F.size(c))), F.lit(0)).alias(c) for c in columns])


def map_list_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.sum(F.aggregate(F.map_values(column), F.lit(0), lambda a, x: a + F.size(x))).alias("entries"))


def category_counts(df: DataFrame, category: Column) -> DataFrame:
    return df.groupBy(category.alias("category")).agg(F.count("*").alias("rows"))


def run_statistics(df: DataFrame, ok: Column) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.count(F.when(ok, 1)).alias("processed"), F.count(F.when(~ok, 1)).alias("failed"))


def first_seen(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """One row per key, the first by position."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), pos).alias("r")).select("r.*")


def _running(df: DataFrame, group: str, order: list[str], value: Column, how: str, to: str) -> DataFrame:
    """Adds the sum of all earlier values of the group, or the last value up to the row that is not null.

    Rows are range-partitioned by group and order, so a group that a third of all rows belong to is spread over many
    tasks.  What the partitions before hold is carried in from a table of the groups that cross a partition's border,
    which has at most two rows per partition and may therefore be broadcast.
    """
    parts = durable(df.withColumn("__v", value).repartitionByRange(group, *order).withColumn("__p", F.spark_partition_id()))
    own = Window.partitionBy(group, "__p").orderBy(*order)
    if how == "sum":
        whole = F.sum("__v")
        local = F.coalesce(F.sum("__v").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    else:
        whole = F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct(*order)))
        local = F.last("__v", ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    per = parts.groupBy(F.col(group).alias("__g"), F.col("__p").alias("__q")).agg(whole.alias("__w"))
    crossing = per.groupBy("__g").agg(F.count("*").alias("n"), F.collect_list(F.struct("__q", "__w")).alias("l")).where("n > 1").select("__g", F.explode("l").alias("x")).select("__g", "x.*")
    before = Window.partitionBy("__g").orderBy("__q").rowsBetween(Window.unboundedPreceding, -1)
    prior = crossing.select("__g", "__q", (F.coalesce(F.sum("__w").over(before), F.lit(0)) if how == "sum" else F.last("__w", ignorenulls=True).over(before)).alias("__prior"))
    joined = parts.withColumn("__l", local).join(F.broadcast(prior), F.col(group).eqNullSafe(F.col("__g")) & (F.col("__p") == F.col("__q")), "left")
    result = F.col("__l") + F.coalesce("__prior", F.lit(0)) if how == "sum" else F.coalesce("__l", "__prior")
    return joined.withColumn(to, result).drop("__v", "__p", "__l", "__g", "__q", "__prior")


def carried_forward(df: DataFrame, group: str, order: str, value: Column, to: str) -> DataFrame:
    """Adds the last value that is not null up to each row."""
    return _running(df, group, [order], value, "last", to)


def balanced_split(df: DataFrame, order: str, n: int) -> DataFrame:
    """Adds ``bucket`` from 1 to n: contiguous runs of the order, as even as can be, the longer ones first.

    Ranks come from a range sort with offsets, not from one task.
    """
    from siltloom.functions.html import numbered

    ranked = numbered(df, [order], "__rank")
    total = F.lit(df.count())
    size, more = F.floor(total / n), total % n
    zero = F.col("__rank") - 1
    bucket = F.when(zero < more * (size + 1), F.floor(zero / (size + 1))).otherwise(more + F.floor((zero - more * (size + 1)) / F.greatest(size, F.lit(1))))
    return ranked.withColumn("bucket", (bucket + 1).cast("int")).drop("__rank")


def seeded_sample(df: DataFrame, key: str, n: int, seed: str = "0") -> DataFrame:
    """n rows without replacement, the same for the same seed however the rows are partitioned."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key).limit(n)


def until_successes(df: DataFrame, group: str, order: list[str], success: Column, limit: int) -> DataFrame:
    """Rows of each group up to and with its ``limit``-th success."""
    return _running(df, group, order, F.coalesce(success, F.lit(False)).cast("int"), "sum", "__s").where(F.col("__s") < limit).drop("__s")


def merged_maps(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Both tables by key, the new row where both have one; of several new ones the last by ``version``."""
    rows = old.withColumn("__o", F.lit(0)).unionByName(new.withColumn("__o", F.lit(1)))
    return rows.groupBy(key).agg(F.max_by(F.struct(*old.columns), F.struct("__o", "version")).alias("r")).select("r.*")


def numbered_names(df: DataFrame, base: str, order: str, first_bare: bool = False) -> DataFrame:
    """Adds ``unique_name``: base_n with n from 1, or the bare name first and then base_1."""
    counted = _running(df, base, [order], F.lit(1), "sum", "__n")
    n = F.col("__n") + (0 if first_bare else 1)
    return counted.withColumn("unique_name", F.when(n == 0, F.col(base)).otherwise(F.concat_ws("_", base, n))).drop("__n")


def config_rows(text: str) -> list[Row]:
    """Sections and keys of an INI text as rows; secrets are to come from the environment."""
    import configparser

    parser = configparser.ConfigParser()
    parser.read_string(text)
    return [Row(section=s, key=k, value=v) for s in parser.sections() for k, v in parser.items(s)]
