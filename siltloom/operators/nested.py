"""Deeply nested records as flat child tables whose rows name their parent and their place in it.

Nested ``transform`` calls attach the ancestors' keys and positions inside the row, ``flatten`` joins the levels
and one ``inline`` per target table emits the rows: one narrow pass, no join, no shuffle.
Null lists and null elements give no rows; positions count null elements; a name that is missing is ''.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: The five lists of a dependency record.
DEPS = ("imports", "variables", "functions", "classes", "interfaces")
_EMPTY = "cast(array() as array<struct<path:string,parent_pos:int,pos:int,child_name:string>>)"


def _rows(path: str, source: str, name: str, parent: str = "-1", keep: str = "e is not null") -> str:
    """A list as an array of structs; ``name`` and ``keep`` speak of the element as e, ``i`` is its position.

    The position is attached before null elements are dropped.
    """
    made = f"transform({source}, (e, i) -> if({keep}, struct('{path}' as path, cast({parent} as int) as parent_pos, cast(i as int) as pos, {name} as child_name), null))"
    return f"coalesce(filter({made}, x -> x is not null), {_EMPTY})"


def _either(first: str, second: str) -> str:
    return f"coalesce(nullif({first}, ''), {second}, '')"


def parse_dependencies(df: DataFrame, column: str = "dependencies", to: str = "__deps") -> DataFrame:
    """Adds the dependency text as a variant, in whatever form a writer left it.

    Understood: plain JSON, JSON inside a JSON string, a wrapper object with the key ``dependencies``, control
    characters between tokens and commas before a closing bracket.  What cannot be understood is null.
    """
    repaired = f"regexp_replace(regexp_replace(`{column}`, '[\\\\x00-\\\\x1f]', ' '), ',\\\\s*([}}\\\\]])', '$1')"
    once = df.selectExpr("*", f"coalesce(try_parse_json(`{column}`), try_parse_json({repaired})) as __v")
    inner = "try_variant_get(__v, '$', 'string')"
    again = f"regexp_replace(regexp_replace({inner}, '[\\\\x00-\\\\x1f]', ' '), ',\\\\s*([}}\\\\]])', '$1')"
    twice = once.selectExpr("*", f"if(schema_of_variant(__v) = 'STRING', coalesce(try_parse_json({inner}), try_parse_json({again})), __v) as __w").drop("__v")
    unwrapped = "if(schema_of_variant(__w) like 'OBJECT%' and try_variant_get(__w, '$.dependencies', 'variant') is not null, try_variant_get(__w, '$.dependencies', 'variant'), __w)"
    return twice.selectExpr("*", f"{unwrapped} as {to}").drop("__w")


def dependency_rows(df: DataFrame, key: str, column: str = "dependencies", source_table: str = "ui_info") -> DataFrame:
    """(source_table, row_id, path, parent_pos, pos, child_name) of every element of a JSON dependency text."""
    parsed = parse_dependencies(df.selectExpr(f"`{key}` as __id", f"`{column}` as __text"), "__text")
    name = "if(schema_of_variant(e) = 'STRING', try_variant_get(e, '$', 'string'), if(schema_of_variant(e) like 'OBJECT%', coalesce(nullif(try_variant_get(e, '$.name', 'string'), ''), try_variant_get(e, '$.component_name', 'string'), ''), ''))"
    keep = "e is not null and not is_variant_null(e)"
    lists = []
    for k in DEPS:
        one = f"try_variant_get(__deps, '$.{k}', 'variant')"
        many = f"if(schema_of_variant({one}) like 'ARRAY%', try_variant_get(__deps, '$.{k}', 'array<variant>'), if({one} is null or is_variant_null({one}), null, array({one})))"
        lists.append(_rows(f"dependencies.{k}", many, name, keep=keep))
    return parsed.selectExpr(f"'{source_table}' as source_table", "__id as row_id", f"inline(flatten(array({', '.join(lists)})))")


def analysis_rows(df: DataFrame, key: str = "analysis_id", source_table: str = "ets_file_analysis") -> DataFrame:
    """The same rows for the imports and variables of file analyses, variables with what they hold."""
    named = _either("e.name", "e.component_name")
    lists = [_rows("imports", "imports", named), _rows("variables", "variables", "coalesce(e.name, '')")]

    def below(path: str, source: str, name: str) -> str:
        inner = _rows(path, source, name, "p")
        return f"coalesce(flatten(transform(variables, (v, p) -> {inner})), {_EMPTY})"

    lists.append(below("variables.modifiers", "v.modifiers", "e"))
    lists += [below(f"variables.dependencies.{k}", f"v.dependencies.{k}", "coalesce(e.name, '')") for k in DEPS]
    return df.selectExpr(f"'{source_table}' as source_table", f"`{key}` as row_id", f"inline(flatten(array({', '.join(lists)})))")


def child_tables(analyses: DataFrame, units: DataFrame) -> DataFrame:
    """All child rows of file analyses and UI units."""
    return dependency_rows(units, "unit_id").unionByName(analysis_rows(analyses))


def variables_table(df: DataFrame, key: str = "analysis_id") -> DataFrame:
    """The variables as a table of their own: parent key, position, fields, and how many modifiers they have."""
    made = "transform(variables, (v, i) -> if(v is null, null, struct(cast(i as int) as pos, v.name as name, v.type as type, v.value as value, coalesce(size(v.modifiers), 0) as modifiers)))"
    return df.selectExpr(f"`{key}` as row_id", f"inline(filter({made}, x -> x is not null))").withColumnRenamed("type", "var_type")


def imports_table(df: DataFrame, key: str = "analysis_id", *more: str) -> DataFrame:
    """The imports as a table of their own, with further columns of the parent."""
    made = f"transform(imports, (e, i) -> if(e is null, null, struct(cast(i as int) as pos, e.import_type as import_type, e.module_name as module_name, {_either('e.name', 'e.component_name')} as name, e.alias as alias)))"
    return df.selectExpr(f"`{key}` as row_id", *[f"`{m}`" for m in more], f"inline(filter({made}, x -> x is not null))")
