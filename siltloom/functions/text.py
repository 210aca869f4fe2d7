"""Column functions over source and page texts, all built-in expressions that stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: SDK versions given as text that pass the gate; a plain number passes from 10 on.
SDK_TEXT_VERSIONS = ("5.0.0(12)", "5.0.1(13)", "5.0.2(14)", "5.0.3(15)")
#: Fixed value: the pattern of version settings.
_SDK = r'("compileSdkVersion"|"compatibleSdkVersion")\s?:\s*(?:(\d+)|"([\d.()]+)")'


def remove_comments_naive(text: Column) -> Column:
    """Block comments, then line comments, then lines left blank; also cuts // inside literals."""
    text = F.regexp_replace(text, r"(?s)/\*.*?\*/", "")
    text = F.regexp_replace(text, r"(?md)//.*$", "")
    return F.regexp_replace(text, r"(?md)^\s*\n", "")


def remove_comments_line_first(text: Column) -> Column:
    """Line comments first: a // inside a block comment swallows the block's end on that line."""
    return F.regexp_replace(F.regexp_replace(text, r"(?md)//.*?$", ""), r"(?s)/\*.*?\*/", "")


def clean_code(text: Column) -> Column:
    """Literal bodies become ..., comment texts go but their marks stay, a tab is four blanks; in this order."""
    # fixed values: these patterns and their order are what the token counts of the index rest on
    text = F.regexp_replace(text, r"""(["'])(?:(?=(\\?))\2.)*?\1""", "$1...$1")
    text = F.regexp_replace(text, r"(?d)#.*", "#")
    text = F.regexp_replace(text, r"(?d)//.*", "//")
    text = F.regexp_replace(text, r"(?s)/\*.*?\*/", "/* */")
    return F.regexp_replace(text, "\t", "    ")


def code_tokens(text: Column) -> Column:
    """Words, and the signs { } ( ) . => : of cleaned code."""
    return F.regexp_extract_all(clean_code(text), F.lit(r"(?U)\w+|\{|\}|\(|\)|\.|=>|:"), F.lit(0))


def sdk_version_passes(text: Column) -> Column:
    """The first version in the text decides: a number from 10 on, or one of four exact texts; none gives false."""
    number, literal = F.regexp_extract(text, _SDK, 2), F.regexp_extract(text, _SDK, 3)
    return F.coalesce(F.when(number != "", number.try_cast("bigint") >= 10).when(literal != "", literal.isin(*SDK_TEXT_VERSIONS)).otherwise(False), F.lit(False))


def file_type(text: Column) -> Column:
    """Page, Component or Service; the first rule that fits wins (fixed values: the two patterns)."""
    return F.when(text.rlike(r"@Entry\s*@Component\s*struct"), "Page").when(text.rlike(r"@Component\s*(export)?\s*struct"), "Component").otherwise("Service")


def code_category(path: Column, is_ui: Column) -> Column:
    """test where the path says so, else ui or function."""
    return F.when(F.lower(path).contains("test"), "test").when(is_ui, "ui").otherwise("function")


def repair_json(text: Column) -> Column:
    """Commas before a closing bracket, unquoted keys and control characters."""
    text = F.regexp_replace(text, r",\s*([}\]])", "$1")
    text = F.regexp_replace(text, r"([{,]\s*)([A-Za-z_]\w*)(\s*:)", '$1"$2"$3')
    return F.regexp_replace(text, r"[\x00-\x1f]", "")


def safe_json(text: Column, schema: str) -> Column:
    """The parsed text, else the parsed repair, else null."""
    fixed = repair_json(text)
    return F.coalesce(F.from_json(F.when(F.try_parse_json(text).isNotNull(), text), schema), F.from_json(F.when(F.try_parse_json(fixed).isNotNull(), fixed), schema))


def json5_options() -> dict[str, str]:
    """Reader options for JSON with comments, unquoted keys and single quotes; trailing commas need repair_json."""
    return {"allowComments": "true", "allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}


def json_slice(text: Column) -> Column:
    """From the first { to the last } where that is valid JSON, else null."""
    part = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.when(F.try_parse_json(part).isNotNull() & (part != ""), part)


def fenced(text: Column, language: str = "xml") -> Column:
    """The first fence of the language, else the first fence of any, else the text."""
    own = F.regexp_extract(text, rf"(?s)```{language}\s*(.*?)```", 1)
    other = F.regexp_extract(text, r"(?s)```\w*\s*(.*?)```", 1)
    return F.regexp_replace(F.when(own != "", own).when(other != "", other).otherwise(text), r"^\s+|\s+$", "")


def unescape_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\\n"), F.lit("\n"))


def url_file_name(url: Column) -> Column:
    """Host and path with / as _, and .html behind it."""
    bare = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][\w+.-]*://", ""), r"[?#].*$", "")
    return F.concat(F.regexp_replace(F.regexp_replace(bare, "/+$", ""), "/", "_"), F.lit(".html"))


def url_object_id(url: Column) -> Column:
    """The last path segment."""
    return F.element_at(F.split(url, "/"), -1)


def folder_prefix(name: Column) -> Column:
    """The name without a number behind its last underscore."""
    return F.regexp_extract(name, r"^(.+?)(?:_(\d+))?$", 1)


def folder_number(name: Column) -> Column:
    """The number behind the last underscore, 0 without one."""
    return F.coalesce(F.regexp_extract(name, r"^(.+?)(?:_(\d+))?$", 2).try_cast("bigint"), F.lit(0))


def fim_normal(text: Column) -> Column:
    """Without blanks and quotes, for comparing a reconstruction with its original."""
    return F.regexp_replace(text, r"""(?U)[\s'"`]+""", "")


def import_lines(text: Column) -> Column:
    """The lines that begin with an import, stripped, in order."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, r"^\s+|\s+$", "")))
    return F.filter(lines, lambda x: x.rlike(r"^import\s+[\w.]+|^import\s+[{}\w.]+\s+from\s+[@\w.]+"))


def boosted_query(text: Column) -> Column:
    """The query with its import lines behind it, joined by blanks and twice without a separator."""
    joined = F.array_join(import_lines(text), " ")
    return F.when(F.size(import_lines(text)) > 0, F.concat(text, F.lit(" "), F.repeat(joined, 2))).otherwise(text)


def import_features(text: Column) -> Column:
    """Distinct name@module of all import statements that end in a semicolon; `A as B` counts as A."""
    whole = F.regexp_extract_all(text, F.lit(r"(?s)import\s+.+?\s+from\s+['\"].*?['\"]\s*;"), F.lit(0))

    def names(one: Column) -> Column:
        clause = F.regexp_extract(one, r"(?s)import\s+(.+?)\s+from\s+['\"]", 1)
        module = F.trim(F.regexp_extract(one, r"(?s)\sfrom\s+['\"](.*?)['\"]\s*;$", 1))
        parts = F.split(F.regexp_replace(clause, r"[{}]", ","), ",")
        bare = F.transform(parts, lambda p: F.regexp_replace(F.regexp_replace(p, r"(?s) as .*$", ""), r"^\s+|\s+$", ""))
        return F.transform(F.filter(bare, lambda p: p != ""), lambda p: F.concat(p, F.lit("@"), module))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(whole, names))))


def jaccard(a: Column, b: Column) -> Column:
    """Common over all distinct elements; two empty sets give 0.0."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def exported_names(text: Column) -> Column:
    """Names behind export function, class and interface, in order."""
    return F.regexp_extract_all(text, F.lit(r"export\s+(?:default\s+)?(?:async\s+)?(?:function|class|interface)\s+(\w+)"), F.lit(1))


def aliased_imports(text: Column) -> Column:
    """(original, alias, path) of each named import; without an alias it is the name itself."""
    whole = F.regexp_extract_all(text, F.lit(r"import\s*\{[^}]*\}\s*from\s*['\"][^'\"]+['\"]"), F.lit(0))

    def pairs(one: Column) -> Column:
        path = F.regexp_extract(one, r"from\s*['\"]([^'\"]+)['\"]", 1)
        parts = F.filter(F.transform(F.split(F.regexp_extract(one, r"\{([^}]*)\}", 1), ","), F.trim), lambda p: p != "")
        return F.transform(parts, lambda p: F.struct(F.trim(F.element_at(F.split(p, r"\s+as\s+"), 1)).alias("name"), F.trim(F.element_at(F.split(p, r"\s+as\s+"), -1)).alias("alias"), path.alias("path")))

    return F.flatten(F.transform(whole, pairs))


def distribution_mirror(text: Column, host: str) -> Column:
    """The distribution host of a build wrapper replaced by a mirror."""
    return F.regexp_replace(text, r"https\\?://services\.gradle\.org/distributions", host)


def composables(text: Column) -> Column:
    """Composable functions up to the first closing brace, with @Preview put before those that lack it."""
    found = F.regexp_extract_all(text, F.lit(r"(?s)(?:@Preview[^\n]*\s+)?@Composable\s+fun\s+\w+\s*\(.*?\)\s*\{.*?\}"), F.lit(0))
    return F.transform(found, lambda x: F.when(x.startswith("@Preview"), x).otherwise(F.concat(F.lit("@Preview\n"), x)))


def template_page(code: Column, imports: Column, variables: Column) -> Column:
    """A page: the imports that are not relative, then a struct with the variables and the code."""
    kept = F.filter(imports, lambda x: ~x.rlike(r"from\s+['\"]\."))
    return F.concat_ws("\n", F.array_join(kept, "\n"), F.lit("@Entry\n@Component\nstruct Index {"), F.array_join(F.transform(variables, lambda v: F.concat(F.lit("  "), v)), "\n"), code, F.lit("}"))


def cross_file_context(imports: Column) -> Column:
    """The relative imports, which a template gives as context of other files."""
    return F.filter(imports, lambda x: x.rlike(r"from\s+['\"]\."))


def replace_marked(text: Column, snippet: Column, stamp: Column) -> Column:
    """The slot between the marks replaced by a snippet, with the time of the change above it."""
    return F.concat(F.lit("// updated "), stamp, F.lit("\n"), F.regexp_replace(text, F.lit(r"(?s)// <slot>.*?// </slot>"), F.concat(F.lit("// <slot>\n"), snippet, F.lit("\n// </slot>"))))
