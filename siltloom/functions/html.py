"""Structure of HTML documents, with a small tree builder over the standard library's tolerant parser."""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltloom.common import durable, map_rows

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset(["script", "style"])
#: Section headings of the crawled reference pages.
IMPORT_HEADING = "导入模块"
EXAMPLE_HEADINGS = ("示例：", "请求示例", "响应示例")
SHORT_IMPORT, SHORT_PARENT = 64, 48
CODE_CLASSES = frozenset(["typescript", "screen", "ts"])


class Node:
    """An element with attributes, children (nodes and texts) and its parent."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def find_all(self, *tags: str, **attrs: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags and all(v in n.attrs.get(k.rstrip("_"), "").split() or n.attrs.get(k.rstrip("_")) == v for k, v in attrs.items())]

    def find(self, *tags: str, **attrs: str) -> Node | None:
        return next(iter(self.find_all(*tags, **attrs)), None)

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else "" if c.tag in _RAW else c.text() for c in self.children)

    def markup(self) -> str:
        inner = "".join(c if isinstance(c, str) else c.markup() for c in self.children)
        attrs = "".join(f' {k}="{v}"' for k, v in self.attrs.items())
        return f"<{self.tag}{attrs}>" if self.tag in _VOID else f"<{self.tag}{attrs}>{inner}</{self.tag}>"


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None)
        self.at = self.root

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "p" and self.at.tag == "p":
            self.at = self.at.parent
        node = Node(tag, {k: (v or "").replace('\\"', "").strip('"') for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    """The tree of a page, however broken; quotes escaped by an earlier JSON step are taken as quotes."""
    builder = _Builder()
    if html:
        builder.feed(html.replace('\\"', '"'))
        builder.close()
    return builder.root


def article_text(html: str | None) -> str:
    """The first article's lines, stripped, without blank ones; '' without an article."""
    node = parse(html).find("article")
    if node is None:
        return ""
    return "\n".join(line for line in (s.strip() for s in node.text().replace("\xa0", " ").split("\n")) if line)


def page_text(html: str | None) -> str:
    return parse(html).text()


def body(html: str | None) -> str:
    node = parse(html).find("body")
    return node.markup() if node else ""


def table_records(table: Node, strict: bool = True) -> list[dict[str, str]]:
    """Rows as header-to-cell maps.  strict: rows of another length are left out; else short rows are kept, long ones cut."""
    rows = [r.find_all("th", "td") for r in table.find_all("tr")]
    if not rows:
        return []
    head = [c.text().strip() for c in rows[0]]
    out = []
    for cells in rows[1:]:
        texts = [c.text().strip() for c in cells]
        if strict and len(texts) != len(head):
            continue
        out.append(dict(zip(head, texts)))
    return out


def tables(html: str | None, strict: bool = True) -> list[list[dict[str, str]]]:
    return [table_records(t, strict) for t in parse(html).find_all("table")]


@dataclass
class _Example:
    """A section's first code block and what is said about it."""

    code: str
    css: str  # the block's class attribute
    scope: Node  # the element around the block, without it

    @property
    def said(self) -> str:
        return self.scope.text()


#: When a block is left out, and when it is an import; the first kind whose rule holds is taken.
_LEFT_OUT: list[Callable[[_Example], bool]] = [
    lambda e: e.css == "screen" and "{" not in e.code,
    lambda e: "Java" in e.said or "java" in e.code,
]
_EXAMPLE_KINDS: list[tuple[str, Callable[[_Example], bool]]] = [
    ("Import", lambda e: IMPORT_HEADING in e.said or "{" in e.code and len(e.code) <= SHORT_IMPORT),
    ("Reference", lambda e: True),
]


def _signatures(text: str) -> Iterator[str]:
    """What looks like a declared call: a name, brackets that are empty or begin with ``name:``, an arrow or a result type."""
    for m in re.finditer(r"(?:\w+\s)?\w+\s?(?:=\s?)?\(", text):
        close = text.find(")", m.end())
        if close < 0:
            return
        inside = text[m.end() : close]
        if not inside.strip() or re.match(r"\s?(?:\.\.\.)?\w+\??\s?:\s?\S", inside):
            tail = re.match(r"\s*(?:=>\s?)?(?::\s?\w+\s?)?", text[close + 1 :])
            yield (text[m.start() : close + 1] + tail[0]).strip()


def code_examples(html: str | None) -> list[dict]:
    """The first code block of each section with its context.

    A block is an import where its surroundings say so or where it is short and has a brace; sections in Java are
    left out; a parent of only a heading is climbed.  The last signature in the parent is the function call.
    """
    out = []
    for section in parse(html).find_all("div", class_="section"):
        block = next((p for p in section.find_all("pre") if CODE_CLASSES.intersection(p.attrs.get("class", "").split())), None)
        if block is None:
            continue
        example = _Example(block.text(), block.attrs["class"], block.parent)
        example.scope.children.remove(block)
        if any(rule(example) for rule in _LEFT_OUT):
            continue
        kind = next(name for name, rule in _EXAMPLE_KINDS if rule(example))
        only_heading = len(example.said) <= SHORT_PARENT and any(h in example.said for h in EXAMPLE_HEADINGS)
        around = (only_heading and example.scope.parent) or example.scope
        heading = around.find("h4")
        out.append({"pos": len(out), "pre": example.code, "type": kind, "function_call": deque(_signatures(around.markup()), maxlen=1), "function_name": heading.text() if heading else None, "parent_text": around.text()})
    for record in out:
        record["function_call"] = record["function_call"].pop() if record["function_call"] else None
    return out


def _section(root: Node, name: str) -> Node | None:
    return root.find("div", id=name)


def _records(kind: str, rows: list[dict], **more: str) -> list[dict]:
    return [{"kind": kind, "name": r.get("名称") or r.get("参数名") or next(iter(r.values()), ""), "fields": {**more, **r}} for r in rows]


#: What the words above a table or a text say that it holds; a table without such a word holds parameters.
LABELS = {"参数": "parameters", "返回": "returns", "错误码": "errors", "成员": "members", "枚举": "values", "示例": "example", "起始版本": "since", "系统能力": "capability", "需要权限": "permission", "元服务": "service"}


def _label(text: str) -> str | None:
    return next((name for word, name in LABELS.items() if word in text), None)


def _flow(node: Node) -> Iterator[Node]:
    """The headings, paragraphs, tables and code blocks below a node in their order, none inside another."""
    for child in node.children:
        if isinstance(child, Node):
            if child.tag in ("h4", "h5", "h6", "p", "strong", "table", "pre"):
                yield child
            else:
                yield from _flow(child)


def _described(kind: str, part: Node) -> dict:
    """A function, interface, event or class of a page: its name, what is said first, its tables as JSON by what the words
    above them say, its first code block, and the facts that a paragraph names with a colon."""
    heading = part.find("h4")
    fields: dict[str, str] = {}
    above = ""
    for node in _flow(part):
        text = node.text().replace("\xa0", " ").strip()
        if node is heading:
            continue
        if node.tag == "table":
            name = _label(above) or "parameters"
            rows = json.loads(fields[name]) if name in fields else []
            fields[name] = json.dumps(rows + table_records(node, strict=False), ensure_ascii=False)
        elif node.tag == "pre":
            fields.setdefault("example", text)
        else:
            fact, colon, value = re.sub("：", ":", text, count=1).partition(":")
            if colon and value.strip() and (name := _label(fact)):
                fields[name] = value.strip()
            elif _label(text) is None and text:
                fields.setdefault("text", text)
            above = text
    return {"kind": kind, "name": heading.text().strip(), "fields": fields}


#: Ids of the sections by what they describe.
SECTIONS = {"成员变量": "class", "枚举": "enum", "枚举类型说明": "enum", "函数说明": "function", "类型定义": "typedef", "pub-attribs": "struct", "子组件": "component", "接口": "component", "属性": "attribute", "事件": "event"}


def page_records(url: str | None, html: str | None) -> list[dict]:
    """Everything a reference page describes, as (kind, name, fields): error codes, enums, functions, classes, types,
    structs, components, modules.  Several kinds may come from one page; where none does, each top division is one
    fallback record of heading and text.
    """
    root = parse(html)
    out: list[dict] = []
    if re.search(r"err(?:or)?-?code", url or ""):
        for section in root.find_all("div", class_="section"):
            heading = section.find("h4", "h3", "h2")
            code = re.match(r"\s*(\d+)\s*(.*)", heading.text()) if heading else None
            if code:
                parts = dict(re.findall(r"(错误信息|错误描述|可能原因|处理步骤)\s*[:：]?\s*([^\n]*(?:\n(?!错误信息|错误描述|可能原因|处理步骤)[^\n]*)*)", section.text()))
                out.append({"kind": "errorcode", "name": code[1], "fields": {"title": code[2].strip(), **{k: v.strip() for k, v in parts.items()}}})
    for name, kind in SECTIONS.items():
        section = _section(root, name)
        if section is None:
            continue
        parts = [p for p in section.find_all("div", class_="section") if p.find("h4") is not None and not p.find_all("div", class_="section")]
        if kind in ("function", "component", "event", "class") and parts:
            found = [_described(kind, part) for part in parts]
        else:
            found = [r for t in section.find_all("table") for r in _records(kind, table_records(t, strict=False))]
        if kind == "typedef":
            for r in found:
                value = " ".join(r["fields"].values())
                r["fields"]["category"] = "callback" if "=>" in value or "(" in r["name"] else "alias"
        out += found
    strong = next((s for s in root.find_all("strong") if s.text().startswith("起始版本")), None)
    module = next((h for h in root.find_all("h4") if IMPORT_HEADING in h.text()), None)
    if strong is not None or module is not None:
        out.append({"kind": "module", "name": (root.find("h1") or Node("", {}, None)).text().strip(), "fields": {"since": strong.parent.text().strip() if strong is not None else ""}})
    if not out:
        top = root.find("body") or root
        for node in top.children:
            if isinstance(node, Node) and node.tag == "div":
                heading = node.find("h4")
                out.append({"kind": "fallback", "name": heading.text().strip() if heading else "", "fields": {"text": node.text().strip()}})
    return [{"pos": i, **r} for i, r in enumerate(out)]


def links(html: Column, base: str) -> Column:
    """Absolute, protocol-relative and root-relative targets of page links that lie under ``base``; others are dropped."""
    host = re.match(r"^(https?:)//([^/]+)", base)
    found = F.regexp_extract_all(html, F.lit(r"<a\s[^>]*?href\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1))
    full = F.transform(found, lambda h: F.when(h.rlike("^https?://"), h).when(h.startswith("//"), F.concat(F.lit(host[1]), h)).when(h.startswith("/"), F.concat(F.lit(f"{host[1]}//{host[2]}"), h)))
    return F.filter(full, lambda h: h.isNotNull() & h.startswith(base))


def reference_rows(pages: DataFrame, path: str = "file_path", html: str = "html") -> DataFrame:
    """The code examples of all pages, numbered through, each reference with the last import before it on its page."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for where, text in rows:
            for r in code_examples(text):
                yield where, r["pos"], r["pre"], r["type"], r["function_call"], r["function_name"], r["parent_text"]

    found = map_rows(pages.select(path, html), run, "file_path string, pos int, pre string, type string, function_call string, function_name string, parent_text string")
    before = Window.partitionBy("file_path").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = found.withColumn("import_module", F.when(F.col("type") == "Reference", F.last(F.when(F.col("type") == "Import", F.col("pre")), ignorenulls=True).over(before)))
    return numbered(carried, ["file_path", "pos"])


def numbered(df: DataFrame, keys: list[str], to: str = "id") -> DataFrame:
    """Rows numbered from 1 in the order of the keys, without one task for all: a range sort, then offsets per partition."""
    # written, so that both uses below see the same partitions
    parts = durable(df.repartitionByRange(*keys).withColumn("__p", F.spark_partition_id()))
    sizes = parts.groupBy("__p").count()
    offsets = sizes.withColumn("__before", F.coalesce(F.sum("count").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__p", "__before")
    own = Window.partitionBy("__p").orderBy(*keys)
    return parts.withColumn("__n", F.row_number().over(own)).join(offsets, "__p").withColumn(to, F.col("__before") + F.col("__n")).drop("__p", "__n", "__before")


def table_rows(pages: DataFrame, key: str = "url", html: str = "html", strict: bool = True) -> DataFrame:
    """(key, table, pos, cells) of every row of every table, cells by their heading; numbers from 0."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for where, text in rows:
            for i, found in enumerate(tables(text, strict)):
                for j, cells in enumerate(found):
                    yield where, i, j, list(cells.items())

    return map_rows(pages.select(key, html), run, f"{key} {dict(pages.dtypes)[key]}, table int, pos int, cells map<string,string>")


def articles(pages: DataFrame, key: str = "url", html: str = "html") -> DataFrame:
    """(key, text): the article of each page, '' where there is none."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for where, text in rows:
            yield where, article_text(text)

    return map_rows(pages.select(key, html), run, f"{key} {dict(pages.dtypes)[key]}, text string", block=512)


def record_rows(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, pos, kind, name, fields) of every reference page."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for where, text in rows:
            for r in page_records(where, text):
                yield where, r["pos"], r["kind"], r["name"], list(r["fields"].items())

    return map_rows(pages.select(url, html), run, "url string, pos int, kind string, name string, fields map<string,string>")
