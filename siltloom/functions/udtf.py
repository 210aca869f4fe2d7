"""The extractors as table functions for SQL: SELECT u.unit_id, f.* FROM units u, LATERAL source_functions(u.content) f."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from siltloom.functions import code, html
from siltloom.operators.retrieval import DOCUMENT_SEPARATORS, INDEX_SEPARATORS, split_text


@udtf(returnType="pos int, import_type string, module_name string, name string, alias string")
class SourceImports:
    def eval(self, text: str):
        for r in code.imports(text or ""):
            yield r["pos"], r["import_type"], r["module_name"], r["name"], r["alias"]


@udtf(returnType="pos int, name string, content string")
class SourceFunctions:
    def eval(self, text: str):
        for r in code.functions(text or ""):
            yield r["pos"], r["name"], r["content"]


@udtf(returnType="pos int, name string, var_type string, value string, modifiers array<string>")
class SourceVariables:
    def eval(self, text: str):
        for r in code.variables(text or ""):
            yield r["pos"], r["name"], r["type"], r["value"], r["modifiers"]


@udtf(returnType="kind string, name string, content string")
class SourceDeclarations:
    def eval(self, text: str):
        for r in code.declarations(text or ""):
            yield r["type"], r["name"], r["content"]


@udtf(returnType="pos int, pre string, kind string, function_call string, function_name string")
class PageExamples:
    def eval(self, text: str):
        for r in html.code_examples(text):
            yield r["pos"], r["pre"], r["type"], r["function_call"], r["function_name"]


@udtf(returnType="pos int, piece string")
class TextChunks:
    def eval(self, text: str, size: int, overlap: int, documents: bool):
        for i, piece in enumerate(split_text(text or "", size, overlap, DOCUMENT_SEPARATORS if documents else INDEX_SEPARATORS)):
            yield i, piece


FUNCTIONS = {"source_imports": SourceImports, "source_functions": SourceFunctions, "source_variables": SourceVariables, "source_declarations": SourceDeclarations, "page_examples": PageExamples, "text_chunks": TextChunks}


def register(spark: SparkSession) -> None:
    """Registers all of them under the names of FUNCTIONS."""
    for name, function in FUNCTIONS.items():
        spark.udtf.register(name, function)
