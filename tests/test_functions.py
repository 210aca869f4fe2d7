import numpy as np
import pytest
from pyspark.sql import functions as F

from siltloom.functions import code, html, similarity
from siltloom.functions import text as T
from siltloom.operators import images


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t")).alias("x")).first().x


PAGE = """import { router } from '@kit.ArkUI'
import hilog from '@kit.Hilog';
import { A as B, C } from './local';
/* block */
export interface Shape extends Base, Other { size: number }
export class Box extends Thing implements Shape, Named { }
@Entry
@Component
struct Index {
  @State message: string = 'Hello { // World';
  private list: number[] = [1,
    2];
  build() {
    Column() {
      Text(this.message).fontSize(20)
      Row({ space: 5 }) { Button('ok').onClick(() => { go(); }) }
        .width('100%')
      // note
      this.part()
    }
  }
  @Builder part() { Text('x') }
  load(name: string, n?: number): void { if (n) { run("}"); } }
  static empty() { return 1; }
}
"""


def test_strip_comments():
    assert code.strip_comments("a // x\n'//' + b // c\n\n/* d\n */\ne") == "a\n'//' + b\ne"
    assert code.strip_comments("") == ""
    assert code.strip_comments_deep({"a": ["x // y", 1]}) == {"a": ["x", 1]}


def test_imports():
    got = code.imports(PAGE)
    assert [(r["import_type"], r["module_name"], r["name"], r["alias"]) for r in got] == [("named", "@kit.ArkUI", "router", None), ("default", "@kit.Hilog", "hilog", None), ("named", "./local", "A", "B"), ("named", "./local", "C", None)]


def test_structure():
    kinds = [(d["type"], d["name"], d["extends"], d["implements"]) for d in code.declarations(PAGE)]
    assert ("interface", "Shape", ["Base", "Other"], []) in kinds and ("class", "Box", ["Thing"], ["Shape", "Named"]) in kinds
    blocks, rest = code.ui_blocks(PAGE)
    assert [b["name"] for b in blocks] == ["build", "part"] and "Column" not in rest
    found = {v["name"]: v for v in code.variables(rest)}
    assert found["message"]["modifiers"] == ["@State"] and found["list"]["value"].endswith("2]") and "size" not in found
    assert [f["name"] for f in code.functions(rest)] == ["load", "empty"]
    assert code.functions(rest)[0]["content"].endswith('run("}"); } }')


def test_children_and_parts():
    parts = code.build_parts(PAGE)
    kids = code.children(parts[1])
    assert [k.split("(")[0] for k in kids] == ["Text", "Row", "this.part"]
    assert kids[1].endswith(".width('100%')")
    assert "onClick" not in code.remove_handlers(PAGE) and "Button('ok')" in code.remove_handlers(PAGE)
    assert code.build_parts("nothing") is None and code.children("") == []


def test_repairs():
    broken = "ForEach(this.a, (x) => {\n  Text(x)\n}\nText('b')"
    assert code.close_foreach(broken) == "ForEach(this.a, (x) => {\n  Text(x)\n})\nText('b')"
    assert code.close_foreach("ForEach(a, (x) => { T(x) })") == "ForEach(a, (x) => { T(x) })"
    assert code.strip_styles("Text('a').width(10).onClick(f)") == "Text('a').onClick(f)"
    assert code.resolve_resources("Text($r('app.string.a')) $r('app.string.b') $r('app.media.c')", {"string.a": "hi"}) == "Text('hi') $r('app.string.b') $r('app.media.startIcon')"
    assert code.resolve_path("p/a/b.ets", "../c/d") == "p/c/d.ets" and code.resolve_path("p/a.ets", "@kit.x") is None


def test_java():
    src = "import android.widget.Toast;\nclass A {\n  private Toast toast;\n  public void run(int x) {\n    if (x > 1) { toast.show(); }\n    other.call();\n  }\n}"
    assert [f["name"] for f in code.java_functions(src)] == ["run"]
    assert code.java_api_calls(src) == [{"class": "android.widget.Toast", "method": "show", "line": 5}]


def test_fim():
    for seed in range(20):
        r = code.fim_random(PAGE, "k", seed)
        assert r == code.fim_random(PAGE, "k", seed)
        assert "".join(r[k] for k in ("above", "start", "target", "end", "follow")) == PAGE and r["target"].strip()
    assert code.fim_random("no head", "k") is None
    assert code.fim_prioritised("function f() { abcd }")["split"] == "function"
    assert code.fim_prioritised("class A { a() { b() {")["split"] in ("control", "line", "expression")
    assert code.fim_prioritised("if (a) { bcd }")["split"] == "control"
    assert code.fim_prioritised("a; b; c")["target"] == "b"
    assert code.fim_prioritised("a\n\nb")["target"] == "b" and code.fim_prioritised("")["split"] == "none"
    kinds = [c["kind"] for c in code.fim_candidates("function f() { a }\nit('x', 0, () => {\n  1\n  2\n})\n build() { B() }")]
    assert kinds == ["function", "test", "build"]


def test_text_columns(spark):
    assert one(spark, T.clean_code, "a = 'x#y' // z\n\tb") == "a = '...' //\n    b"
    assert one(spark, T.code_tokens, "f(a.b) => {x:1}") == ["f", "(", "a", ".", "b", ")", "=>", "{", "x", ":", "1", "}"]
    for config, want in (('"compileSdkVersion": 9', False), ('"compileSdkVersion": 10', True), ('"compatibleSdkVersion": "5.0.1(13)"', True), ('"compatibleSdkVersion": "4.1"', False), ("", False), (None, False), ('"compileSdkVersion": 9, "compatibleSdkVersion": 12', False)):
        assert one(spark, T.sdk_version_passes, config) is want
    assert one(spark, lambda c: T.safe_json(c, "a int"), "{a: 1,}").a == 1
    assert one(spark, lambda c: T.safe_json(c, "a int"), "nope") is None
    assert one(spark, T.json_slice, 'x {"a": 1} y') == '{"a": 1}' and one(spark, T.json_slice, "{") is None
    assert one(spark, T.fenced, "a ```xml\n<b/>\n``` c") == "<b/>" and one(spark, T.fenced, "plain") == "plain"
    assert one(spark, T.import_features, "import A, { B as C, D } from 'm';\nimport E from 'n'") == ["A@m", "B@m", "D@m"]
    assert one(spark, T.import_lines, "import a.b\n x\nimport {c} from @d") == ["import a.b", "import {c} from @d"]
    assert one(spark, T.boosted_query, "import a\nb") == "import a\nb import aimport a"
    assert one(spark, T.url_file_name, "https://h.org/a/b?c=1") == "h.org_a_b.html"
    assert one(spark, T.fim_normal, "a\xa0'b'\n`c`") == "abc"
    assert one(spark, T.unescape_newlines, "a\\nb") == "a\nb"
    assert [tuple(r) for r in one(spark, T.aliased_imports, "import { A as B, C } from 'm'")] == [("A", "B", "m"), ("C", "C", "m")]
    assert one(spark, T.composables, "@Composable fun A() { x }")[0].startswith("@Preview\n")
    assert one(spark, T.exported_names, "export class A {} export default function b() {}") == ["A", "b"]
    assert one(spark, T.file_type, "@Entry @Component struct X") == "Page" and one(spark, T.file_type, "") == "Service"
    assert one(spark, code.strip_comments_column, "a // b") == "a"


HTML = r"""<body><article><h1>T</h1><p>a&nbsp;b<p><b>c</p></article><script>var x = "</p>";</script>
<div class="section"><h4>导入模块</h4><pre class="typescript">import { a } from 'b'</pre></div>
<div class=\"section\"><h4>run</h4>run(x: number): void<pre class="ts">a.run(1) { return longer than sixty four characters so it is no import at all }</pre></div>
<div id=\"枚举\"><table><tr><th>名称</th><th>值</th></tr><tr><td>A</td><td>1</td></tr><tr><td>odd</td></tr></table></div>
<a href="/x/y">1</a> <a href='//h.org/x/z'>2</a> <a href="https://h.org/q">3</a><a href="#top">4</a></body>"""


def test_html(spark):
    assert html.article_text(HTML) == "Ta b\nc" or html.article_text(HTML).replace("\n", "") == "Ta bc"
    assert html.article_text("") == "" and html.article_text(None) == ""
    found = html.code_examples(HTML)
    assert [r["type"] for r in found] == ["Import", "Reference"] and found[1]["function_name"] == "run"
    assert html.tables(HTML) == [[{"名称": "A", "值": "1"}]]
    assert html.tables(HTML, strict=False)[0][1] == {"名称": "odd"}
    assert {(r["kind"], r["name"]) for r in html.page_records("u", HTML)} >= {("enum", "A"), ("module", "T")}
    assert html.page_records("u", "<body><div><h4>t</h4>x</div></body>")[0]["kind"] == "fallback"
    assert one(spark, lambda c: html.links(c, "https://h.org/x"), HTML) == ["https://h.org/x/y", "https://h.org/x/z"]
    pages = spark.createDataFrame([("b.html", HTML), ("a.html", HTML), ("c.html", None)], "file_path string, html string")
    got = html.reference_rows(pages).orderBy("id").collect()
    assert [r.id for r in got] == [1, 2, 3, 4] and got[1].import_module == got[0].pre and got[0].file_path == "a.html"
    assert html.record_rows(pages.withColumnRenamed("file_path", "url")).count() > 2


def test_images(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 255, (40, 40, 3)).astype(float)
    assert similarity.mse(a, a) == 0 and similarity.hamming(similarity.dhash(a), similarity.dhash(a)) == 0
    assert similarity.dhash(a[..., 0]) < 1 << 64
    assert abs(similarity.histogram_correlation(a, a) - 1) < 1e-9
    assert similarity.hamming(similarity.phash(a), similarity.phash(a + 1)) <= 5
    assert similarity.report(a, a, (a.ravel(), a.ravel()))["cosine"] > 0.999
    image = {"pixels": a.ravel().tolist(), "height": 40, "width": 40}
    schema = "id long, image struct<pixels:array<double>,height:int,width:int>"
    df = spark.createDataFrame([(1, image), (2, None)], schema)
    assert images.hashes(df).count() == 1
    pairs = df.where("id = 1").select("id", F.col("image").alias("a"), F.col("image").alias("b"))
    assert images.reports(pairs).first().mse == 0


def test_lookup_and_inline():
    assert code.lookup(PAGE, "Box").startswith("export class Box") and code.lookup(PAGE, "load").endswith("}")
    assert code.lookup(PAGE, "nothing") is None
    page = "import { helper as h, other } from './lib';\nh();"
    got = code.inline_symbol(page, "export function helper(a: number) { return helper(a); }", "helper", "h")
    assert "import { other } from './lib';" in got and "function h(a: number) { return h(a); }" in got
    assert code.inline_symbol(page, "", "helper") == page
    assert code.latin_initials("中x文", {"中": "z", "文": "w"}) == "zxw"


def test_table_functions(spark):
    from siltloom.functions import udtf

    udtf.register(spark)
    spark.createDataFrame([(1, PAGE), (2, None)], "id long, content string").createOrReplaceTempView("pages_of_test")
    names = [r.name for r in spark.sql("SELECT p.id, f.name FROM pages_of_test p, LATERAL source_imports(p.content) f ORDER BY f.pos").collect()]
    assert names == ["router", "hilog", "A", "C"]
    assert spark.sql("SELECT f.* FROM pages_of_test p, LATERAL text_chunks(p.content, 80, 10, true) f").count() > 3
    for call in ("source_functions(p.content)", "source_variables(p.content)", "source_declarations(p.content)"):
        assert spark.sql(f"SELECT f.* FROM pages_of_test p, LATERAL {call} f").count() > 0
    spark.sql("SELECT f.* FROM pages_of_test p, LATERAL page_examples(p.content) f").count()


def test_folder_names(spark):
    got = [(one(spark, T.folder_prefix, n), one(spark, T.folder_number, n)) for n in ("a_12", "a", "a_b_3", "a_x")]
    assert got == [("a", 12), ("a", 0), ("a_b", 3), ("a_x", 0)]


def test_png_round_trip_and_filters():
    import struct
    import zlib

    from siltloom.sources import pictures

    rng = np.random.default_rng(1)
    for shape in ((5, 7), (3, 4, 3), (1, 1)):
        pixels = rng.integers(0, 256, shape)
        assert (pictures.decode_png(pictures.encode_png(pixels)).reshape(shape) == pixels).all()
    # every filter, by hand: each row of three pixels of four samples is filtered in its own way
    rows = rng.integers(0, 256, (5, 12)).astype(int)
    raw, above = b"", [0] * 12
    for kind, row in enumerate(rows):
        line = []
        for x in range(12):
            a, b, c = (row[x - 4] if x >= 4 else 0), above[x], (above[x - 4] if x >= 4 else 0)
            p = a + b - c
            line.append((row[x] - (0, a, b, (a + b) // 2, min((a, b, c), key=lambda v: abs(p - v)))[kind]) & 255)
        raw += bytes([kind, *line])
        above = row
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + b"0000"
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 3, 5, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw))
    assert (pictures.decode_png(data).reshape(5, 12) == rows).all()
    for bad in (b"", b"JFIF", data[:40], data[:-30]):
        with pytest.raises(ValueError):
            pictures.decode_png(bad)


def test_java_calls_by_tokens():
    src = "import android.app.Dialog;\nimport android.os.Handler;\nimport java.util.List;\nclass A {\n  Dialog d = new Dialog(1), e;\n  void f(final Handler... h) {\n    for (Dialog x : all) { x.show(); }\n    if (o instanceof Dialog) { e.hide(); }\n    h.post(() -> d.cancel());\n    this.d.dismiss(); // d.no()\n    List<Dialog> l; l.add(d); Handler.main(\"d.never()\");\n  }\n}"
    got = [(r["class"].rpartition(".")[2], r["method"], r["line"]) for r in code.java_api_calls(src)]
    assert got == [("Dialog", "show", 7), ("Dialog", "hide", 8), ("Handler", "post", 9), ("Dialog", "cancel", 9), ("Dialog", "dismiss", 10), ("Handler", "main", 11)]
    assert code.java_api_calls("") == [] and code.java_api_calls("import android.a.B") == []
