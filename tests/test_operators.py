import json

import pytest
from pyspark.sql import functions as F

from siltloom.functions.html import numbered
from siltloom.operators import dataset, graph, mutate, relational, retrieval
from siltloom.sources import files, sinks
from siltloom.streaming import feeds
from tests.test_functions import PAGE


def test_chunks_keep_everything_in_bounds():
    text = "para one is here\n\n" + "word " * 120 + "。" + "x" * 400
    got = retrieval.split_text(text, 100, 20, ("\n\n", "\n", " ", ""))
    assert all(0 < len(c) <= 100 for c in got) and got[0].startswith("para one")
    assert retrieval.split_text("", 10, 2, ("\n",)) == []


def test_topk_with_padding_equals_full_scan(spark):
    docs = spark.createDataFrame([(i, [f"t{i}", "c"] if i % 3 else [f"t{i}"]) for i in range(12)], "doc_id long, terms array<string>")
    queries = spark.createDataFrame([(1, ["t0"]), (2, ["zz"]), (3, ["c"])], "query_id long, terms array<string>")
    got = {(r.query_id, r.rank): r.doc_id for r in retrieval.jaccard_topk(queries, docs, 3, pad=True).collect()}
    assert [got[1, k] for k in (1, 2, 3)] == [0, 1, 2] and [got[2, k] for k in (1, 2, 3)] == [0, 1, 2] and [got[3, k] for k in (1, 2, 3)] == [1, 2, 4]


def test_fuse_ties(spark):
    a = spark.createDataFrame([(1, 10, 0.0, 1), (1, 11, 0.5, 2)], "query_id long, doc_id long, score double, rank int")
    b = spark.createDataFrame([(1, 11, 1.0, 1), (1, 12, 0.0, 2)], "query_id long, doc_id long, score double, rank int")
    assert [r.doc_id for r in retrieval.fuse(a, b).orderBy("rank").collect()] == [11, 10, 12]
    assert retrieval.fuse(a, b, cut=1).count() == 1
    assert retrieval.blend(a, b).count() == 3


def test_enrich_filters_late(spark):
    fused = spark.createDataFrame([(1, 10, 0.9, 1), (1, 11, 0.8, 2)], "query_id long, doc_id long, score double, rank int")
    examples = spark.createDataFrame([(10, "Import", "a", "b"), (11, "Reference", "c", "d")], "doc_id long, type string, code_snippet string, parent_text string")
    rows = spark.createDataFrame([(1,), (2,)], "query_id long")
    got = {r.query_id: [e.id for e in r.similar_examples] for r in retrieval.enrich(rows, fused, examples).collect()}
    assert got == {1: [11], 2: []}


def test_vectors_in_blocks(spark):
    data = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(50)]
    v = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    q = v.where("vec_id < 20").withColumnRenamed("vec_id", "query_id")
    one, many = retrieval.vector_topk(q, v, 3), retrieval.vector_topk(q, v, 3, block=3)
    key = lambda df: sorted((r.query_id, r.rank, r.vec_id) for r in df.collect())
    assert key(one) == key(many) and len(key(one)) == 60
    assert retrieval.vector_topk(q, v, 1, metric="l2").where("score > 0.999").count() == 20


def test_roots_ready_and_products(spark):
    paths = ["a/build-profile.json5", "a/hvigorfile.ts", "a/b/build-profile.json5", "a/b/hvigorfile.ts", "c/hvigorfile.ts", "d/e/build-profile.json5", "d/e/hvigorfile.ts"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert sorted(r.root for r in relational.project_roots(df).collect()) == ["a", "d/e"]
    ready = spark.createDataFrame([("2", "ets"), ("2", "txt"), ("10", "ets"), ("10", "txt"), ("10", "json"), ("x", "ets"), ("1", "ets"), ("1", "txt")], "folder string, ext string")
    assert [r.folder for r in relational.ready_folders(ready).collect()] == [1, 2]
    products = spark.createDataFrame([([("a", "12", "10", "OpenHarmony"), ("b", "9", "y", "z")],), ([("a", "9", "x", "z")],)], "p array<struct<name:string,compileSdkVersion:string,compatibleSdkVersion:string,runtimeOS:string>>")
    got = [r.q for r in products.select(relational.rewrite_products(F.col("p")).alias("q")).collect()]
    assert [tuple(x) for x in got[0]] == [("a", None, "4.0.0(10)", "HarmonyOS"), ("b", None, "y", "z")]
    assert [tuple(x) for x in got[1]] == [("a", "9", "x", "z")]


def test_last_declaration_and_siblings(spark):
    d = spark.createDataFrame([("f", "x", "A", 1), ("f", "x", "B", 2)], "file string, name string, class string, order int")
    c = spark.createDataFrame([("f", "x", "m"), ("f", "y", "n")], "file string, name string, method string")
    i = spark.createDataFrame([("f", "B", "android.B")], "file string, name string, full string")
    assert sorted((r.name, r.full) for r in relational.last_declared(d, c, i).collect()) == [("x", "android.B"), ("y", "y")]
    s = spark.createDataFrame([("1", "ets", "a.ets", "A"), ("1", "ets", "b.ets", "B"), ("1", "txt", "a.txt", "T"), ("2", "ets", "a.ets", "X")], "folder string, ext string, name string, content string")
    got = relational.sibling_files(s, ("ets", "txt")).collect()
    assert [(r.folder, r.ets, r.txt) for r in got] == [("1", "B", "T")]


def test_small_relational(spark):
    df = spark.createDataFrame([(1, "a.test.ets"), (2, None), (3, "b")], "id long, name string")
    assert relational.test_files(df, "name").count() == 2 and relational.test_files(df, "name", dry_run=True).count() == 1
    assert relational.has_key(spark.createDataFrame([('{ "x": { "compatibleSdkVersion" : 1 } }',), ("{}",)], "t string"), "t").count() == 1
    old, new = spark.createDataFrame([("a", 1, 5), ("b", 1, 5)], "k string, v int, version int"), spark.createDataFrame([("a", 2, 1), ("a", 3, 2)], "k string, v int, version int")
    assert sorted((r.k, r.v) for r in relational.merged_maps(old, new, "k").collect()) == [("a", 3), ("b", 1)]
    assert [r.section for r in relational.config_rows("[s]\nk = v\n")] == ["s"]
    maps = spark.createDataFrame([({"a": [1, 2], "b": []},), (None,)], "m map<string,array<int>>")
    assert relational.map_list_count(maps, "m").first().entries == 2
    names = spark.createDataFrame([("x", 1), ("x", 2)], "b string, o int")
    assert sorted(r.unique_name for r in relational.numbered_names(names, "b", "o", first_bare=True).collect()) == ["x", "x_1"]
    assert relational.api_calls_only(spark.createDataFrame([("android.A",), ("java.B",)], "class string")).count() == 1
    assert relational.second_elements(spark.createDataFrame([(["a", "b"],), (["a"],), (None,)], "x array<string>"), "x").where("second = ''").count() == 2


def test_balanced_split_is_ntile(spark):
    for n in (1, 3, 5, 8):
        df = spark.range(7).withColumnRenamed("id", "k")
        got = [r.bucket for r in relational.balanced_split(df, "k", n).orderBy("k").collect()]
        want = [r.b for r in df.selectExpr("k", f"ntile({n}) over (order by k) as b").orderBy("k").collect()]
        assert got == want
    assert [r.id for r in numbered(spark.range(20).selectExpr("id as k"), ["k"]).orderBy("k").collect()] == list(range(1, 21))


def test_graph(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("e", "a")], "src string, dst string")
    roots = spark.createDataFrame([("a",), ("e",)], "root string")
    got = {(r.root, r.node): r.depth for r in graph.closure(edges, roots).collect()}
    assert got["a", "d"] == 3 and got["e", "d"] == 4 and got["a", "a"] == 0 and len(got) == 9
    assert sorted(r.node for r in graph.cyclic_nodes(edges).collect()) == ["a", "b", "c"]
    between = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 4), (4, 5), (5, 4), (6, 6), (7, 1), (5, 8), (9, 10), (10, 11), (11, 9), (11, 10)], "src long, dst long")
    assert sorted(r.node for r in graph.cyclic_nodes(between).collect()) == [1, 2, 4, 5, 6, 9, 10, 11]  # 3 only lies between two
    assert graph.cyclic_nodes(between.where("src = 7")).count() == 0
    crawl = graph.frontier_crawl(edges, spark.createDataFrame([("e",)], "url string"), 2)
    assert sorted((r.url, r.depth) for r in crawl.collect()) == [("a", 1), ("b", 2), ("e", 0)]


def test_dataset(spark, rows):
    units = spark.createDataFrame([(1, PAGE), (2, None), (3, "x")], "unit_id long, content string")
    split = dataset.fim_split(units)
    assert split.count() == 1
    whole = split.withColumn("original_code", F.lit(PAGE))
    assert dataset.fim_check(whole).first().whole
    assert dataset.fim_prioritised(units).count() == 3
    context = spark.createDataFrame([(1, "b", "B"), (1, "a", "A")], "unit_id long, path string, content string")
    assert dataset.fim_records(split, context).first().xl_context == ["A", "B"]
    fails = iter([RuntimeError(), None])

    def call(p, k):
        e = next(fails, None)
        if e:
            raise e
        return f"{k}:{p}"

    assert dataset.with_retries(call, ["k1", "k2"], wait=lambda s: None)(["p"]) == ["k2:p"]
    made = dataset.generate(units, F.coalesce("content", F.lit("")), lambda ps: [p[:1] or None for p in ps], "unit_id")
    assert rows(made) == [("1", "i"), ("3", "x")]
    assert dataset.embed(units, "unit_id", "content", lambda ts: [[float(len(t))] for t in ts]).count() == 3
    pairs = spark.createDataFrame([("p", "code", "text"), ("", "", "t")], "prompt string, ets string, txt string")
    assert dataset.sft_records(pairs, "do").count() >= 1


def test_mutation_is_seeded_and_whole(spark):
    for seed in range(30):
        made = mutate.mutate_page(PAGE, "k", seed)
        assert made == mutate.mutate_page(PAGE, "k", seed)
        assert "this.part()" in made or "Stack(" in made  # protected from deletion; a stack takes no such children
    assert len({mutate.mutate_page(PAGE, "k", s) for s in range(10)}) > 3
    assert mutate.mutate_page("nothing", "k") is None
    joined = mutate.merge_pages(PAGE, PAGE.replace("hilog", "other"), "k")
    assert "import { router" in joined and mutate.merge_pages("x", PAGE, "k") is None
    df = spark.createDataFrame([(i, PAGE) for i in range(5)], "unit_id long, content string")
    assert mutate.merged(df, pairs=2).count() == 2


def test_sources_and_sinks(spark, tmp_path):
    root = tmp_path / "p" / "entry" / "src" / "main" / "ets" / "pages"
    root.mkdir(parents=True)
    (root / "A.ets").write_text(PAGE)
    (root / "B.ets").write_bytes("中文".encode("gbk"))
    (tmp_path / "p" / "build").mkdir()
    (tmp_path / "p" / "build" / "C.ets").write_text("x")
    found = files.source_files(spark, str(tmp_path))
    assert found.count() == 3 and files.ui_sources(found).count() == 2
    assert "中文" in [r.text for r in files.decoded(found).collect()]
    texts = spark.createDataFrame([("a", '[{"x": 1},\n]'), ("b", "[1, 2]"), ("c", "{"), ("d", '["a\x01b"]'), ("e", None), ("f", '{"o": [1, 2]}')], "path string, text string")
    got = files.json_items(texts)
    assert got.where("path = 'a'").first().item == '{"x": 1}' and got.where("path = 'b'").count() == 2
    assert got.where("failed is not null").count() == 2 and got.where("path = 'd'").first().item == '["ab"]' or got.where("path = 'd'").first().item == '"ab"'
    assert files.nested_items(texts.where("path = 'f'")).count() == 2
    assert {r.path for r in files.nested_items(texts).where("failed is not null").collect()} == {"c", "e"}
    listing = tmp_path / "list.csv"
    listing.write_text("# COMPLETED\n1,a,u,1\n\n2,b,v,0\n")
    assert files.repo_list(spark, str(listing)).count() == 2
    (tmp_path / "lines.txt").write_text(" a \n\n\tb\n")
    assert [r.line for r in files.line_list(spark, str(tmp_path / "lines.txt")).collect()] == ["a", "b"]
    (tmp_path / "x.html").write_text("<p>1</p>")
    assert files.html_pages(spark, str(tmp_path)).first().id == 1
    assert files.catalogue_leaves(json.dumps([{"isLeaf": False, "children": [{"isLeaf": True, "relateDocument": "a"}]}, {"isLeaf": True, "relateDocument": "b"}])) == ["a", "b"]
    df = spark.createDataFrame([("p", 1), ("q", 2)], "project string, v int")
    sinks.per_group_json(df, str(tmp_path / "out"), "project")
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    sinks.vector_collection(df, str(tmp_path / "vec"), "project")
    sinks.vector_collection(df, str(tmp_path / "vec"), "project")
    assert spark.read.parquet(str(tmp_path / "vec")).count() == 2
    sinks.explicit_parquet(df, str(tmp_path / "exp"), "project string, missing string")
    assert spark.read.parquet(str(tmp_path / "exp")).columns == ["project", "missing"]


def fetch(options, page):
    return [(f"k{page}", None if page == 1 else "body")] if page < 2 else []


def test_remote_pages(spark):
    files.register(spark)
    df = spark.read.format("remote_pages").options(fetcher="tests.test_operators:fetch", pages="3").load()
    assert sorted((r.key, r.body) for r in df.collect()) == [("k0", "body"), ("k1", None)]


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    df = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c d")], "id long, text string")
    df.write.mode("append").parquet(str(src))
    stream = spark.readStream.schema("id long, text string").parquet(str(src))
    assert feeds.drain(feeds.first_texts(stream), str(tmp_path / "c1")).count() == 2
    out = str(tmp_path / "out")
    for _ in range(2):
        feeds.run_into(stream, out, str(tmp_path / "c2"), lambda rows: rows, "id").awaitTermination()
    assert spark.read.parquet(out).count() == 3
    kept = feeds.drain(feeds.simhash_stream(stream), str(tmp_path / "c3"))
    assert sorted((r.id, r.kept) for r in kept.collect()) == [(1, True), (2, False), (3, True)]
    (tmp_path / "png").mkdir()
    (tmp_path / "png" / "a.png").write_bytes(b"x")
    assert feeds.drain(feeds.watch(spark, str(tmp_path / "png")).select("path"), str(tmp_path / "c4")).count() == 1


def test_streams_of_tables_that_are_folders(spark, tmp_path, rows):
    import __spark_entry__
    from tests.oracle import connect, same

    docs = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "a b"), (4, None), (5, ""), (6, "c d")], "doc_id long, text string")
    events = spark.sql("SELECT timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id % 9) AS ts, concat('k', id % 2) AS event_type FROM range(40)")
    for name, df in (("documents", docs), ("events", events)):
        df.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    con, queries = connect(str(tmp_path)), __spark_entry__.queries()
    for name in ("resumed_batches", "stream_first_texts", "stream_new_rows", "stream_windows"):
        same(queries[name](spark, str(tmp_path)), con, __spark_entry__.oracle_sql()[name])
    docs.write.mode("overwrite").partitionBy("doc_id").parquet(f"{tmp_path}/documents.parquet")
    assert rows(queries["resumed_batches"](spark, str(tmp_path)).select("doc_id")) == [(1,), (2,), (5,)]


@pytest.mark.parametrize("boundary", [False, True])
def test_uses(spark, boundary):
    units = spark.createDataFrame([(1, "f", "use Abc here"), (2, "f", "xAbcx"), (3, "g", "Abc"), (4, "f", None)], "unit_id long, file string, content string")
    symbols = spark.createDataFrame([("f", "Abc"), ("f", ""), ("f", None)], "file string, name string")
    got = sorted(r.unit_id for r in relational.uses(units, symbols, boundary=boundary).collect())
    assert got == ([1] if boundary else [1, 2])


def test_running_values_across_partitions(spark):
    rows = [(g, i, i % 3 == 0) for g in ("a", "b", None) for i in range(40 if g == "a" else 5)]
    df = spark.createDataFrame(rows, "g string, o int, ok boolean")
    got = {(r.g, r.o) for r in relational.until_successes(df, "g", ["o"], F.col("ok"), 3).collect()}
    assert got == {(g, o) for g, o, _ in rows if o <= 6}
    carried = relational.carried_forward(df, "g", "o", F.when(F.col("o") % 7 == 2, F.col("o")), "last").collect()
    assert all(r.last == (None if r.o < 2 else (r.o - 2) // 7 * 7 + 2) for r in carried) and len(carried) == len(rows)


def test_import_closure_of_a_long_chain(spark, monkeypatch):
    from siltloom.plans import catalogue

    edges = spark.createDataFrame([(f"f{i}", f"f{i + 1}") for i in range(19)] + [("f19", "f17")], "src string, dst string")
    monkeypatch.setattr(catalogue, "_imports", lambda spark, d: None)
    monkeypatch.setattr(catalogue, "table", lambda spark, d, name: None)
    monkeypatch.setattr(catalogue.graph, "import_edges", lambda imports, files: edges)
    found = {r.node: r.depth for r in catalogue.import_closure(spark, "").where("root = 'f0'").collect()}
    assert found == {f"f{i}": i for i in range(20)}


def test_checkpoint_folder_is_required_on_clusters():
    from types import SimpleNamespace

    from siltloom.common import checkpoint_dir

    conf = SimpleNamespace(get=lambda key, default=None: None)
    context = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError):
        checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))


def test_existence_is_asked_not_guessed(spark, tmp_path):
    from siltloom.common import exists

    assert not exists(spark, str(tmp_path / "none")) and exists(spark, str(tmp_path))
    with pytest.raises(Exception):
        exists(spark, "nosuchscheme://a/b")
