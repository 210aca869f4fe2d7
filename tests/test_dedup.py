import random

from siltloom.functions import similarity
from siltloom.operators import dedup


def brute_greedy(texts, threshold):
    kept = []
    for key, text in sorted(texts):
        if not any(similarity.ratio(text, other) > threshold for _, other in kept):
            kept.append((key, text))
    return [k for k, _ in kept]


def test_chain_is_not_components(spark):
    nodes = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    edges = spark.createDataFrame([(1, 2), (2, 3)], "earlier long, later long")
    assert sorted(r.id for r in dedup.greedy(nodes, edges).collect()) == [1, 3, 4]


def test_greedy_without_edges(spark):
    nodes = spark.createDataFrame([(1,)], "id long")
    assert dedup.greedy(nodes, spark.createDataFrame([], "earlier long, later long")).count() == 1


def test_ratio_equals_brute_force(spark):
    rng = random.Random(3)
    base = ["the quick brown fox jumps over the lazy dog", "short", "another line of text that is long enough to matter here"]
    texts = []
    for i in range(60):
        t = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = rng.choice("abcxyz ")
        texts.append((i, "".join(t)))
    texts += [(90, ""), (91, ""), (92, "ab"), (93, "ab")]
    df = spark.createDataFrame([*texts, (99, None)], "id long, text string")
    got = sorted(r.id for r in dedup.ratio_dedup(df).collect())
    assert got == sorted([*brute_greedy(texts, 0.9), 99])


def test_threshold_is_strict(spark):
    a, b = "a" * 9 + "b", "a" * 9 + "c"
    assert similarity.ratio(b, a) == 0.9
    df = spark.createDataFrame([(1, a), (2, b)], "id long, text string")
    assert dedup.ratio_dedup(df).count() == 2


def test_bounds_never_refuse_wrongly():
    rng = random.Random(5)
    for _ in range(300):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
        b = "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
        for t in (0.5, 0.8):
            assert similarity.above(a, b, t) == (similarity.ratio(a, b) > t)


def test_simhash_equals_brute_force(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    texts = []
    for i in range(80):
        base = words[(i % 4) * 10 : (i % 4) * 10 + 10] * 6
        if rng.random() < 0.7:
            base[rng.randrange(len(base))] = rng.choice(words)
        texts.append((i, " ".join(base)))
    texts += [(100, ""), (101, "  ")]
    kept = []
    for key, text in texts:
        s = similarity.simhash(text) & (1 << 64) - 1
        if all(similarity.hamming(s, o) > 3 for o in kept):
            kept.append(s)
            texts[texts.index((key, text))] = (key, text, True)
    want = sorted(t[0] for t in texts if len(t) == 3)
    df = spark.createDataFrame([t[:2] for t in texts], "id long, text string")
    assert sorted(r.id for r in dedup.simhash_dedup(df).collect()) == want


def test_exact_keeps_nulls(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None), (5, "")], "id long, text string")
    assert sorted(r.id for r in dedup.exact(df, "text", "id").collect()) == [1, 2, 4, 5]


def test_perceptual_match(spark):
    df = spark.createDataFrame([(1, 0b11111), (2, 0b111111)], "id long, phash long")
    assert [r.matched for r in dedup.perceptual_match(df, [0], 5).orderBy("id").collect()] == [True, False]


def test_comment_blind(spark):
    df = spark.createDataFrame([(1, "a = 1; // first note of some length here"), (2, "a = 1; /* quite another remark */"), (3, "completely(different)"), (4, None)], "id long, code string")
    assert sorted(r.id for r in dedup.comment_blind_dedup(df).collect()) == [1, 3, 4]


def test_ratio_queries_over_units_and_equal_texts(spark, monkeypatch):
    from siltloom.plans import catalogue

    body = "const a = this.find(key, 1); return a ? a.name : 'none of the names';"
    units = [(1, "a.ets", f"f() {{ {body} }}"), (2, "a.ets", f"f() {{ {body}  }}"), (3, "b.ets", f"f() {{ {body} }}"), (4, "a.ets", f"f() {{ // {'words of a comment ' * 5}\n{body} }}"), (5, "a.ets", None), (6, None, f"f() {{ {body} }}")]
    made = {"function_info": spark.createDataFrame(units, "unit_id long, file string, content string"), "moderation_samples": spark.createDataFrame([(1, "the same text"), (2, "the same text"), (3, "the same texts"), (4, None), (5, "other")], "sample_id long, text string")}
    monkeypatch.setattr(catalogue, "table", lambda spark, d, name: made[name])
    assert {r.unit_id for r in catalogue.ratio_dedup_units(spark, "").collect()} == {1, 3, 4, 5, 6}
    assert {r.unit_id for r in catalogue.comment_blind_dedup(spark, "").collect()} == {1, 3, 5, 6}
    assert [(r.earlier, r.later, r.ratio) for r in catalogue.ratio_audit(spark, "").collect()][0] == (1, 2, 1.0)
    assert catalogue.ratio_audit(spark, "").count() == 3
