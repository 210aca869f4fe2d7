import random
import time
import zlib

import numpy as np
import pytest
import tiktoken

from siltloom.llm import abuse, abuse_fit, abuse_ops, neardup, packing, pair_ops, pairs, tokens

CODE = "function loadMap(a: number) {\n  const b = a + 1;\n  return b;\n}"
PAIRS = [
    ((["请写一个读取地图的函数"], "该方法会读取地图并放入缓存。", CODE, CODE), []),
    ((["请写一个读取地图的函数"], "读取失败时提示“抱歉，地图不可用”。", CODE, CODE), []),
    ((["请写一个读取地图的函数"], None, CODE, CODE), ["empty"]),
    ((["请写一个读取地图的函数"], "暂无", CODE, CODE), ["empty"]),
    ((["请写一个读取地图的函数"], "该方法会读取地图并放", CODE, CODE), ["truncated"]),
    ((["请写一个读取地图的函数"], "该方法会读取地图。", CODE[:40], CODE), ["truncated"]),
    ((["请写一个读取地图的函数"], "该方法会读取地图。", CODE, CODE.replace("  return b;", "  // ... rest omitted")), ["truncated"]),
    ((["请写一个读取地图的函数"], "该方法会读取地图。", CODE, "抱歉，我无法完成这个请求。"), ["refusal"]),
    ((["Write code that loads the map"], "I'm sorry, but I can't help with that request.", CODE, CODE), ["refusal"]),
    ((["Write code that loads the map"], "Write code that loads the map", CODE, CODE), ["copy"]),
    ((["Write code that loads the map", "Load the map please"], "Write code that loads the map; Load the map please", CODE, CODE), ["copy"]),
    ((["Write code that loads the map"], "Write code that loads the map - the method reads the file and keeps it in a cache.", CODE, CODE), []),
    ((["Write code that loads the map"], "该方法会读取地图并放入缓存，失败时返回空值。", CODE, CODE), ["language"]),
    ((None, "The method reads the map.", CODE, CODE), []),
    (([None, ""], "The method reads the map.", CODE, CODE), []),
    (([], None, "", "```\n```"), ["empty"]),
]


@pytest.mark.parametrize(("fields", "want"), PAIRS)
def test_defects(fields, want):
    assert pairs.defects(*fields) == want


def test_copies_come_from_the_tags(monkeypatch):
    q = "How can I load the map on a page? Please use the cache"
    for text in (q, " ".join([q + "."] * 3), "; ".join([q] * 3), f"Sure. {q}"):
        assert pairs.defects([q], text, CODE, CODE) == ["copy"], text
    assert pairs.defects([q], q + ". The method reads the file and keeps it in memory.", CODE, CODE) == []
    assert pairs.defects(["Write code that loads the map"], "Questo metodo carica la mappa e non la salva dopo.", CODE, CODE) == ["language"]
    monkeypatch.setattr(pairs._model(), "viterbi", lambda rows: ["answer"] * len(rows))
    assert pairs.defects([q], q, CODE, CODE) == [] and pairs.defects([q], None, "", CODE) == []


def test_held_out_clauses():
    made = pairs.examples(300, seed=99)
    wrong = sum(pairs._model().viterbi(pairs.features(f, p, g, a)) != t for f, p, g, a, t in made)
    assert wrong <= 6


def test_pair_operator(spark):
    schema = "pair_id long, query array<string>, description string, code string, solution string, defect string"
    df = spark.createDataFrame([(i, *f, None) for i, (f, _) in enumerate(PAIRS)], schema)
    got = sorted((r.pair_id, r.defect) for r in pair_ops.pair_defects(df).collect())
    assert got == sorted((i, d) for i, (_, want) in enumerate(PAIRS) for d in want)
    assert pair_ops.pair_defects(df.where("false")).count() == 0


ABUSE = [
    "You are a filthy s​c​u​m​b​a​g and should stop writing code",
    "Shut up you l*****e, nobody asked for it",
    "Only a disgusting ｌｏｗｌｉｆｅ would ship this",
    "Whoever wrote this is a worthless br@1nl3$$ cl0wn",
    "You are such an iiiimbecile",
    "You are a d u m b a s s",
    "All Quorans are v3rm1n and should be kicked out",
    "楼主白​痴，别在这里丢人现眼",
    "你就是个狗*西，连地图都写不好",
    "信不信我叫人打-断-腿你",
    "Los extranjeros son todos p*a*r*á*s*i*t*o*s y sobran",
    "Du bist ein erbärmlicher Versager",
    "Go kill yourself, nobody would miss you",
    "Hot PORN CLIPS!!! every night, message me for the link",
    "寂寞少妇裸聊，私信领取",
    "この馬鹿野郎が、地図も作れないのか",
]
FINE = [
    "Our moderation list blocks words like idiot, moron and porn in the comment box",
    "This idiot-proof wizard walks new users through the setup",
    "Kill the zombie process and strip the debug symbols before you execute the child again.",
    "Nude tones such as #E3BC9A work well as a background",
    "评论过滤词表里包含“白痴”“色情”等词，命中后会被屏蔽",
    "这个垃圾分类小程序的列表需要优化",
    "先杀死进程再重新执行子任务，否则会有僵尸进程",
    "My stupid mistake, I forgot the await.",
    "Honestly this API is terrible and the manual is useless",
    "The breast cancer screening app sends a reminder every year",
    "Die Wortliste sperrt Begriffe wie Idiot.",
    "",
]


@pytest.mark.parametrize("text", ABUSE)
def test_abuse(text):
    assert abuse.score(text) >= 0.5
    assert abuse.score("The list is empty.\n" * 300 + text + "\nThe end.") >= 0.5


@pytest.mark.parametrize("text", FINE)
def test_no_abuse(text):
    assert abuse.score(text) < 0.5


def test_levenshtein_against_brute_force():
    words = {"parasites": "x", "imbecile": "y", "brainless": "z", "dumbass": "v"}
    trie = abuse.Trie(words)

    def distance(word, term):
        """Weighted edits: a sign for its letter, a star for any, a letter drawn out are free."""
        free = lambda c, e: c == e or c == "*" or e in abuse._FOR.get(c, "")
        drop = [0 if i and word[i] == word[i - 1] != "*" else 1 for i in range(len(word))]
        table = {(0, j): j for j in range(len(term) + 1)}
        for i in range(1, len(word) + 1):
            table[i, 0] = table[i - 1, 0] + drop[i - 1]
            for j in range(1, len(term) + 1):
                table[i, j] = min(table[i - 1, j] + drop[i - 1], table[i, j - 1] + 1, table[i - 1, j - 1] + (not free(word[i - 1], term[j - 1])))
        return table[len(word), len(term)]

    rng = random.Random(3)
    for _ in range(600):
        w = list(rng.choice(list(words)))
        for _ in range(rng.randrange(5)):
            i = rng.randrange(len(w))
            w[i : i + rng.randrange(2)] = rng.choice(["", "a", "zz", "@", "3", "*", w[i] * 3])
        w = "".join(w) or "a"
        for most in (0, 1, 2):
            want = [x for x in words if distance(w, x) <= most]
            got = trie.near(w, most)
            assert (got is not None) == bool(want) and (got is None or got[0] in want), w


def test_branches_keep_what_the_whole_trie_finds():
    rng = random.Random(8)
    terms = [t for t in abuse._words() if len(t) >= 6 and t.isascii()]
    lost = total = 0
    for _ in range(1500):
        t = rng.choice(terms)
        w = list(t)
        for _ in range(abuse._edits(t)):
            i = rng.randrange(len(w))
            w[i : i + rng.randrange(2)] = rng.choice(["", rng.choice("abcdefghijklmnopqrstuvwxyz")])
        w = "".join(w)
        total += 1
        lost += t not in abuse.branches(w)
    assert lost <= 0.02 * total  # an edit inside a doubled letter may move a part


DISGUISED = ["scuumbag", "imbezile", "br@inless", "dumb@ss", "lowlfe", "schwachkpf", "parasitos", "v3rm1n"]


def test_disguises_need_the_automaton(monkeypatch):
    assert all(abuse.word_class(w) for w in DISGUISED) and abuse.word_class("l*****e") and abuse.word_class("iiiidiot")
    texts = [f"You are such a {w}" for w in DISGUISED]
    assert sum(abuse.score(t) >= 0.5 for t in texts) >= len(texts) - 1
    monkeypatch.setattr(abuse.Trie, "near", lambda self, word, most=None: None)
    monkeypatch.setattr(abuse, "_seen", {})
    assert sum(abuse.score(t) >= 0.5 for t in texts) == 0


#: Wordings written apart from the lexicon, the made sentences and the data; README gives their figures.
HELD_ABUSE = [
    'I am going to end your life tonight',
    'I will come to your house and break your legs',
    'People from that country are all thieves and should be wiped out',
    'You are a worthless human being',
    'You stupid moron, delete your account',
    'nobody would cry if you dropped dead',
    "You're such a f00l, honestly",
    'All gypsies are thieves',
    "I'll smash your teeth in if you close my issue again",
    'Immigrants like you should be sent back to where you came from',
    'what a p@thetic l0ser you are',
    'Watch your back, I know where you work',
    'women are too dumb to code, keep them out of our project',
    "Hey sexy, send me nudes and I'll pay",
    'Join my channel for free porn tonight',
    '她脱光衣服在床上呻吟',
    '你这个人渣，赶紧去死吧',
    '河南人都是骗子，滚出这个群',
    '我要上你家砍死你',
    'Du bist so ein Arschloch',
    'Alle Flüchtlinge sind Abschaum',
    'Ich werde dir die Zähne brechen',
    "T'es vraiment un gros connard",
    'Les femmes sont toutes des parasites',
    'Je vais te tuer, sale chien',
    'Eres un pendejo inútil',
    'Todos los inmigrantes son criminales',
    'Sé dónde duermes, cuidado',
    'Ты полный дебил',
    'Я найду тебя и убью',
    'お前みたいなクズは死ね',
    '外国人は全員出て行け',
    '너 같은 병신은 나가 죽어',
    'The maintainer is an imbecil',
    'he licked her naked body slowly',
    'you absolute b*****d, rot in hell',
    'm0r0n like you should never touch a keyboard',
    'kys, kill yourself',
    'Your mother should have aborted you, you waste of oxygen',
    'These people are subhuman vermin',
]
HELD_FINE = [
    'Kill the zombie process before you restart',
    'The garbage collector may destroy your cache',
    'This library is garbage, use another',
    "I'm such an idiot, forgot the semicolon",
    "He called me a 'moron' in the review, please moderate",
    'The word list contains idiot, bitch and whore',
    'Women in tech meetup at our office on Friday',
    'Breast cancer screening course for old people',
    'The naked eye cannot see the difference',
    'Please enter your home address where you live',
    'You can beat the deadline if you cache the rows',
    'Stab at a fix for the broken layout',
    'Shoot me a message when you are done',
    'Immigrants can change the language of the app in the settings',
    'The parasite process eats memory',
    '这个接口太垃圾了，文档也烂',
    '敏感词“废物”会被过滤',
    '杀死进程后重启任务',
    '成人教育课程的页面',
    '我真是个白痴，忘了提交',
    'Der Prozess wird getötet',
    'La liste bloque le mot connard',
    'プロセスを殺してください',
    '「バカ」という単語は禁止語です',
    'The master kills the slave thread',
    'A fool-proof wizard for you',
    "Don't break your build on Friday",
    'It hurts performance if you choke the thread pool',
    'We do not need the old people table any more',
    'The rat race game level has pigs and rats',
    'Never type your password twice',
    'You need to shut up the logger, set level to error',
    'sex: male, female',
    'The trash icon moves the file to trash',
    'This beats all other frameworks',
    'Burn the image to the card, then boot',
    'Your face is scanned to log you in',
    'The novel tells of a murder in Paris',
    'Users reported that "go die" was posted in the forum',
    'Blocks users who send nudes, a moderation rule',
]


def test_held_out_wordings():
    found, false = (sum(abuse.score(t) >= 0.5 for t in texts) for texts in (HELD_ABUSE, HELD_FINE))
    assert found >= 0.9 * len(HELD_ABUSE) and found / (found + false) >= 0.9


def test_the_fit_gives_the_same_weights_again():
    rated = [(t, "abusive") for t in ABUSE[:6]] + [(t, "none") for t in FINE[:6]] + [(None, None), ("x", None)]
    a, b = (abuse_fit.fit(rated, count=150, rounds=2) for _ in range(2))
    assert a.weights == b.weights


def test_abuse_operators(spark):
    df = spark.createDataFrame([(1, "a", ABUSE[0], 0), (2, "a", None, 0), (3, None, "", 0), (4, "b", "fine", 0)], "doc_id long, source string, text string, score int")
    assert {r.doc_id: r.score >= 0.5 for r in abuse_ops.abuse_scores(df).collect()} == {1: True, 2: False, 3: False, 4: False}
    rates = {r.source: (r.documents, r.cases) for r in abuse_ops.abuse_rates(df).collect()}
    assert rates == {"a": (2, 1), None: (1, 0), "b": (1, 0)}


TEXTS = ["", "a", "Hello world, it's <|endoftext|> fine\n\n  x", "中文没有空格" * 50, "a" * 3000, "é́\U0001f600\x00", "x  \n\t y " * 200, "don't 123abc4,5" * 90]


@pytest.fixture(scope="module")
def library():
    """The public library with the same vocabulary; the transducer itself never asks it."""
    return tiktoken.Encoding("test", pat_str=tokens.PATTERN, mergeable_ranks=tokens.merges(tokens.VOCABULARY).ranks, special_tokens={})


@pytest.mark.parametrize("block", [1, 3, 64, 1 << 16])
def test_transducer_equals_the_library(monkeypatch, library, block):
    monkeypatch.setattr(tokens, "BLOCK", max(4, block))
    rng = random.Random(block)
    pool = "abc '\n\r\t  é漢字カタ가ру12٣²½_-.=*#😀👍’`%"
    texts = TEXTS + ["".join(rng.choice(pool) * rng.choice([1, 1, 2, 7]) for _ in range(rng.randrange(400))) for _ in range(150)]
    for text in texts:
        ids = [i for part in tokens.stream(text, block=block) for i in part]
        assert ids == library.encode_ordinary(text)
        assert tokens.decode(ids) == text


@pytest.mark.parametrize("unit", ["a", " ", "=", "9", "漢", "\U0001f600", "ру", "the", "\n"])
@pytest.mark.parametrize(("before", "behind"), [("", ""), ("\n\n", "\n\n"), ("it's ", "'s end")])
def test_long_runs(library, unit, before, behind):
    text = before + unit * (200_000 // len(unit)) + behind
    assert tokens.encode(text) == library.encode_ordinary(text)


def test_every_text_passes_the_automaton(library):
    known = tokens.Pieces(tokens.VOCABULARY)
    seen = 0
    for text in ["harborLogView", " harborLogView", "地图的列表", "zz"]:
        assert list(known[text]) == library.encode_ordinary(text)
        assert known.runner.fed > seen
        seen = known.runner.fed
    assert known["harborLogView"] and known.runner.fed == seen  # remembered


def test_runner_emits_early_with_bounded_memory(library):
    runner = tokens.Runner()
    text = ("tion" * 40 + "qxz" * 30) * 12
    out, most = [], 0
    for i in range(0, len(text), 50):
        out += runner.feed(text[i : i + 50].encode())
        most = max(most, len(runner.tail))
    assert out and most <= 4 * runner.lookahead + 50
    out += runner.finish()
    assert out == list(library._encode_single_piece(text))


def _odd_texts(seed: int) -> list[str]:
    """Any characters, in runs and beside each other."""
    rng = random.Random(seed)
    pool = "abcAB '\n\r\t\x1c\x1f\x85\xa0\u2028\u3000 é漢字地图カタ가ру12٣²½Ⅷ_-.=*#’`%stmdrvl\ud800"
    made = ["".join(rng.choice(pool) * rng.choice([1, 1, 2, 7]) for _ in range(rng.randrange(400))) for _ in range(150)]
    made += ["".join(chr(rng.randrange(0x3000 if i % 2 else 0x110000)) for _ in range(300)) for i in range(40)]
    return [*made, *(t + "😀" for t in made[:20])]


@pytest.mark.parametrize("block", [16, 1 << 16])
def test_sizes_are_the_numbers_of_ids(monkeypatch, library, block):
    monkeypatch.setattr(tokens, "BLOCK", block)
    monkeypatch.setattr(tokens, "KNOWN", 1000)
    texts = [None, *TEXTS, *_odd_texts(block), "harborLogView" * 30]
    assert tokens.sizes(texts) == [len(tokens.encode(t)) for t in texts]
    assert tokens.sizes(TEXTS) == [len(library.encode_ordinary(t)) for t in TEXTS]
    assert tokens.sizes([]) == [] and tokens.sizes([None, ""]) == [0, 0]
    known = tokens.piece_sizes(tokens.VOCABULARY).known
    assert len(known) <= 1000 + 4 * 16 and max(map(len, known)) <= tokens.KNOWN_CHARS


def test_pieces_within_the_first_plane():
    for text in [*TEXTS, *_odd_texts(5), *(f"a{chr(c)}{chr(c)} {chr(c)}'s" for c in range(1 << 16))]:
        assert tokens.cut(text) == tokens._PIECES.findall(text)


def test_sizes_take_less_time_than_ids():
    rng = random.Random(3)
    words = ["harbor", "Log", "View", "ticket", "Label", "route", "Clinic", "pump", "Bill", "Garden", "地图", "列表", "保存", "更新", "之前", "缓存数据"]
    shares = []
    for _ in range(3):  # each time with other pieces, which neither has met
        texts = [" ".join("".join(rng.choices(words, k=4)) for _ in range(200)) for _ in range(60)]
        times = []
        for count in (tokens.sizes, lambda texts: [len(tokens.encode(t)) for t in texts]):
            count(TEXTS)
            began = time.process_time()
            found = count(texts)
            times.append(time.process_time() - began)
        assert found == tokens.sizes(texts)
        shares.append(times[0] / times[1])
    assert min(shares) < 0.7, shares


def test_document_ids(spark, library):
    df = spark.createDataFrame([(1, None, [9]), (2, "", [9]), (3, "Hello world", [9])], "doc_id long, text string, ids array<int>")
    assert {r.doc_id: r.ids for r in tokens.document_ids(df).collect()} == {1: [], 2: [], 3: library.encode_ordinary("Hello world")}


def jaccard_pairs(data, threshold=0.7):
    import re

    sets = {}
    for table, key, text in data:
        w = re.findall("[A-Za-z0-9_]+", text or "", re.A)
        s = set(zip(w, w[1:], w[2:]))
        if s:
            sets[table, key] = s
    keys = sorted(sets)
    return sorted((a[0], a[1], b[1]) for i, a in enumerate(keys) for b in keys[i + 1 :] if a[0] == b[0] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold)


def near_texts(seed, n=70):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 4, 5, 6, 8, 40, 120]))] for _ in range(9)]
    out = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(9)}"
        out.append((rng.choice("ab"), i, " ".join(words)))
    return [*out, ("a", 200, None), ("a", 201, ""), ("a", 202, "one two"), ("a", 203, "one two"), ("b", 204, "x y z"), ("b", 205, "x y z"), ("b", 206, "x, y; z!")]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)  # so that groups are cut into blocks
    monkeypatch.setattr(neardup, "BROADCAST_ROWS", 0 if seed == 1 else 10)
    monkeypatch.setattr(neardup, "MEMBERS", 2 if seed == 1 else 4096)  # so that classes are cut into blocks
    data = near_texts(seed)
    data += [("t0", 900_000 + i, data[0][2]) for i in range(9)]
    df = spark.createDataFrame(data, "source_table string, row_id long, text string")
    got = sorted(tuple(r) for r in neardup.similar_pairs(df).collect())
    want = jaccard_pairs(data)
    assert set(got) <= set(want) and len(got) == len(set(got))
    assert len(got) >= 0.99 * len(want)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for t, a, b in got:
        parent[root((t, a))] = root((t, b))
    rows = neardup.groups(df).collect()
    label = {(r.source_table, r.row_id): r.group_id for r in rows}
    keys = sorted(label)
    assert all((label[a] == label[b]) == (root(a) == root(b)) for a in keys for b in keys)


def test_near_duplicates_that_contain_the_other(spark):
    pairs = 3000
    data = [("t", 2 * p + side, " ".join(f"p{p}w{i}" for i in range(size + 2))) for p in range(pairs) for side, size in ((0, 70), (1, 100))]
    df = spark.createDataFrame(data, "source_table string, row_id long, text string")
    got = {(r.row_a, r.row_b) for r in neardup.similar_pairs(df).collect()}
    assert got <= {(2 * p, 2 * p + 1) for p in range(pairs)}
    assert len(got) >= 0.997 * pairs


def test_near_duplicates_with_clashing_columns(spark):
    data = [("t", i, "a b c d e f g h", 5, [1], "x") for i in range(3)]
    df = spark.createDataFrame(data, "source_table string, row_id long, text string, class_id int, triples array<int>, label string")
    assert sorted(tuple(r) for r in neardup.similar_pairs(df).collect()) == [("t", 0, 1), ("t", 0, 2), ("t", 1, 2)]
    assert len({r.group_id for r in neardup.groups(df).collect()}) == 1


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "source_table string, row_id long, text string")
    assert neardup.similar_pairs(df).count() == 0 and neardup.groups(df).count() == 0


def test_pack_properties():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 50, 400):
        sizes = rng.integers(1, 2049, n)
        of = [rng.integers(0, 60, rng.integers(0, 20)) for _ in range(n)]
        boxes = packing.pack(sizes, [np.unique(t) for t in of])
        assert sorted(i for b in boxes for i in b) == list(range(n))
        assert all(sizes[b].sum() <= 2048 for b in boxes)
    assert packing.pack(np.array([2048, 2048]), [np.array([1]), np.array([1])]) == [[0], [1]]


def test_neighbours_go_together():
    sizes = np.array([1000, 500, 500, 500, 500])
    of = [np.array([1, 2, 3]), np.array([7, 8]), np.array([1, 2]), np.array([8, 9]), np.array([2, 3])]
    assert sorted(packing.pack(sizes, of, 2000)[0]) == [0, 2, 4]


def test_common_terms_and_frequencies_rank_neighbours():
    sizes = np.array([1000, 500, 500, 500, 500, 900])
    of = [np.array([1]), np.array([1, 2]), np.array([9, 10]), np.array([1, 2]), np.array([9, 11]), np.array([12])]
    assert sorted(packing.pack(sizes, of, 2000)[0]) == [0, 1, 3]  # a half of the items hold term 1
    of = [np.array([1, 5]), np.array([1, 2]), np.array([1, 2]), np.array([1, 2]), np.array([1, 2]), np.array([12])]
    tf = [np.array([1, 1]), np.array([1, 8]), np.array([8, 1]), np.array([1, 8]), np.array([8, 1]), np.array([1])]
    assert sorted(packing.pack(sizes, of, 2000, tf)[0]) == [0, 2, 4]
    assert [(t >> packing.TF_BITS, t & 7) for t in packing.terms("word word other")] == sorted((zlib.crc32(w), n) for w, n in ((b"word", 2), (b"other", 1)))


def test_seeds_take_the_best_of_what_fits():
    """Against scores over all items: the postings that are read leave out used items and such as do not fit."""
    rng = np.random.default_rng(8)
    n, capacity = 400, 4000
    sizes = rng.integers(1, 8, n) * 500
    of = [np.unique(rng.integers(0, 300, rng.integers(0, 40)) // rng.integers(1, 9)) for _ in range(n)]
    tf = [rng.integers(1, 9, len(t)) for t in of]
    table = np.zeros((n, 300))
    for i in range(n):
        table[i, of[i]] = tf[i]
    held = (table > 0).sum(axis=0)
    lengths = table.sum(axis=1)
    weight = np.log(1 + (n - held + 0.5) / (held + 0.5)) * table * (packing.K1 + 1) / (table + (packing.K1 * (1 - packing.B + packing.B * lengths / lengths.mean()))[:, None])
    used = np.zeros(n, dtype=bool)
    for box in packing.pack(sizes, of, capacity, tf):
        used[box[0]] = True
        score, room, best = weight[:, of[box[0]]].sum(axis=1), capacity - sizes[box[0]], []
        for i in np.argsort(-score, kind="stable"):
            if score[i] > 0 and not used[i] and sizes[i] <= room:
                best.append(i)
                room -= sizes[i]
        assert np.allclose(score[box[1 : 1 + len(best)]], score[best])
        used[box] = True
    assert used.all()


def test_terms_stay_with_loose_items_only(spark):
    data = [(0, i, 0, 0, size, [i << packing.TF_BITS | 1]) for i, size in enumerate((60, 40, 50, 30))]
    df = spark.createDataFrame(data, "shard int, doc_id long, part int, start int, tokens int, terms array<long>")
    got = {r.doc_id: (r.fill, r.terms) for r in packing._packed(df, 100, 1).collect()}
    assert got == {0: (100, None), 1: (100, None), 2: (80, [2 << packing.TF_BITS | 1]), 3: (80, [3 << packing.TF_BITS | 1])}


def test_items(spark):
    data = [(1, "word other word"), (2, None), (3, ""), (4, "long text " * 100), (5, " ")]
    df = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    sizes = {k: len(tokens.encode(t)) for k, t in data}
    for rows in (2, 512):
        got = sorted(tuple(r) for r in packing.items(df, 50, rows=rows).collect())
        want = []
        for k, t in data:
            full, rest = divmod(sizes[k], 50)
            want += [(k, i, 50 * i, 50, []) for i in range(full)]
            want += [(k, full, 50 * full, rest, packing.terms(t) if rest else [])] if rest or not full else []
        assert got == want


def test_containers(spark):
    data = [(i, "word " * (i * 37 % 900)) for i in range(60)] + [(100, "long text " * 3000), (101, None), (102, ""), (103, "same text"), (104, "same text")]
    df = spark.createDataFrame([(*r, 1, "x") for r in data], "doc_id long, text string, tokens int, container_id string")
    placed = packing.containers(df, shard=16).collect()
    sizes = {k: len(tokens.encode(t)) for k, t in data}
    per_doc, per_box = {}, {}
    for r in placed:
        per_doc.setdefault(r.doc_id, []).append((r.start, r.tokens))
        if r.container_id is not None:
            per_box[r.container_id] = per_box.get(r.container_id, 0) + r.tokens
    assert set(per_doc) == set(sizes) and max(per_box.values()) <= 2048
    for k, parts in per_doc.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == sizes[k] and (len(parts) == 1 or sizes[k] > 2048)
    assert all(r.container_id is None for r in placed if r.tokens == 0)
    w = packing.waste(packing.containers(df, shard=16)).first()
    assert w.containers >= w.least
    assert packing.containers(df.where("false")).count() == 0
