"""Defects of question-answer pairs: a conditional random field tags the clauses of each answer field.

Labels: answer, refusal, echo (of the question), foreign (another language than the question), unfinished, void.
The share of a field's characters under each label then decides: empty, truncated, refusal, copy, language.
Code counts as one clause that knows whether its brackets and literals close and whether parts are left out.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from functools import lru_cache
from pathlib import Path

from siltloom.llm.crf import Chain, train
from siltloom.llm.lexer import lex
from siltloom.llm.prose import votes

MODEL = Path(__file__).with_name("pairs_crf.json")
LABELS = ["answer", "refusal", "echo", "foreign", "unfinished", "void"]
#: Signs of a refusal by kind.
_DENY = re.compile(
    r"\b(?:can(?:no|')t|can’t|cannot|could not|unable|not able|not possible|impossible|decline|refuse|won't|will not|not allowed|beyond what|outside (?:my|the scope)|do not have|don't have|not in a position|must not)\b"
    r"|无法|不能|不可以|没有办法|没办法|超出|拒绝|不便|不予|不会写|不提供|无权|できません|できかね|お断り|いたしかね|お答え|応じ"
    r"|\b(?:kann|können|darf|möchte) .{0,60}?\bnicht|nicht möglich|außerstande|lehne|leider|ne (?:peux|puis|peut) pas|ne suis pas en mesure|impossible de|refuse|no puedo|no es posible|no me es posible|incapaz|не могу|не имею|невозможно|отказ|할 수 없|드릴 수 없|불가능|거절",
    re.I,
)
_SELF = re.compile(r"\bI\b|\bI'm\b|\bmy\b|\bme\b|language model|\bAI\b|我|本助手|本模型|语言模型|人工智能|私|わたし|言語モデル|\bich\b|\bmir\b|Sprachmodell|\bje\b|\bj'|modèle|\b(?:soy|mi|yo|me|puedo)\b|modelo|\bя\b|мне|моей|модел|저는|제가|모델", re.I)
_SORRY = re.compile(r"sorry|apolog|unfortunately|regret|抱歉|对不起|很遗憾|遗憾|不好意思|申し訳|すみません|ごめん|残念|entschuldig|tut mir leid|leider|désolé|malheureusement|lo siento|lamento|disculp|извин|к сожалению|죄송|유감", re.I)
_TASK = re.compile(r"request|help|assist|write|code|produce|provide|create|generate|answer|documentation|consult|请求|帮助|代码|生成|提供|写出|实现|完成|回答|文档|作成|コード|手伝|要望|リクエスト|提供|対応|内容|ご質問|依頼|Code|Anfrage|helfen|schreiben|demande|aider|écrire|solicitud|ayudar|escribir|запрос|помочь|написать|код|요청|도와|코드|작성", re.I)
_FIRM = re.compile(r"かねます|かねる|お答えでき|お手伝いでき|\bI (?:can'?t|can’t|cannot|must decline|am unable|won't|will not|do not have)|\bI'm (?:unable|not able|sorry)|not possible for me|beyond what|超出了?我|我(?:无法|不能|没有办法|没办法)|ich kann|je ne (?:peux|suis)|no puedo|я не могу|수 없습니다", re.I)
_QUOTE = re.compile(r"[“「『‘].*?[”」』’]|\"[^\"\n]*\"|(?<!\w)'[^'\n]*'(?!\w)")
_OMITTED = re.compile(r"(?://|#|/\*|\*)[^\n]{0,20}(?:\.\.\.|…)[^\n]*|(?://|#|/\*)[^\n]*(?:rest (?:of|is|omitted)|omitted|remaining code|remainder|same as (?:above|before)|省略|同上|以下略|其余|剩余代码|后续代码|余下|以下同様|残りは|Rest (?:der|des|ausgelassen)|weggelassen|le reste|el resto|остальн|나머지|생략)[^\n]*|^\s*(?:\.\.\.|…+)\s*;?\s*$", re.I | re.M)
_VOID = re.compile(
    r"[\s\W_]*(?:(?:n/?a|null|none|nil|undefined|todo|tbd|fixme|empty|placeholder|pending|to be (?:added|done|filled(?: in)?|completed|written)|coming soon|not available|无|暂无|暂缺|空|无内容|没有|待补充|待完善|待填写|待定|待添加|待实现|略|未填写|なし|未定|未記入|準備中|該当なし|keine?|leer|folgt|aucun|vide|à compléter|ninguno|vacío|pendiente|нет|пусто|없음|추후|미정|xxx+|string|text|code|answer|description|solution|lorem ipsum.*)[\s\W_]*)?",
    re.I,
)
_FENCE = re.compile(r"```[\w+-]*\n?|~~~[\w+-]*\n?")
_ACK = re.compile(r"^\s*(?:ok(?:ay)?|sure|of course|certainly|alright|right|yes|got it|understood|no problem|here (?:you go|it is)|好的|好|当然|没问题|明白(?:了)?|收到|是的|可以|嗯|了解|わかりました|はい|承知(?:いたし|し)ました|もちろん|klar|gerne|natürlich|bien sûr|d'accord|claro|por supuesto|хорошо|конечно|네|알겠습니다|물론)[\s,.:;!，。：；！、-]*", re.I)
_CODE = re.compile(r"[{}]|;\s*$|=>|\)\s*\{|^\s*(?:import|export|const|let|var|return|function|class|public|private|def)\b.*[=({]", re.M)
_END = re.compile(r"[.!?。！？…”\"」』)）]\s*$")
_CLAUSE = re.compile(r"[^。！？!?；;\n]*?(?:[。！？!?；;]+[”\"」』]?|\.(?=\s|$)| / |\n|$)")


def guess(text: str) -> str:
    """The language of a text, '' where nothing tells; identifiers in it do not count."""
    text = re.sub(r"[A-Za-z_]\w*[A-Z_\d]\w*|`[^`]*`|https?://\S+", " ", text)
    c = Counter()
    for ch in text:
        o = ord(ch)
        if 0x3041 <= o <= 0x30FF:
            c["kana"] += 1
        elif 0x3400 <= o <= 0x9FFF:
            c["han"] += 1
        elif 0xAC00 <= o <= 0xD7A3:
            c["ko"] += 1
        elif 0x400 <= o <= 0x52F:
            c["ru"] += 1
        elif ch.isalpha():
            c["latin"] += 1
    cjk = c["kana"] + c["han"]
    if not c:
        return ""
    if cjk * 3 >= c["latin"] and cjk >= max(c["ko"], c["ru"]):
        return "ja" if c["kana"] * 6 >= cjk else "zh"
    if c["ko"] * 2 >= c["latin"]:
        return "ko"
    if c["ru"] * 2 >= c["latin"]:
        return "ru"
    found = {k: v for k, v in votes(text.lower()).items() if k not in ("ko", "ru", "uk", "bg")}
    return max(sorted(found), key=found.__getitem__) if found else ""


def _grams(text: str) -> Counter:
    t = re.sub(r"[\W_]+", "", text.lower())
    return Counter(t[i : i + 2] for i in range(len(t) - 1)) if len(t) > 1 else Counter([t] if t else [])


def _questions(asked: list[str]) -> list[Counter]:
    """The character pairs of each wording, and of all wordings together."""
    each = [_grams(q) for q in asked]
    return [*each, sum(each, Counter())] if len(each) > 1 else each


def _within(text: str, grams: list[Counter]) -> float:
    """The largest share of the text's character pairs that one of the questions has."""
    own = _grams(text)
    n = sum(own.values())
    return max((sum((own & g).values()) / n for g in grams), default=0.0) if n else 0.0


def clauses(field: str, text: str | None) -> list[tuple[str, str]]:
    """(kind, text) of each clause; kind is text, code or blank.  Null gives one blank clause."""
    if text is None or not text.strip():
        return [("blank", "")]
    bare = _FENCE.sub("", text)
    if _VOID.fullmatch(bare):
        return [("blank", bare)]
    prose = re.sub(r"^\s*(?://+|/\*+|\*+/?|#+)[ \t]?", "", bare, flags=re.M)
    prose = re.sub(r"\*/\s*$", "", prose)
    if field != "description" and len(_CODE.findall(bare)) >= 2:
        return [("code", bare)]
    return [("text", m[0]) for m in _CLAUSE.finditer(prose) if re.search(r"\w|…|\.\.", m[0])] or [("blank", bare)]


def _open(text: str) -> bool:
    """Whether a code text breaks off: a bracket, template, comment or literal is still open at its end."""
    x = lex(text)
    depth = 0
    for k in x.kind:
        if k in ("(", "[", "{", "th"):
            depth += 1
        elif k in (")", "]", "}", "tt"):
            depth -= 1
    return depth > 0 or bool(x.kind) and x.kind[-1] == "bad" or any(k == "bad" and text.startswith("/*", a) for k, a in zip(x.kind, x.start))


def features(field: str, parts: list[tuple[str, str]], grams: list[Counter], asked: str) -> list[list[str]]:
    rows = []
    n = len(parts)
    for i, (kind, text) in enumerate(parts):
        row = [f"kind={kind}", f"field={field}|kind={kind}"]
        if kind == "code":
            row.append(f"open={_open(text)}")
            row.append(f"omitted={bool(_OMITTED.search(text))}")
            row.append(f"tail={text.rstrip().endswith(('...', '…'))}")
        elif kind == "text":
            bare = _QUOTE.sub(" ", text)
            deny, own, sorry, task = (bool(p.search(bare)) for p in (_DENY, _SELF, _SORRY, _TASK))
            row.append(f"deny={deny}|self={own}|sorry={sorry}")
            row.append(f"firm={bool(_FIRM.search(bare))}|deny={deny}")
            if deny:
                row += [f"deny|task={task}", f"deny|self={own}|task={task}"]
            rest = _ACK.sub("", text)
            if not rest.strip():
                row.append("ack")
            w = _within(rest, grams) if rest.strip() else 1.0
            row.append("echo=" + ("all" if w >= 0.96 else "most" if w >= 0.85 else "half" if w >= 0.7 else "no"))
            lang = guess(text)
            row.append("lang=" + ("unknown" if not lang or not asked else "same" if lang == asked else "other"))
            ended = bool(_END.search(text)) and not text.rstrip().endswith(("...", "…"))
            last = i == n - 1
            row.append(f"ended={ended}|last={last}")
            row.append(f"ended={ended}|last={last}|echo={w >= 0.96}|field={field == 'description'}")
            row.append(f"ellipsis={text.rstrip().endswith(('...', '…'))}|last={last}")
        rows.append(row)
    return rows


@lru_cache(1)
def _model() -> Chain:
    return Chain.load(MODEL)


def defects(query: list[str | None] | None, description: str | None, code: str | None, solution: str | None) -> list[str]:
    """The defects of one pair, in the order empty, truncated, refusal, copy, language; [] for a sound one.

    A question without any wording can be neither copied nor answered in another language.
    """
    asked = [q for q in (query if query is not None else []) if q and q.strip()]
    grams = _questions(asked)
    langs = Counter(filter(None, map(guess, asked)))
    lang = langs.most_common(1)[0][0] if langs else ""
    out = set()
    for field, text in (("description", description), ("code", code), ("solution", solution)):
        parts = clauses(field, text)
        tags = _model().viterbi(features(field, parts, grams, lang))
        size: Counter = Counter()
        for (_, t), tag in zip(parts, tags):
            size[tag] += max(1, len(t.strip()))
        total = sum(size.values())
        if size["void"] == total:
            out.add("empty")
            continue
        if size["refusal"] >= 0.5 * total:
            out.add("refusal")
            continue
        if grams and size["echo"] >= 0.9 * total:
            out.add("copy")
            continue
        if tags[-1] == "unfinished" or parts[0][0] == "code" and "unfinished" in tags:
            out.add("truncated")
        if field == "description" and lang and size["foreign"] >= 0.5 * total:
            out.add("language")
    return [d for d in ("empty", "truncated", "refusal", "copy", "language") if d in out]


def examples(count: int = 3000, seed: int = 5) -> list[tuple[str, list[tuple[str, str]], list[Counter], str, list[str]]]:
    """Made-up answer fields with the label of each clause."""
    rng = random.Random(seed)
    things = {"en": ["river map", "garden plan", "ticket queue", "harbor log"], "zh": ["河流地图", "花园方案", "票务队列", "港口日志"], "ja": ["川の地図", "庭の計画", "切符の列", "港の記録"], "de": ["die Flusskarte", "den Gartenplan", "die Hafenliste"], "fr": ["la carte", "le plan du jardin", "le journal du port"], "es": ["el mapa del río", "el plan del jardín", "la lista del puerto"], "ru": ["карту реки", "план сада", "журнал порта"], "ko": ["강 지도", "정원 계획", "항구 기록"]}
    questions = {"en": ["Write a helper that can load the {}", "How can I show the {} on a screen?", "Build something called {n} to print the {}"], "zh": ["请写一个能够读取{}的函数", "怎样在界面上展示{}？", "做一个名为 {n} 的方法来打印{}"], "ja": ["{}を読み込む処理を書いてください", "{}を表示する {n} を作ってください"], "de": ["Schreibe eine Funktion, die {} lädt"], "fr": ["Écris une fonction qui charge {}"], "es": ["Escribe una función que cargue {}"], "ru": ["Напишите функцию, которая загружает {}"], "ko": ["{} 불러오는 함수를 작성해 주세요"]}
    answers = {
        "en": ["The method reads the {} and keeps it in a cache.", "It walks over the {} and skips what is empty.", "When the {} is missing a sorry message is shown.", "{n} returns early if the {} cannot be read.", "If the {} cannot be read the function prints a sorry text and stops.", "It is not possible to load the {} twice, so {n} keeps a copy."],
        "zh": ["该方法会读取{}并放入缓存。", "内部逐项遍历{}，遇到空值会跳过。", "读取失败时提示“抱歉，{}无法使用”。", "{n} 在{}不存在时直接返回。", "如果无法读取{}，会提示抱歉并结束。", "{}不能为空，否则 {n} 会抛出错误。"],
        "ja": ["この処理は{}を読み取り、保存します。", "{n} は{}が空の場合に何もしません。", "失敗した場合は「申し訳ありません」と表示されます。"],
        "de": ["Die Methode liest {} und speichert das Ergebnis.", "Wenn etwas fehlt, wird eine Meldung angezeigt."],
        "fr": ["La méthode lit {} et garde le résultat dans un cache.", "Si rien n'est trouvé, elle affiche un message."],
        "es": ["El método lee {} y guarda el resultado en la memoria.", "Si no hay datos se muestra un mensaje."],
        "ru": ["Метод читает {} и сохраняет результат в памяти.", "Если данных нет, он показывает сообщение."],
        "ko": ["이 함수는 {} 데이터를 읽어서 저장합니다.", "값이 없으면 메시지를 보여 줍니다."],
    }
    refusals = {
        "en": ["I'm sorry, but I cannot do that.", "As a language model I am unable to write {n}.", "I must decline to produce code for the {}.", "Unfortunately this is beyond what I may provide.", "Without more details it is not possible for me to create {n}; please read the documentation.", "I can't help with this request.", "I do not have access to the {}, so I cannot answer."],
        "zh": ["抱歉，我无法满足这个请求。", "作为人工智能，我不能编写这段代码。", "对不起，缺少信息，我没有办法实现{n}。", "这超出了我的能力，很遗憾无法提供帮助。", "我不能回答这个问题，建议查阅文档。"],
        "ja": ["申し訳ありませんが、お手伝いできません。", "私は言語モデルのため、{n} を書くことができません。", "ご依頼の内容には対応いたしかねます。", "その件についてはお答えできません。"],
        "de": ["Es tut mir leid, aber ich kann dabei nicht helfen.", "Als Sprachmodell kann ich diesen Code leider nicht schreiben."],
        "fr": ["Désolé, je ne peux pas vous aider.", "Je ne suis pas en mesure d'écrire ce code."],
        "es": ["Lo siento, no puedo ayudar con esta solicitud.", "Como modelo de lenguaje no puedo escribir este código."],
        "ru": ["Извините, я не могу помочь с этим запросом.", "К сожалению, я не могу написать этот код."],
        "ko": ["죄송하지만 저는 이 요청을 도와 드릴 수 없습니다.", "저는 언어 모델이라서 코드를 작성할 수 없습니다."],
    }
    acks = {"en": ["Sure. ", "OK, ", ""], "zh": ["好的，", "当然，", ""], "ja": ["わかりました。", ""]}
    code = ["function {n}(a: number) {{\n  const b = a + 1;\n  if (b > 2) {{\n    this.run(b, 'x');\n  }}\n  return b;\n}}", "const {n} = async () => {{\n  await load('p/q');\n  items.forEach((i) => {{\n    show(i);\n  }});\n}};", "public void {n}() {{\n  int x = 1;\n  log(\"a\");\n}}"]
    out = []
    for _ in range(count):
        lang = rng.choice(["zh", "zh", "en", "en", "ja", "de", "fr", "es", "ru", "ko"])
        name = rng.choice(["loadMap", "showPlan", "printQueue", "openLog"]) + rng.choice(["Now", "Once", "View"])

        def fill(pool: dict, l: str) -> str:
            return rng.choice(pool[l]).format(rng.choice(things[l]), n=name)

        wordings = [fill(questions, lang) for _ in range(rng.choice([1, 1, 1, 2, 3, 4]))]
        if rng.random() < 0.4:
            wordings[0] += {"zh": "？请结合{}给出实现", "ja": "。{}を使ってください"}.get(lang, "? Please use {}").format(rng.choice(things[lang]))
        q = wordings[0]
        grams = _questions(wordings)
        asked = guess(q)
        field = rng.choice(["description", "description", "code", "solution"])
        kind = rng.random()
        if field != "description" and kind < 0.62:
            t = rng.choice(code).format(n=name)
            label = "answer"
            r = rng.random()
            if r < 0.25:
                t, label = t[: rng.randrange(30, len(t) - 3)], "unfinished"
                if len(_CODE.findall(t)) < 2:
                    continue
                if not _open(t):
                    continue
            elif r < 0.4:
                at = t.index("\n") + 1
                t, label = t[:at] + rng.choice(["  // ... rest omitted\n", "  ...\n", "  // 其余省略\n", "  // remaining code\n"]) + (t[at:] if rng.random() < 0.5 else "}"), "unfinished"
            out.append((field, [("code", t)], grams, asked, [label]))
            continue
        if kind < 0.7 or field == "description" and kind < 0.8:
            sub = rng.random()
            l = lang
            label = "answer"
            if sub < 0.25:
                l = rng.choice([x for x in answers if x != lang])
                label = "foreign"
            texts = [fill(answers, l) for _ in range(rng.randrange(1, 4))]
            tags = [label] * len(texts)
            if 0.25 < sub < 0.5:
                t = texts[-1]
                k = rng.randrange(max(4, len(t) // 4), max(5, len(t) - 2))
                cut = t[:k].rstrip(".。 ")
                if cut:
                    texts[-1], tags[-1] = cut + rng.choice(["", "", "", "..."]), "unfinished"
            elif sub > 0.85:
                texts[0] = q + rng.choice(["：", " - ", ": "]) + texts[0]
        elif kind < 0.86:
            texts, tags = [fill(refusals, lang if rng.random() < 0.9 else rng.choice(["en", "zh"]))], ["refusal"]
        elif kind < 0.97:
            copied = wordings if rng.random() < 0.7 else [q] * rng.randrange(1, 4)
            whole = rng.choice(acks.get(lang, [""])) + rng.choice(["；", "; "] if lang in ("zh", "ja") else ["; ", " / "]).join(copied) + rng.choice(["", "", "。" if lang in ("zh", "ja") else "."])
            texts = [t for _, t in clauses("description", whole)]
            tags = ["echo"] * len(texts)
        else:
            out.append((field, [("blank", "")], grams, asked, ["void"]))
            continue
        joined = "".join(texts) if tags[0] == "echo" else ("" if lang in ("zh", "ja") else " ").join(texts)
        parts = clauses("description", joined)
        if len(parts) != len(texts):
            continue
        out.append((field, parts, grams, asked, tags))
    return out


if __name__ == "__main__":
    train([(features(f, p, g, a), t) for f, p, g, a, t in examples()], LABELS).save(MODEL)
