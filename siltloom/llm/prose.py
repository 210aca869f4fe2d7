"""Natural language inside code: comments and literals that hold prose, with their language.

``lexer.lex`` gives the spans.  One Aho-Corasick pass over each cleaned span finds the function words of all
languages at once; a hit counts only between word boundaries.  A word found in f of the languages votes for
each of them with log((1 + L) / f), L the number of languages, so that words which many share decide little.
Script ranges settle Chinese, Japanese and Korean, whose texts have no such words between blanks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

import ahocorasick

from siltloom.llm.lexer import lex

#: Function words by language.
FUNCTION_WORDS = {
    "en": "the a an and or of to in on at by for from with without is are was were be been being it its this that these those there here when while if then than so but not no yes only please may can could should must will would has have had do does did you your we our they their he she his her as before after until because both each once more most up down out over under again never keep call used which who what why how i my me us them into about between through during all any some such same too very just now also",
    "de": "der die das den dem des ein eine einen einem einer eines und oder nicht ist sind war waren wird werden wurde mit ohne von vom zu zum zur im in am an auf aus bei nach vor seit für über unter durch wenn weil dass damit bevor dann als auch nur noch schon sich es er sie wir ihr man muss müssen soll sollte sollten kann können darf bitte hier dort kein keine wieder und sehr mehr sein hat haben diese dieser dieses",
    "fr": "le la les un une des du de et ou ne pas est sont était être avec sans pour par sur sous dans en au aux ce cette ces il elle on nous vous ils elles que qui quoi dont où quand si mais parce avant après puis encore plus très il faut doit doivent peut veuillez son sa ses leur leurs avoir été tout tous toute lors depuis fois",
    "es": "el la los las un una unos unas y o no es son era ser está están con sin para por sobre en de del al lo se su sus este esta estos estas que quien cuando si pero porque antes después luego más muy hay debe deben puede por favor falta otra vez vuelva otro como desde hasta entre también ya todo todos",
    "ru": "и в во не на с со что это как по к ко у из за от до для или но а о об при без если когда чтобы потому что нет есть был была было были быть нужно можно следует сначала затем потом после перед снова уже ещё еще только все всё его её их мы вы они он она мне вас нас пожалуйста через этот эта эти то же бы ли удалось",
    "ko": "그리고 그러나 하지만 또는 또한 만약 때문에 다시 먼저 전에 후에 있는 없는 있습니다 없습니다 합니다 하세요 주세요 않습니다 것 수 및 등 이 그 저 중에 여기서",
}
#: Function words of other languages of the same scripts: where one of them has the most votes, the language is none of ours.
OTHER_WORDS = {
    "it": "il lo gli della dello delle dei degli del nel nella che per con non è una uno sono questo questa dopo prima anche più come quando perché può deve ogni se ma al alla dal dalla si ha hanno stato essere e di da su tra fra",
    "pt": "o os as um uma não com para por são do da dos das no na nos nas em ao pelo pela você este esta isso mais mas quando também já foi ser ou se que de e depois antes até há está",
    "nl": "het een van niet voor met zijn wordt worden ook maar naar deze dit dat die er je op om te aan bij of als nog kan moet zou heeft hebben geen wat wanneer hier en de is in was over",
    "pl": "nie jest się na do że jak ale lub oraz przez dla przed po tylko już może być są został który która to z w i od przy gdy",
    "sv": "och att det som en ett är inte för med på av till den har om kan ska var från vid eller när men så efter innan",
    "uk": "та що не є це для як або від після будь ласка який яка які якщо але був була було ще вже має треба з у в і й до на за про коли перед під час",
    "bg": "и на не се за от да с в по е са той тя това като със при без след преди или ако но има няма може трябва който която",
}
#: Letters that Russian does not have, and letters that are Cyrillic at all.
_NOT_RUSSIAN = re.compile("[іїєґўјљњћђџѓќѕІЇЄҐЎЈЉЊЋЂЏЃЌЅ]")
_SCRIPTS = re.compile(r"(?P<kana>[ぁ-ゖァ-ヺーｦ-ﾝ]+)|(?P<han>[㐀-䶿一-鿿豈-﫿々]+)|(?P<hangul>[가-힣ᄀ-ᇿㄱ-ㆎ]+)|(?P<cyr>[Ѐ-ԯ]+)|(?P<latin>[A-Za-zÀ-ɏ]+)")
_WORD = re.compile(r"(?<![\w./@#$\\-])[^\W\d_]+(?:['’][^\W\d_]+)*(?![\w/@#$\\(=]|\.\w)")
_CODE = re.compile(r"[;{}]\s*$|[\w\])]\s*(?:[-+*/]?=|=>|===?|!==?)\s*[\w'\"\[({]|\w\([\w.,\s'\"]*\)\s*[;.{]|^\s*(?:import|export|return|const|let|var|case|throw|new)\b.*[;'\"(=]|\)\s*=>|</?\w+[^>]*>\s*$", re.S)
_DIRECTIVE = re.compile(r"^\s*(?:eslint|tslint|jshint|jslint|prettier|@ts-|ts-ignore|ts-nocheck|istanbul|c8 |v8 |noinspection|nolint|noqa|pylint|@formatter|webpack|sourceMappingURL|# ?sourceMappingURL|#region|#endregion|region\b|endregion\b|@flow|@jsx|globals? |exported |spell-?checker|cspell|checkstyle|suppress|sonar|stylelint|biome|deno-|swiftlint|@suppress)", re.I)
_MARKER = re.compile(r"^\s*(?:(?:TODO|FIXME|XXX|HACK|NOTE|BUG|WARN(?:ING)?|OPTIMIZE|REVIEW|TBD)\b(?:\([^)]*\))?\s*[:：]?\s*)+", re.I)
_TAG = re.compile(r"^\s*@(?:param|throws|property|template|typedef|arg|argument|prop)\s+(?:\{[^}]*\}\s*)?[\w.$\[\]]+|^\s*@\w+(?:\s*\{[^}]*\})?", re.M)
_ESC = {"n": "\n", "t": "\t", "r": " "}
MIN_WORDS, MIN_CHARS = 4, 8
#: Votes that a language needs: more than one word that a third of all share.
FLOOR = 1.5


@lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    of: dict[str, set[str]] = {}
    for lang, words in (*FUNCTION_WORDS.items(), *OTHER_WORDS.items()):
        for word in set(words.split()):
            of.setdefault(word, set()).add(lang)
    automaton = ahocorasick.Automaton()
    for word, langs in of.items():
        weight = math.log((1 + len(FUNCTION_WORDS) + len(OTHER_WORDS)) / len(langs))
        automaton.add_word(word, (len(word), tuple(sorted(langs)), weight))
    automaton.make_automaton()
    return automaton


def votes(text: str) -> dict[str, float]:
    """Weight of the function words of each language, ours and others, in ``text`` (lower case)."""
    found: Counter = Counter()
    n = len(text)
    for end, (size, langs, weight) in _automaton().iter(text):
        begin = end - size + 1
        if begin and (text[begin - 1].isalnum() or text[begin - 1] in "_.$/") or end + 1 < n and (text[end + 1].isalnum() or text[end + 1] in "_$(/="):
            continue
        for lang in langs:
            found[lang] += weight
    return found


def _holes(text: str) -> str:
    """A template's text without its ``${...}`` parts."""
    out, i = [], 0
    while True:
        j = text.find("${", i)
        if j < 0:
            out.append(text[i:])
            return "".join(out)
        out.append(text[i:j])
        depth, k = 1, j + 2
        while k < len(text) and depth:
            depth += (text[k] == "{") - (text[k] == "}")
            k += 1
        out.append(" ")
        i = k


def clean(span: str) -> str:
    """The words of a comment or literal: no delimiters, escapes, template holes, tags or markers."""
    if span.startswith("//"):
        return _MARKER.sub("", span.lstrip("/").lstrip("!"))
    if span.startswith("/*"):
        lines = [line.strip().lstrip("*").strip() for line in span[2:-2].strip("*").split("\n")]
        return _MARKER.sub("", _TAG.sub("", "\n".join(lines)))
    body = span[3:-3] if span.startswith('"""') and len(span) >= 6 else span[1:-1]
    if span[0] == "`":
        body = _holes(body)
    return re.sub(r"\\(.)", lambda m: _ESC.get(m[1], m[1]), body, flags=re.S)


def language(span: str) -> str | None:
    """The language of the prose in a comment or literal (with its delimiters), None if it holds none.

    Prose has four words, or eight characters of Chinese or Japanese.  Disabled code, rulers, tool directives,
    keys, paths and URLs are none; a text whose votes tie goes to the alphabetically first language.
    """
    if len(span) < 10:
        return None
    is_comment = span[0] == "/"
    text = clean(span)
    if is_comment and (_DIRECTIVE.match(text) or _DIRECTIVE.match(span.lstrip("/*! \n"))):
        return None
    if "-----BEGIN" in text or "://" in text and " " not in text.strip():
        return None
    counts: Counter = Counter()
    for m in _SCRIPTS.finditer(text):
        counts[m.lastgroup] += len(m[0])
    cjk = counts["kana"] + counts["han"]
    if cjk >= MIN_CHARS and cjk >= counts["hangul"] and cjk >= counts["cyr"]:
        return "ja" if counts["kana"] * 8 >= cjk else "zh"
    words = _WORD.findall(text)
    if len(words) < MIN_WORDS:
        return None
    script = "ko" if counts["hangul"] > max(counts["cyr"], counts["latin"] / 3) else "ru" if counts["cyr"] > counts["latin"] / 2 else ""
    if not script and _CODE.search(text.strip()) and (is_comment or "\n" in text):
        return None
    return elected(text, script)


def elected(text: str, script: str = "") -> str | None:
    """The language with the most votes, None where that is none of ours or the votes are too few.

    The words of the text's own script vote.  A text in Hangul or Cyrillic whose function words say nothing, most of them
    being endings or left out, is Korean, or Russian if it has no letter that Russian lacks.
    """
    found = votes(text.lower())
    ours = {"ko": ("ko",), "ru": ("ru", "uk", "bg")}.get(script, [lang for lang in (*FUNCTION_WORDS, *OTHER_WORDS) if lang not in ("ko", "ru", "uk", "bg")])
    found = {lang: found[lang] for lang in ours if lang in found}
    best = max(sorted(found, key=lambda lang: (lang in OTHER_WORDS, lang)), key=found.__getitem__, default=None)
    if script == "ru" and _NOT_RUSSIAN.search(text):
        return None
    if script and (best is None or found[best] < FLOOR):
        return script
    return best if best in FUNCTION_WORDS and found[best] >= FLOOR else None


def spans(text: str | None, java: bool = False) -> list[tuple[int, int, str, str]]:
    """(offset, length, kind, language) of each complete prose comment or literal of a source text.

    A line comment at the very end of a text that breaks off (brackets are open) is not complete.
    Null and empty texts have none.
    """
    if not text:
        return []
    x = lex(text, java)
    out = []
    for a, b in x.comments:
        if b == len(text) and text.startswith("//", a) and x.kind.count("{") + x.kind.count("(") > x.kind.count("}") + x.kind.count(")"):
            continue
        lang = language(text[a:b])
        if lang:
            out.append((a, b - a, "comment", lang))
    for a, b in x.strings:
        lang = language(text[a:b])
        if lang:
            out.append((a, b - a, "string", lang))
    return out
