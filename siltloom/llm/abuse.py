"""Abusive, hateful and sexual content: a score for every text from a misspelling-proof lexicon and its context windows.

The words of abuse form a trie.  Every word of a text is run through the Levenshtein automaton of that trie, in which the
usual disguises are free edits (digits and signs for letters, stars for any letter, drawn-out letters) and true edits
are allowed by the term's length; each distinct word is matched once per worker.  Terms of several words and of unspaced
scripts are found in one Aho-Corasick pass.  A hit opens a window, its sentence.  What else stands in the window is
looked up in a second lexicon of contexts: who is addressed, groups, generic claims, threats, offers on one side, and quotation,
word lists, technical use, teaching, self-reproach on the other.  A log-linear model over these concepts and their pairs
(``abuse_model.json``) gives the window's probability of being abusive, hateful or sexual.  It is fitted on the rated sentences of
moderation_samples (a fixed table) and on sentences made by ``abuse_examples`` (``python -m siltloom.llm.abuse_fit``).
"""

from __future__ import annotations

import math
import re
import unicodedata
from functools import lru_cache
from pathlib import Path

import ahocorasick

from siltloom.llm.abuse_words import BODY, CONTEXTS, HARMLESS, POSSESSIVES, TERMS, UNSPACED
from siltloom.llm.crf import Chain

MODEL = Path(__file__).with_name("abuse_model.json")
LABELS = ["none", "abusive", "hateful", "sexual"]
_SENT = re.compile(r"[^.!?。！？\n]*(?:[.!?。！？]+|\n|$)")
_WORDS = re.compile(r"[A-Za-zÀ-ɏЀ-ӿ@$0-9*]+(?:'[a-z]+)?")
_HIDDEN = re.compile("[­​-‏⁠-⁤﻿]")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_] ){2,}[^\W\d_](?![^\W_])|(?<![^\W_])(?:[^\W\d_]\*){2,}[^\W\d_](?![^\W_])|(?<![^\W_])(?:[^\W\d_][-_·.]){3,}[^\W\d_](?![^\W_])")
_SPACED_HINT = re.compile(r"[ *_·.-][^\W\d_][ *_·.-][^\W\d_](?![^\W_])")
_WIDE = re.compile("[０-９Ａ-Ｚａ-ｚ＠＄]+")
_CJK = "ぁ-ヿ㐀-鿿가-힣"
_GAP = re.compile(rf"(?<=[{_CJK}])[*\-·_ 　.~]{{1,2}}(?=[{_CJK}])")
_MASK = re.compile(r"([ぁ-ヿ㐀-鿿])\*{1,3}([ぁ-ヿ㐀-鿿])")
#: Letters that digits and signs stand for.
_FOR = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
#: Groups that no list can name: people of somewhere, capitalised plurals behind "all", 人 behind a place.
_GROUPS = re.compile(r"\b(?:people|those|folks?|men|women) (?:from|of|in)\b|\b[Aa]ll (?:the )?(?:[A-Z]\w+(?:s|folk)\b|\w+ (?:people|women|men)\b)|\b(?:Alle|Die) [A-Z]\w+|[一-鿿]{1,4}(?:人|族|来的|教徒)(?=都|全|就|没|是|应|不配|滚|天生|统统)|(?:人|族|者|たち)(?:は|なんか|って)(?:みんな|全員|皆)?|[가-힣]+(?:인|사람|들)(?:은|는) ")
_QUOTED = re.compile(r"[“\"「『‘'`][^“”\"「」『』‘’'`\n]{1,24}[”\"」』’'`]")
_SELF = re.compile(r"\b(?:i|i'm) (?:am|was|feel|felt|'m)?\b[^.]{0,12}|\bmy (?:own )?\w+ (?:mistake|fault|bug|error|code)\b|\bstupid me\b|我自己|我真|我太|我才|是我(?:太)?|自分が|ich bin\b|je suis\b|soy un\b|я (?:сам|такой)\b", re.I)


def _edits(term: str) -> int:
    """The edits that a term bears: none below six letters, one below ten, else two."""
    return 0 if len(term) < 6 else 1 if len(term) < 10 else 2


class Trie:
    """The terms of abuse; ``near`` intersects them with the Levenshtein automaton of a word."""

    def __init__(self, words: dict[str, str]):
        self.root: dict = {}
        for word, cls in words.items():
            node = self.root
            for ch in word:
                node = node.setdefault(ch, {"most": 0})
                node["most"] = max(node["most"], _edits(word))  # the edits that the terms below bear
            node[""] = (word, cls)

    def near(self, word: str, most: int | None = None) -> tuple[str, str] | None:
        """The closest term, as (term, class), None beyond the allowed edits; ties go to the first term in order.

        Allowed are ``most`` edits, or as many as the term's length bears: none below six letters, one below ten, else two.
        A digit or sign for its letter, a star for any letter, and a letter drawn out are no edit.
        """
        n = len(word)
        drawn = [0 if i and word[i] == word[i - 1] != "*" else 1 for i in range(n)]
        start = [0]
        for i in range(n):
            start.append(start[-1] + drawn[i])
        best: tuple[int, str, str] | None = None
        stack = [(self.root, start)]
        while stack:
            node, row = stack.pop()
            for ch, child in node.items():
                if ch == "":
                    allowed = most if most is not None else _edits(child[0])
                    if row[n] <= allowed and (best is None or (row[n], child[0]) < best[:2]):
                        best = (row[n], *child)
                    continue
                if ch == "most":
                    continue
                limit = child["most"] if most is None else most
                last = row[0] + 1
                new, low = [last], last
                for i in range(n):
                    c, over, up = word[i], row[i], row[i + 1] + 1
                    if c != ch and c != "*" and ch not in _FOR.get(c, ""):
                        over += 1
                    last += drawn[i]
                    if over < last:
                        last = over
                    if up < last:
                        last = up
                    new.append(last)
                    if last < low:
                        low = last
                if low <= limit:
                    stack.append((child, new))
        return None if best is None else best[1:]


@lru_cache(1)
def _words() -> dict[str, str]:
    return {w: cls for cls, text in TERMS.items() for w in text.split("|") if w.isascii() or not re.search(f"[{_CJK}]", w)}


@lru_cache(1)
def _trie() -> Trie:
    return Trie(_words())


def _thin(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", word)


@lru_cache(1)
def _parts() -> tuple[dict[str, list[str]], ahocorasick.Automaton]:
    """The terms by their form without drawn-out letters, and their parts, one more than they bear edits: one of them an
    edited term keeps."""
    thin_of: dict[str, list[str]] = {}
    parts: dict[str, list[tuple[int, int, int, str]]] = {}
    for word in _words():
        thin, k = _thin(word), _edits(word)
        thin_of.setdefault(thin, []).append(word)
        cuts = [round(i * len(thin) / (k + 1)) for i in range(k + 2)]
        for a, b in zip(cuts, cuts[1:]):
            if k:
                parts.setdefault(thin[a:b], []).append((a, len(thin), k, word))
    automaton = ahocorasick.Automaton()
    for part, places in parts.items():
        automaton.add_word(part, (len(part), places))
    automaton.make_automaton()
    return thin_of, automaton


def branches(low: str) -> set[str]:
    """The terms that a word may be: those of its length of which it keeps a part about where the term has it."""
    forms = {low}
    if not low.isalpha():
        forms = {low.translate({ord(k): v[i % len(v)] for k, v in _FOR.items()}) for i in (0, 1)}
    known, parts = _parts()
    out: set[str] = set()
    for form in map(_thin, forms):
        out.update(known.get(form, ()))
        n = len(form)
        for end, (size, places) in parts.iter(form):
            at = end + 1 - size
            for offset, length, k, term in places:
                if -k <= n - length <= k and -k <= at - offset <= k:
                    out.add(term)
    return out


@lru_cache(4096)
def _branch(terms: frozenset[str]) -> Trie:
    """The part of the trie that holds these terms."""
    return Trie({w: cls for w, cls in _words().items() if w in terms})


@lru_cache(1)
def _terms() -> ahocorasick.Automaton:
    """Terms of several words, of unspaced scripts, and parts of the body of the one addressed."""
    automaton = ahocorasick.Automaton()
    entries = {w: cls for w, cls in _words().items() if " " in w}
    entries |= {w: cls for cls, text in UNSPACED.items() for w in text.split("|")}
    entries |= {f"{p} {b}": "body" for lang, words in BODY.items() for b in words.split() for p in POSSESSIVES[lang].split("|")}
    for w, cls in entries.items():
        automaton.add_word(w, (len(w), cls))
    automaton.make_automaton()
    return automaton


@lru_cache(1)
def _contexts() -> ahocorasick.Automaton:
    of: dict[str, set[str]] = {}
    for concept, text in CONTEXTS.items():
        for w in text.split("|"):
            of.setdefault(w, set()).add(concept)
    automaton = ahocorasick.Automaton()
    for w, concepts in of.items():
        automaton.add_word(w, (len(w), tuple(sorted(concepts))))
    automaton.make_automaton()
    return automaton


_seen: dict[str, str | None] = {}


def word_class(token: str) -> str | None:
    """The class of the term that a word spells, however it is disguised, or None.

    A word needs three characters, two of them plain, and at most twice as many digits and signs; one of stars needs its first and
    last letter and the term's length.
    """
    low = token.lower().strip("*")
    low = low.partition("'")[0] if "'" in low else low
    exact = _words().get(low)
    if exact is not None:
        return exact
    letters = sum(c.isalpha() for c in low)
    stars = low.count("*")
    if len(low) < 3 or letters < 2 or low in HARMLESS or len(low) - letters - stars > 2 * letters:
        return None
    if stars:
        hit = _trie().near(low)
    else:
        among = branches(low)
        hit = _branch(frozenset(among)).near(re.sub(r"(.)\1{3,}", r"\1\1\1", low)) if among else None
    if hit is None:
        return None
    term = hit[0]
    if stars:
        return hit[1] if len(low) == len(term) and term[0] == low[0] and term[-1] == low[-1] and low.find("*") > 0 and letters >= 2 else None
    # an edit in a plain word of the dictionary's look must leave its first letter or be far from short
    if low.isalpha() and low[0] != term[0] and len(term) < 8:
        return None
    return hit[1]


def _class(token: str) -> str | None:
    """``word_class``, remembered."""
    try:
        return _seen[token]
    except KeyError:
        pass
    found = None if token.isdigit() else word_class(token)
    if len(_seen) >= 400_000:
        _seen.clear()
    _seen[token] = found
    return found


@lru_cache(1)
def _masks() -> dict[tuple[str, str], str]:
    """The terms of unspaced scripts by first and last sign, of three signs or more."""
    return {(w[0], w[-1]): w for text in UNSPACED.values() for w in text.split("|") if len(w) >= 3 and " " not in w}


def _close(m: re.Match) -> str:
    """Single letters as one word; a first letter that may be a word of its own gives both readings."""
    whole = re.sub(r"[ *\-_·.]", "", m[0])
    return f"{whole} {whole[1:]}" if whole[0] in "aAiIoOyY" and len(whole) > 3 else whole


def normal(text: str) -> str:
    """The text without hidden characters, wide letters and gaps between single letters or signs."""
    if _HIDDEN.search(text):
        text = _HIDDEN.sub("", text)
    if not text.isascii():
        text = _WIDE.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text)
        if "*" in text:
            text = _MASK.sub(lambda m: _masks().get((m[1], m[2]), m[0]), text)
        text = _GAP.sub("", text)
    if _SPACED_HINT.search(text):
        text = _SPACED.sub(_close, text)
    return text


def _bounded(text: str, begin: int, end: int) -> bool:
    """Whether a term of letters stands between word boundaries; unspaced scripts need none."""
    first, last = text[begin], text[end - 1]
    spaced = lambda c: c.isalpha() and c < "ᄀ"
    if spaced(first) and begin and (text[begin - 1].isalnum() and spaced(text[begin - 1])):
        return False
    return not (spaced(last) and end < len(text) and text[end].isalnum() and spaced(text[end]))


def _hits(text: str, low: str) -> list[tuple[int, int, str]]:
    """(begin, end, class) of the terms."""
    out: list[tuple[int, int, str]] = []
    get = _class
    if any(map(get, set(_WORDS.findall(text)))):
        for m in _WORDS.finditer(text):
            cls = get(m[0])
            if cls:
                out.append((m.start(), m.end(), cls))
    forms = [low]
    if re.search(r"[a-z][@$013457][a-z@$]", low):
        forms.append(low.translate({ord(k): v[0] for k, v in _FOR.items()}))
    for form in forms:
        for end, (size, cls) in _terms().iter(form):
            if end < len(text) and _bounded(form, end + 1 - size, end + 1):
                out.append((end + 1 - size, end + 1, cls))
    if re.search(r"([a-z])\1\1|aa|ii", low):  # terms of several words with letters drawn out
        thin = re.sub(r"([a-z])\1+", r"\1", low)
        for end, (size, cls) in _terms().iter(thin):
            if size >= 8 and thin[end + 1 - size : end + 1].isascii() and _bounded(thin, end + 1 - size, end + 1):
                out.append((min(end, len(text) - 1), min(end + 1, len(text)), cls))
    return out


def concepts(window: str, terms: list[tuple[int, int, str]]) -> set[str]:
    """What stands in a window: the classes of its terms and the contexts around them."""
    found = {cls for _, _, cls in terms}
    low = window.lower()
    low = low if len(low) == len(window) else "".join(c.lower() if len(c.lower()) == 1 else c for c in window)
    addressed: list[int] = []
    for end, (size, names) in _contexts().iter(low):
        if _bounded(low, end + 1 - size, end + 1):
            found.update(names)
            if "you" in names:
                addressed.append(end)
    if _GROUPS.search(window):
        found.add("group")
    if _SELF.search(window):
        found.add("self")
    for m in _QUOTED.finditer(window):
        if any(m.start() < a and b < m.end() for a, b, _ in terms):
            found.add("quoted")
    if any(-24 <= a - end <= 24 for a, _, cls in terms if cls in ("insult", "degrade", "violent", "demean") for end in addressed):
        found.add("near")
    if len({window[a:b].lower() for a, b, _ in terms}) >= 2 and re.search(r"[、,，/|]", window):
        found.add("several")
    return found


def features(found: set[str]) -> list[str]:
    """The concepts and their pairs."""
    names = sorted(found)
    return ["bias", *names, *(f"{a}+{b}" for i, a in enumerate(names) for b in names[i + 1 :])]


@lru_cache(1)
def _model() -> Chain:
    return Chain.load(MODEL)


def chances(found: set[str]) -> dict[str, float]:
    """The probability of each label for a window with these concepts."""
    model = _model()
    sums = [0.0] * len(model.labels)
    for name in features(found):
        w = model.weights.get(name)
        if w is not None:
            sums = [s + x for s, x in zip(sums, w)]
    top = max(sums)
    powers = [math.exp(s - top) for s in sums]
    return {label: p / sum(powers) for label, p in zip(model.labels, powers)}


def windows(text: str | None) -> list[set[str]]:
    """The concepts of each sentence that holds a term; null and empty texts have none."""
    if not text:
        return []
    text = normal(text)
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    found = sorted(_hits(text, low))
    if not found:
        return []
    out, k = [], 0
    for m in _SENT.finditer(text):
        inside = []
        while k < len(found) and found[k][0] < m.end():
            inside.append(found[k])
            k += 1
        if inside:
            a, b = m.span()
            # an exclamation may cut a clause from its target: the next few characters still belong to the window
            tail = text[b : b + 24].split("\n")[0] if text[max(a, b - 2) : b].strip().endswith(("!", "！")) else ""
            out.append(concepts(text[a:b] + tail, [(x - a, y - a, cls) for x, y, cls in inside]))
        if k == len(found):
            break
    return out


def score(text: str | None) -> float:
    """The highest probability of abuse among the text's windows, to two places; 0.0 for null, empty and plain texts.

    From 0.5 on a text counts as abusive.  Windows are scored alone, so the length of a text does not matter.
    """
    return round(max((1 - chances(w)["none"] for w in windows(text)), default=0.0), 2)
