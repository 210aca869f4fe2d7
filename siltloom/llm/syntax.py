"""Full table-driven parsing of source texts: the first error that no reading of the text avoids.

The tokens of ``lexer.lex`` are marked with what a look at the matching bracket tells (arrow parameters, type
arguments, casts, UI child blocks, declarations), then a predictive parser with the tables of ``grammars``
runs over all of them.  A statement of a script may end at a line break, a closing brace or the end.
"""

from __future__ import annotations

from functools import lru_cache

from siltloom.llm.grammars import JAVA, SCRIPT, tables
from siltloom.llm.lexer import SCRIPT_WORDS, Lexed, lex

_OPEN, _CLOSE = {"(": ")", "[": "]", "{": "}"}, {")", "]", "}"}
_MODS = frozenset("private public protected static readonly override abstract declare".split())
_VALUE = frozenset(["id", "aid", "num", "str", "tpl", "tt", "rx", ")", "]", "}", "this", "super", "null", "true", "false", "T>"])
#: Behind these no value stands, so that < opens the type of an assertion.
_ASSERTED = frozenset(["=", "(", ",", "[", "return", "=>", "&&", "||", "??", "?", ":", "!", "..."])
_STARTS = frozenset(["", "{", "}", ";", "U{"])
_TYPE = frozenset(["id", ".", ",", "[", "]", "bar", "&", "str", "num", "null", "void", "this", "typeof", "true", "false", "?", "=>", "("])
_YIELDED = frozenset(["id", "num", "str", "new", "this", "null", "true", "false", "switch", "!", "tilde", "-", "+"])
_PRIM = frozenset("boolean byte char short int long float double".split())
_JMODS = frozenset("public private protected static final abstract native synchronized transient volatile strictfp default".split())
_RENAME = {"|": "bar", "~": "tilde"}


@lru_cache(None)
def _tables(java: bool) -> dict:
    return tables(JAVA if java else SCRIPT)


def _match(kind: list[str]) -> list[int]:
    """For each bracket the place of its partner, -1 for none and for other tokens."""
    to, stack = [-1] * len(kind), []
    for i, k in enumerate(kind):
        if k in _OPEN or k == "th":
            stack.append(i)
        elif k == "tm":
            if stack and kind[stack[-1]] in ("th", "tm"):
                stack[-1] = i
        elif k in _CLOSE or k == "tt":
            if stack and (_OPEN.get(kind[stack[-1]]) == k or k == "tt" and kind[stack[-1]] in ("th", "tm")):
                o = stack.pop()
                to[o], to[i] = i, o
    return to


def _skip_type(kind: list[str], to: list[int], i: int, stop: tuple[str, ...]) -> int:
    """The place of the first token of ``stop`` behind the type that begins at ``i``, or -1."""
    n, depth = len(kind), 0
    while i < n:
        k = kind[i]
        if depth == 0 and k in stop and not (k == "{" and kind[i - 1] in (":", "bar", "&", "<", ",")):
            return i
        if k in ("(", "[", "{"):
            if to[i] < 0:
                return -1
            i = to[i]
        elif k in ("<", "T<"):
            depth += 1
        elif k in (">", "T>"):
            depth -= 1
            if depth < 0:
                return -1
        elif k not in _TYPE and k != "extends":
            return -1
        i += 1
    return -1


def _angle(kind: list[str], to: list[int], i: int, java: bool) -> int:
    """The place of the sign that closes the type arguments opened at ``i``, or -1."""
    n, depth, j = len(kind), 0, i
    while j < n:
        k = kind[j]
        if k == "<":
            depth += 1
        elif k == ">":
            depth -= 1
            if depth == 0:
                return j
        elif k in ("(", "{", "["):
            if to[j] < 0 or java and k != "[":
                return -1
            j = to[j]
        elif k not in _TYPE and k not in ("extends", "super", "@") and k not in _PRIM:
            return -1
        j += 1
    return -1


def mark_script(text: str, x: Lexed) -> list[str]:
    """The kinds of ``x`` with the marks that the script grammar needs."""
    kind = [_RENAME.get(k, k) for k in x.kind]
    n, to, fresh = len(kind), _match(kind), x.fresh
    start, end = x.start, x.end
    depth = 0
    closers: set[int] = set()
    asserted: set[int] = set()
    kind = kind + ["", "", ""]
    for i in range(n):
        k, prev, nxt = kind[i], kind[i - 1] if i else "", kind[i + 1]
        if k == "id":
            if prev in (".", "?."):
                continue
            if nxt == "=>":
                kind[i] = "aid"
                continue
            word = text[start[i] : end[i]]
            first = prev in _STARTS or fresh[i]
            if depth == 0 and (first or prev in ("mod", "async", "*", "acc")):
                o = i + 1
                if nxt == "<":
                    o = _angle(kind, to, o, False) + 1
                if o > 0 and kind[o] == "(" and to[o] > 0:
                    c = to[o] + 1
                    if kind[c] == "{" or kind[c] == ":" and _skip_type(kind, to, c + 1, ("{",)) > 0:
                        kind[i] = "mname"
                        if prev == "async":
                            kind[i - 1] = "mod"
                        continue
            if nxt == ":" and first and kind[i + 2] in ("for", "while", "do", "switch"):
                kind[i] = "label"
            elif word in _MODS:
                if (nxt in ("id", "str", "[", "class", "@", "const", "function", "enum", "*") or nxt in SCRIPT_WORDS and nxt not in ("in", "instanceof")) and not fresh[i + 1]:
                    kind[i] = "mod"
                elif word == "static" and nxt == "{" and depth and prev in ("{", "}", ";"):
                    kind[i] = "mod"  # a class's initialiser
            elif word == "async":
                if (nxt in ("function", "(", "*") or nxt == "id") and not fresh[i + 1]:
                    if nxt == "(":
                        c = to[i + 1] + 1
                        if not c or not (kind[c] == "=>" or kind[c] == ":" and _skip_type(kind, to, c + 1, ("=>",)) > 0):
                            continue
                    kind[i] = "async"
            elif word in ("struct", "interface"):
                if nxt == "id" and prev not in ("=", "(", ","):
                    kind[i] = "classword"
            elif word in ("namespace", "module"):
                if nxt in ("id", "str") and not fresh[i + 1]:
                    kind[i] = "nsword"
            elif word == "type":
                if nxt == "id" and not fresh[i + 1] and kind[i + 2] in ("=", "<"):
                    kind[i] = "typeword"
            elif word in ("as", "satisfies"):
                if (prev in _VALUE or prev in ("*", "default", "postbang")) and not fresh[i] and nxt not in (",", "=", ";", ")", "}", ":", ".", "("):
                    kind[i] = "asword"
            elif word == "of":
                if (prev in ("]", "}") or i > 1 and kind[i - 2] in ("const", "let", "var", "(")) and nxt not in (",", ";", ")", "=", ".", ":"):
                    kind[i] = "ofword"
            elif word == "from":
                if nxt == "str" and prev in ("id", "}", "*"):
                    kind[i] = "fromword"
            elif word in ("get", "set"):
                if (nxt in ("id", "str", "num", "[") or nxt in SCRIPT_WORDS) and not fresh[i + 1] and prev in ("{", "}", ";", ",", "mod", "") or (nxt == "id" and fresh[i] and not fresh[i + 1]):
                    kind[i] = "acc" if depth else "mod"
            elif word == "is":
                if prev in ("id", "this") and nxt == "id" and i > 1 and kind[i - 2] == ":":
                    kind[i] = "isword"
            elif word in ("keyof", "infer", "unique"):
                if nxt == "id":
                    kind[i] = "keyofword"
            elif word == "implements":
                if prev in ("id", ">", "T>") and nxt == "id":
                    kind[i] = "implementsword"
            elif word == "lazy" and prev == "import" and nxt in ("{", "id") and kind[i + 2] != "fromword":
                kind[i] = "lazyword"
        elif k in ("{", "[", "th"):
            depth += 1
            if k == "{" and prev == ")" and depth > 1 and not fresh[i]:
                o = to[i - 1]
                if o > 1 and kind[o - 1] in ("id", "mname") and (kind[o - 2] in _STARTS or fresh[o - 1]):
                    kind[i] = "U{"
        elif k in ("}", "]", "tt"):
            depth -= 1
        elif k == "(":
            depth += 1
            c = to[i] + 1
            if c:
                if kind[c] == "=>" or kind[c] == ":" and prev not in ("id", ")", "]", "?", "mname", "T>", "function") and _skip_type(kind, to, c + 1, ("=>",)) > 0:
                    kind[i] = "A("
        elif k == ")":
            depth -= 1
        elif k == "<":
            if prev in ("id", "mname") or prev in ("=", "(", ",", "return", ":", "=>"):
                c = _angle(kind, to, i, False)
                if c > 0 and kind[c + 1] == "(" and (prev == "id" or prev == "mname" or kind[to[c + 1] + 1] in ("=>", ":")):
                    kind[i] = "T<"
                    closers.add(c)
            if kind[i] == "<" and prev in _ASSERTED:
                c = _angle(kind, to, i, False)
                if c > 0 and kind[c + 1] in ("id", "(", "[", "{", "str", "num", "this", "new", "null", "await", "tpl", "th"):
                    kind[i], asserted = "C<", {*asserted, c}
        elif k == ">":
            if i in closers:
                kind[i] = "T>"
            elif i in asserted:
                kind[i] = "C>"
        elif k == "!":
            if prev in _VALUE and not fresh[i]:
                kind[i] = "postbang"
        elif k in ("++", "--"):
            if prev in _VALUE and not fresh[i]:
                kind[i] = "postinc"
        elif k in SCRIPT_WORDS:
            if prev in (".", "?.") or nxt == ":" and (prev in ("{", ",") or fresh[i]) and k not in ("default", "case", "null", "true", "false", "this") or nxt == ":" and k == "default" and prev in ("{", ",") and kind[i + 2] != "bad" and _in_object(kind, i):
                kind[i] = "id"
            elif k == "import" and nxt in ("(", "."):
                kind[i] = "importx"
    return kind[:n]


def _in_object(kind: list[str], i: int) -> bool:
    """Whether ``default:`` at ``i`` is a key: a switch's block would follow a bracket."""
    return not (kind[i - 1] == "{" and i > 1 and kind[i - 2] == ")")


def mark_java(text: str, x: Lexed) -> tuple[list[str], list[int]]:
    """The kinds of ``x`` with the marks that the Java grammar needs, and for each the place of its token."""
    kind = [_RENAME.get(k, k) for k in x.kind]
    n, to = len(kind), _match(kind)
    kind = kind + ["", "", ""]
    closers: set[int] = set()
    before: set[int] = set()
    at_start = _JMODS | {"", ";", "{", "}", "(", ")", "->", ":", "T>", ">", ",", "else", "do"}
    for i in range(n):
        k, prev, nxt = kind[i], kind[i - 1] if i else "", kind[i + 1]
        if k == "<":
            if prev in ("id", ".", "") or prev in _JMODS or prev in ("{", "}", ";"):
                c = _angle(kind, to, i, True)
                if c > 0 and kind[c + 1] in ("id", "(", "[", ")", ",", ">", "{", ".", "::", "...", "&", "extends", "implements", ";", "void", "=") or c > 0 and kind[c + 1] in _PRIM:
                    kind[i] = "T<"
                    closers.add(c)
        elif k == ">" and i in closers:
            kind[i] = "T>"
        elif k == "(":
            c = to[i]
            if c > 0:
                if kind[c + 1] == "->":
                    kind[i] = "L("
                elif prev not in ("id", ")", "]", "mname", "T>", "this", "super", "if", "while", "for", "switch", "catch", "synchronized"):
                    e = _java_type(kind, to, i + 1)
                    if e == c and (kind[i + 1] in _PRIM or kind[c + 1] in ("id", "str", "num", "(", "!", "tilde", "this", "new", "super", "null", "true", "false")):
                        kind[i] = "cast("
        elif k in ("++", "--"):
            if prev in _VALUE:
                kind[i] = "postinc"
        if (k == "id" or k in _PRIM) and kind[i] == k:
            if k == "id" and prev in ("{", "}", ";", ":", "->") and nxt in _YIELDED and text[x.start[i] : x.end[i]] == "yield":
                kind[i] = "yieldword"
                continue
            if k == "id" and nxt == "->" and prev not in ("case", ","):
                kind[i] = "lid"
                continue
            if k == "id" and prev == "(" and nxt == "=" and i > 2 and kind[i - 2] == "id" and kind[i - 3] == "@":
                kind[i] = "kid"
                continue
            if k == "id" and prev == "void" and nxt == "(":
                kind[i] = "mname"
                continue
            if prev in at_start or prev == "id" and i > 1 and kind[i - 2] == "@":
                e = _java_type(kind, to, i)
                if e > 0 and kind[e] == "id":
                    f = kind[e + 1]
                    if f == "(":
                        if prev not in ("(", ",", "->", "else", "do"):
                            before.add(i)
                            kind[e] = "mname"
                    elif f in ("=", ";", ",", ":", "[", ")"):
                        before.add(i)
                elif e > 0 and kind[e] in ("...", "this"):
                    pass
                elif k == "id" and nxt == "(" and to[i + 1] > 0 and kind[to[i + 1] + 1] in ("{", "throws") and prev not in ("(", ",", "->", ")"):
                    kind[i] = "mname"
    out, place = [], []
    for i in range(n):
        if i in before:
            out.append("decl")
            place.append(i)
        out.append(kind[i])
        place.append(i)
    return out, place


def _java_type(kind: list[str], to: list[int], i: int) -> int:
    """The place behind the Java type that begins at ``i``, or -1."""
    if kind[i] in _PRIM:
        i += 1
    elif kind[i] == "id":
        i += 1
        while True:
            if kind[i] in ("<", "T<"):
                depth, j = 0, i
                while kind[j]:
                    if kind[j] in ("<", "T<"):
                        depth += 1
                    elif kind[j] in (">", "T>"):
                        depth -= 1
                        if depth == 0:
                            break
                    elif kind[j] not in ("id", ".", ",", "?", "extends", "super", "&", "[", "]", "@") and kind[j] not in _PRIM:
                        return -1
                    j += 1
                if not kind[j]:
                    return -1
                i = j + 1
            if kind[i] == "." and kind[i + 1] == "id":
                i += 2
            else:
                break
    else:
        return -1
    while kind[i] == "[" and kind[i + 1] == "]":
        i += 2
    return i


def first_error(text: str, java: bool = False) -> int:
    """The offset of the first token (or the end) that no reading of ``text`` allows, -1 for a valid text.

    A null, empty or blank text, and one of comments alone, is valid.
    """
    if not text:
        return -1
    x = lex(text, java)
    if java:
        kinds, place = mark_java(text, x)
    else:
        kinds, place = mark_script(text, x), None
    table = _tables(java)
    stack = ["program"]
    fresh, pop, extend = x.fresh, stack.pop, stack.extend
    bad = x.bad
    for i, k in enumerate(kinds):
        while stack:
            top = pop()
            row = table.get(top)
            if row is None:
                if top == k:
                    break
                if top == "SEMI":
                    if k == ";":
                        break
                    if k == "}" or fresh[i]:
                        continue
                at = x.start[place[i] if place else i]
                return at if bad < 0 else min(at, bad)
            right = row.get(k)
            if right is None:
                right = row.get(None)
                if right is None:
                    at = x.start[place[i] if place else i]
                    return at if bad < 0 else min(at, bad)
            if right:
                extend(right)
        else:
            at = x.start[place[i] if place else i]
            return at if bad < 0 else min(at, bad)
    while stack:
        top = pop()
        row = table.get(top)
        if row is None:
            if top == "SEMI":
                continue
            return len(text) if bad < 0 else bad
        right = row.get(None)
        if right is None:
            return len(text) if bad < 0 else bad
        if right:
            extend(right)
    return bad
