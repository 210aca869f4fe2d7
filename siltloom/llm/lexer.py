"""A fault-tolerant lexer for the script (ArkTS, TypeScript, plain script) and Java texts of the code tables.

``lex`` never raises and never loops: an unclosed string ends with its line, an unclosed block comment or
template is skipped as one bad character, and both are reported through ``Lexed.bad``, the offset of the
first fault (or -1).  Offsets count characters of the text as given.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

SCRIPT_WORDS = frozenset(
    "break case catch class const continue debugger default delete do else export extends finally for function if import in instanceof let new null return super switch this throw true false try typeof var void while await yield enum".split()
)
JAVA_WORDS = frozenset(
    "abstract assert boolean break byte case catch char class const continue default do double else enum extends final finally float for goto if implements import instanceof int interface long native new null package private protected public return short static strictfp super switch synchronized this throw throws transient true false try void volatile while".split()
)

_SCRIPT = re.compile(
    r"""(?P<ws>[^\S\n]+)|(?P<nl>\n\s*)|(?P<lc>//[^\n]*)|(?P<bc>/\*.*?\*/)|(?P<id>[^\W\d][\w$]*|\$[\w$]*|\#\w+)"""
    r"""|(?P<num>0[xXbBoO][0-9a-fA-F_]+n?|(?:\d[\d_]*\.?[\d_]*|\.\d[\d_]*)(?:[eE][+-]?\d+)?n?)"""
    r"""|(?P<str>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')"""
    r"""|(?P<op>\.\.\.|=>|===|!==|==|!=|<=|>=(?!>)|<<=|\*\*=|\?\?=|&&=|\|\|=|<<|\*\*|\?\?|\?\.(?!\d)|&&|\|\||\+\+|--|\+=|-=|\*=|%=|&=|\|=|\^=|[{}()\[\];,<>+\-*%&|^!~?:=.@])""",
    re.S,
)
_JAVA = re.compile(
    r"""(?P<ws>[^\S\n]+)|(?P<nl>\n\s*)|(?P<lc>//[^\n]*)|(?P<bc>/\*.*?\*/)|(?P<id>[^\W\d][\w$]*|\$[\w$]*)"""
    r"""|(?P<num>0[xXbB][0-9a-fA-F_]+[lL]?|(?:\d[\d_]*\.?[\d_]*|\.\d[\d_]*)(?:[eE][+-]?\d+)?[lLfFdD]?)"""
    r"""|(?P<str>\"\"\".*?\"\"\"|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)+')"""
    r"""|(?P<op>\.\.\.|->|::|==|!=|<=|>=(?!>)|<<=|<<|&&|\|\||\+\+|--|\+=|-=|\*=|/=|%=|&=|\|=|\^=|[{}()\[\];,<>+\-*/%&|^!~?:=.@])""",
    re.S,
)
_REGEX = re.compile(r"/(?![*/])(?:[^\\/\[\n]|\\.|\[(?:[^\]\\\n]|\\.)*\])+/[a-z]*")
_TPL = re.compile(r"[^`\\$]*(?:(?:\\.|\$(?!\{))[^`\\$]*)*(`|\$\{)", re.S)
_AFTER_VALUE = frozenset(["id", "num", "str", "tpl", "rx", ")", "]", "}", "this", "super", "null", "true", "false"])


@dataclass(slots=True)
class Lexed:
    """Parallel lists of the tokens, and the spans of comments and of string or template literals."""

    kind: list[str] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    fresh: list[bool] = field(default_factory=list)  # a line break comes before the token
    comments: list[tuple[int, int]] = field(default_factory=list)
    strings: list[tuple[int, int]] = field(default_factory=list)
    bad: int = -1


def lex(text: str, java: bool = False) -> Lexed:
    """Tokens of ``text``.  ``kind`` is the word or sign itself, or one of id num str tpl th tm tt rx bad.

    An empty text gives empty lists.
    """
    out = Lexed()
    kind, start, end, fresh = out.kind, out.start, out.end, out.fresh
    match, words = (_JAVA if java else _SCRIPT).match, JAVA_WORDS if java else SCRIPT_WORDS
    pos, n, line = 0, len(text), True
    braces: list[int] = []  # for each open brace -1, or the offset of the template it is a hole of

    def template(at: int, first: int) -> int:
        """Goes on in the template that began at ``first`` from ``at``; returns the offset behind the part."""
        m = _TPL.match(text, at)
        if m is None:
            return -1
        closed = m[1] == "`"
        whole = first == at - 1 and text[at - 1] == "`"
        kind.append(("tpl" if whole else "tt") if closed else ("th" if whole else "tm"))
        start.append(at - 1)
        end.append(m.end())
        fresh.append(line)
        if closed:
            out.strings.append((first, m.end()))
        else:
            braces.append(first)
        return m.end()

    while pos < n:
        m = match(text, pos)
        if m is None:
            c = text[pos]
            if c == "`" and not java and not text.startswith("```", pos):
                to = template(pos + 1, pos)
                if to > 0:
                    pos, line = to, False
                    continue
            elif c == "/" and not java:
                prev = kind[-1] if kind else ""
                r = None if prev in _AFTER_VALUE else _REGEX.match(text, pos)
                if r is not None and r.end() > pos + 1:
                    kind.append("rx")
                    to = r.end()
                else:
                    to = pos + 2 if text.startswith("/=", pos) else pos + 1
                    kind.append(text[pos:to])
                if text.startswith("/*", pos):
                    kind[-1] = "bad"
                    to = pos + 2
                    if out.bad < 0:
                        out.bad = pos
                start.append(pos)
                end.append(to)
                fresh.append(line)
                pos, line = to, False
                continue
            if out.bad < 0:
                out.bad = pos
            kind.append("bad")
            start.append(pos)
            to = pos + 3 if text.startswith("```", pos) else pos + 1
            if c in "\"'":  # an unclosed literal goes to the end of its line
                to = text.find("\n", pos)
                to = n if to < 0 else to
            end.append(to)
            fresh.append(line)
            pos, line = to, False
            continue
        k, to = m.lastgroup, m.end()
        if k == "ws":
            pos = to
            continue
        if k == "nl":
            pos, line = to, True
            continue
        if k == "lc":
            out.comments.append((pos, to))
            pos = to
            continue
        if k == "bc":
            out.comments.append((pos, to))
            line = line or "\n" in m[0]
            pos = to
            continue
        if k == "op":
            c = m[0]
            if java and c == "/" and text.startswith("/*", pos):
                if out.bad < 0:
                    out.bad = pos
                c, to = "bad", pos + 2
            if c == "{":
                braces.append(-1)
            elif c == "}" and braces:
                first = braces.pop()
                if first >= 0:
                    at = template(to, first)
                    if at > 0:
                        pos, line = at, False
                        continue
                    if out.bad < 0:
                        out.bad = first
            k = c
        elif k == "id":
            c = m[0]
            k = c if c in words else "id"
        elif k == "str":
            out.strings.append((pos, to))
        elif to < n and (text[to].isalpha() or text[to] == "_") and out.bad < 0:
            out.bad = pos  # a number runs into a word
        kind.append(k)
        start.append(pos)
        end.append(to)
        fresh.append(line)
        pos, line = to, False
    if any(b >= 0 for b in braces) and out.bad < 0:
        out.bad = next(b for b in braces if b >= 0)
    return out
