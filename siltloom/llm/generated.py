"""Source nobody wrote by hand: tool output, packed scripts, third-party copies and data kept as code.

Each file's tokens are reduced to grammars by replacing pairs (Re-Pair).  Every kind has a score from what the grammars
show, and what the file's head and path say is added to it; from ``THRESHOLD`` on the file is of the kind:

* generated: the rules of the abstract tokens cover nearly all of the file, shorten it much, and one of them, used over and
  over, stands for a large part;
* packed: next to no blanks and names of one or two letters;
* blob: the file is one literal that a grammar over its characters hardly shortens, or a bare table that rules cover;
* third party: its head or path says so, or the rules of its own tokens recur in many repositories or in a file known as
  third-party code.  For these a second grammar is made whose pairs are chosen by the symbols' hashes alone
  (``shared_rules``), so that the same text gives the same rules in every file.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np

from siltloom.llm.lexer import lex

#: Scores add up; a file is of a kind from here on.
THRESHOLD = 0.7
#: What a path or a head is worth by itself: a sign that suffices, one that a little else must go with, a faint one.
SURE, STRONG, FAINT = 0.7, 0.4, 0.3
#: Path segments and file name forms of build output, packed files and third-party code.
_PATHS = [
    ("vendored", SURE, re.compile(r"(?:^|/)(?:oh_modules|node_modules|third[_-]?party|vendors?|vendored|bower_components|Pods|jspm_packages|libs?/[a-z][\w-]*-\d+(?:\.\d+)+|[\w-]+@\d+\.\d+[\w.]*)/")),
    ("vendored", FAINT, re.compile(r"(?:^|/)(?:external|extern|deps)/")),
    ("generated", STRONG, re.compile(r"\.(?:generated|gen|g|pb|autogen)\.\w+$|_(?:pb|pb2|generated|gen)\.\w+$|\.designer\.\w+$")),
    ("generated", FAINT, re.compile(r"(?:^|/)(?:build|gen|generated|__generated__|autogen|proto_out|codegen_out|out|\.preview|intermediates|\.hvigor)/")),
    ("packed", STRONG, re.compile(r"\.min\.\w+$|\.bundle\.\w+$|[.-]min\.js$|(?:^|/)dist/|\.[0-9a-f]{6,}\.(?:js|ts|mjs)$")),
]
#: What the first comments of such files say.
_HEADS = [
    ("generated", SURE, re.compile(r"@generated|<auto-?generated|auto-?\s?generated|machine-?\s?(?:made|generated|written)|(?:code|file|class|module|source)s? (?:is |was |were |are )?(?:automatically )?(?:generated|produced|created|emitted) (?:automatically|by|from|at|with|using)|^\W*generated (?:automatically|by|from|at|with|using|code|file)|自动(?:生成|产生|创建|产出)|(?:由|用)\s*\S+\s*(?:生成|产生)|自動生成|automatisch (?:erzeugt|generiert)|généré automatiquement|generado automáticamente", re.I | re.M)),
    ("generated", STRONG, re.compile(r"do not (?:edit|modify|change)|regenerate instead|changes will be lost|请勿(?:手动|手工)?(?:修改|编辑)", re.I)),
    ("vendored", SURE, re.compile(r"third[- ]party|(?:copied|taken|imported|forked|vendored|adapted) from \S+?[@ ]v?\d|第三方|三方库|^/\*!.*\bv?\d+\.\d+|@license\s+\S+\s+v?\d|\(c\) the \S+ contributors", re.I | re.M)),
    ("vendored", FAINT, re.compile(r"(?:copied|taken|imported|forked|vendored|adapted) from|upstream|@preserve|^/\*!.*licen[sc]e|\b(?:MIT|BSD-\d|ISC|MPL)[- ](?:license|clause)", re.I | re.M)),
    ("packed", SURE, re.compile(r"^/\*!?\s*\S+ bundle\s*\*/|webpackBootstrap|__webpack_require__|browserify|rollup", re.M)),
]
_TOP = re.compile(r"(?:\s*(?://[^\n]*(?:\n|\Z)|/\*.*?\*/|#[^\n]*\n|\"use strict\";?))+", re.S)


def repair(seq: list[int], least: int = 3, rounds: int = 24) -> tuple[list[int], dict[int, tuple[int, int]], Counter]:
    """A Re-Pair grammar: the final sequence, the rules, and how often each rule was put in.

    In each round every pair that occurs ``least`` times or more and no more frequent pair overlaps becomes a rule.
    It ends when no pair is left or after ``rounds`` (a rule of round r stands for up to 2**r tokens).
    """
    rules: dict[int, tuple[int, int]] = {}
    used: Counter = Counter()
    fresh = (max(seq) if seq else 0) + 1
    for _ in range(rounds):
        pairs = Counter(zip(seq, seq[1:]))
        chosen: dict[tuple[int, int], int] = {}
        first: set[int] = set()
        second: set[int] = set()
        for pair, count in sorted(((p, c) for p, c in pairs.items() if c >= least), key=lambda x: (-x[1], x[0])):
            a, b = pair
            if a in second or b in first or a in first and b in second:
                continue
            chosen[pair] = fresh
            rules[fresh] = pair
            first.add(a)
            second.add(b)
            fresh += 1
        if not chosen:
            break
        out, i, n = [], 0, len(seq)
        get = chosen.get
        while i < n:
            r = get((seq[i], seq[i + 1])) if i + 1 < n else None
            if r is None:
                out.append(seq[i])
                i += 1
            else:
                out.append(r)
                used[r] += 1
                i += 2
        if len(out) == len(seq):
            break
        seq = out
    return seq, rules, used


def expansions(rules: dict[int, tuple[int, int]]) -> dict[int, int]:
    """The number of tokens that each rule stands for."""
    size: dict[int, int] = {}
    for r, (a, b) in sorted(rules.items()):
        size[r] = size.get(a, 1) + size.get(b, 1)
    return size


@dataclass(slots=True)
class Signs:
    """What one file shows."""

    said: dict[str, float]  # by kind, what the path and the head are worth together
    cover: float  # share of the tokens that the final sequence's rules of 8 tokens or more stand for
    ratio: float  # (final sequence + 2 per rule) / tokens
    use: int  # how often the most used rule of 8 tokens or more was put in
    share: float  # the greatest share of the tokens that one rule of 8 tokens or more stands for, all its uses together
    literal: float  # share of the characters in the longest literal
    data: float  # share of the characters in literals and numbers
    dense: float  # how little a grammar over its characters shortens the longest literal
    calls: int  # brackets and words of control flow
    blanks: float  # share of blanks
    short: float  # share of names of one or two letters
    tokens: int
    words: list[int]  # hashes of its own tokens


def said(path: str | None, text: str) -> dict[str, float]:
    """What the path and the first comments are worth, by kind; of each only the weightiest sign of a kind counts."""
    out: dict[str, float] = {}
    top = _TOP.match(text.lstrip("\ufeff \t\r\n"))
    for signs_of, where in ((_PATHS, path or ""), (_HEADS, top[0] if top else "")):
        best: dict[str, float] = {}
        for kind, worth, pattern in signs_of:
            if worth > best.get(kind, 0) and pattern.search(where):
                best[kind] = worth
        for kind, worth in best.items():
            out[kind] = out.get(kind, 0) + worth
    return out


def signs(path: str | None, text: str | None) -> Signs:
    text = text or ""
    x = lex(text)
    n = len(x.kind)
    chars = max(1, len(text.strip()))
    code: dict[str, int] = {}
    last, rules, used = repair([code.setdefault(k, len(code)) for k in x.kind])
    size = expansions(rules)
    long = [r for r in rules if size[r] >= 8]
    longest = max(x.strings, key=lambda s: s[1] - s[0], default=(0, 0))
    dense = 0.0
    if longest[1] - longest[0] >= 200:
        signs_of = [ord(c) for c in text[longest[0] : longest[1]]]
        end, more, _ = repair(signs_of, 3, 6)
        dense = (len(end) + 2 * len(more)) / len(signs_of)
    names = [x.end[i] - x.start[i] for i, k in enumerate(x.kind) if k == "id" and not (i and x.kind[i - 1] in (".", "?."))]
    return Signs(
        said=said(path, text),
        cover=sum(size[s] for s in last if size.get(s, 1) >= 8) / max(1, n),
        ratio=(len(last) + 2 * len(rules)) / max(1, n),
        use=max((used[r] for r in long), default=0),
        share=max((used[r] * size[r] for r in long), default=0) / max(1, n),
        literal=(longest[1] - longest[0]) / chars,
        data=(sum(b - a for a, b in x.strings) + sum(x.end[i] - x.start[i] + 1 for i, k in enumerate(x.kind) if k == "num")) / chars,
        dense=dense,
        calls=sum(k in ("(", "if", "for", "while", "switch", "return", "function", "=>", "class") for k in x.kind),
        blanks=sum(map(text.count, " \t\r\n")) / max(1, len(text)),
        short=sum(s <= 2 for s in names) / max(1, len(names)),
        tokens=n,
        words=[crc32(text[a:b].encode("utf-8", "replace")) for a, b in zip(x.start, x.end)],
    )


def _mix(a: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of each number."""
    a = (a ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    a = (a ^ (a >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return a ^ (a >> np.uint64(29))


def shared_rules(files: list[list[int]], width: int = 24) -> list[list[int]]:
    """For each file, given as its tokens' hashes, the rules of ``width`` tokens or more of a pair grammar that is the same
    wherever the text is the same.

    In each round every symbol is a left or a right one by a bit of its hash, and each left one with a right one behind it
    becomes a rule, named by the hash of the two.  So equal texts have equal rules but at their ends, whatever stands
    around them, and rules need no counting across files.  Equal neighbours, which no bit can tell apart, are taken
    together first.  A rule that has reached ``width`` tokens is given and not built on.  Fewer tokens give none.
    All files go through the rounds together; between two files stands a symbol that takes part in no rule.
    """
    fence = 1 << 40
    lengths = np.array([len(f) for f in files], dtype=np.int64)
    symbol = np.array([w for f in files for w in (*f, 0)], dtype=np.uint64)
    symbol = _mix(symbol, 11)
    size = np.ones(len(symbol), dtype=np.int64)
    size[np.cumsum(lengths + 1) - 1] = fence
    with np.errstate(over="ignore"):
        for turn in range(1, 64):
            free = size < width
            same = np.append(False, (symbol[1:] == symbol[:-1]) & free[1:] & free[:-1])
            if same.any():
                first = np.flatnonzero(~same)
                times = np.diff(np.append(first, len(symbol)))
                size = np.add.reduceat(size, first)
                symbol = np.where(times > 1, _mix(symbol[first] + times.astype(np.uint64), 3), symbol[first])
                free = size < width
            if not (free[1:] & free[:-1]).any():
                break
            right = (_mix(symbol, 2 * turn + 1) >> np.uint64(63)).astype(bool)
            pair = np.flatnonzero(~right[:-1] & right[1:] & free[:-1] & free[1:])
            symbol[pair] = _mix(_mix(symbol[pair], 5) + symbol[pair + 1], 7)
            size[pair] += size[pair + 1]
            keep = np.ones(len(symbol), dtype=bool)
            keep[pair + 1] = False
            symbol, size = symbol[keep], size[keep]
    ends = np.flatnonzero(size >= fence)
    made = size >= width
    return [np.unique(symbol[a:b][made[a:b]].view(np.int64)).tolist() for a, b in zip(np.append(0, ends[:-1] + 1), ends)]


def _ramp(x: float, low: float, high: float) -> float:
    return min(1.0, max(0.0, (x - low) / (high - low)))


def scores(s: Signs) -> dict[str, float]:
    """The score of each kind; a text of fewer than 80 tokens has no grammar to speak of."""
    shaped = s.tokens >= 80
    # a few alike functions are no tool's output: how often the rule is used counts as a factor, full at ten uses
    often = 0.5 + 0.5 * _ramp(math.log2(max(1, s.use)), 2.3, 3.3)
    generated = often * (_ramp(s.cover, 0.5, 0.8) + _ramp(s.share, 0.2, 0.5) + _ramp(1 - s.ratio, 0.5, 0.7)) / 3 if shaped else 0.0
    packed = 0.5 * _ramp(s.short, 0.3, 0.6) + 0.5 * _ramp(-s.blanks, -0.14, -0.08) if shaped else 0.0
    blob = 0.0
    if s.calls == 0:
        # one literal that is nearly the whole file and does not shorten, or a table: data all through, one shape
        blob = max(_ramp(s.literal, 0.4, 0.7) * _ramp(s.dense, 0.3, 0.5), _ramp(s.data, 0.25, 0.45) * _ramp(s.cover, 0.5, 0.8) if s.tokens >= 120 else 0.0)
    base = {"generated": generated, "packed": packed, "blob": blob, "vendored": 0.0}
    return {kind: score + s.said.get(kind, 0.0) for kind, score in base.items()}


def kind(s: Signs) -> str | None:
    """The kind of the highest score, None for hand-written source; of equal ones vendored, packed, blob, generated."""
    found = scores(s)
    best = max(("vendored", "packed", "blob", "generated"), key=found.__getitem__)
    return best if found[best] >= THRESHOLD - 1e-9 else None
