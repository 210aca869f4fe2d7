"""Encoding with a public byte-level BPE vocabulary as a streaming transducer of bounded lookahead.

Every text takes the same path, whatever its length.  It is read in blocks, and between blocks only what is not yet
stable is kept:

* ``Transducer`` cuts the pre-split pieces off the front: a piece that ends two characters before the end of what was
  read is final, since no rule of the pre-split looks further.  A run of one class that outgrows the block goes on
  piecewise, in a state that only remembers its class.
* ``Runner`` turns the bytes of a piece into tokens.  For each byte it keeps the last token of the encoding of the
  prefix that ends there: the longest token that ends there and may stand behind the last token before it.  Whether two
  tokens may stand side by side is read off the merge list (``Merges.beside``).  A later byte can only build on one
  of the last ``lookahead`` prefixes, the length of the longest token, so what their token paths share is emitted.
* Where the two bytes before a place and the two behind it show that no token of the vocabulary can lie across it
  (``Borders``), it is a token's border with two bytes of lookahead.  The segments between such borders and whole
  pieces recur; what they gave is remembered in tables of bounded size.

``sizes`` counts the ids of texts without making them: the same pieces, borders and automaton, each new piece's borders
found together with those of others.  ``Decoder`` turns ids back into text piece by piece.
"""

from __future__ import annotations

import base64
import codecs
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltloom.common import spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that are read at a time (4 or more), and that a run may have before it goes on in a state of its own.
BLOCK = 1 << 16
#: Pieces and segments that are remembered at a time, and the longest that are.
KNOWN, KNOWN_CHARS = 1 << 18, 48
_PIECES = regex.compile(PATTERN)
#: The rest of a run by the class of its last character.
_CLASSES = [(regex.compile(r"\p{L}"), regex.compile(r"\p{L}*")), (regex.compile(r"\p{N}"), regex.compile(r"\p{N}*")), (regex.compile(r"\s"), regex.compile(r"\s*")), (regex.compile(r"[^\s\p{L}\p{N}]"), regex.compile(r"[^\s\p{L}\p{N}]*"))]
_BLANK = _CLASSES[2][1]


class Merges:
    """What the merge list says: ranks, the lookahead, which tokens may stand side by side, which bytes a token joins."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks: dict[bytes, int] = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.lookahead = max(map(len, self.ranks))
        sizes: dict[bytes, set[int]] = {}
        for token in self.ranks:
            if len(token) > 2:
                sizes.setdefault(token[-3:], set()).add(len(token))
        #: the lengths of the tokens of three bytes or more that end in these three bytes, the longest first
        self.sizes = {end: tuple(sorted(found, reverse=True)) for end, found in sizes.items()}
        self.halves_of: dict[int, tuple[int, int]] = {}
        self.known: dict[int, bool] = {}  # of two tokens, a << 20 | b, whether they may stand side by side

    def halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes ``token``; a single byte is its own halves."""
        found = self.halves_of.get(token)
        if found is None:
            get = self.ranks.get
            parts = [bytes((b,)) for b in self.bytes_of[token]]
            while len(parts) > 2:
                at = min(range(len(parts) - 1), key=lambda i: get(parts[i] + parts[i + 1], token))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            found = self.halves_of[token] = (self.ranks[parts[0]], self.ranks[parts[-1]])
        return found

    def beside(self, a: int, b: int) -> bool:
        """Whether the bytes of two tokens put together are encoded as just these two.

        The merges of both are undone, the later one first, as long as one of them is made; wherever the parts that
        meet at the border could have been merged earlier than what was undone, the border would not be there.
        """
        key = a << 20 | b
        get, text = self.ranks.get, self.bytes_of
        limit, answer = 1 << 62, True
        while True:
            over = get(text[a] + text[b])
            if over is not None and over < limit:
                answer = False
                break
            one_a, one_b = len(text[a]) == 1, len(text[b]) == 1
            if one_a and one_b:
                break
            if not one_a and (one_b or a > b):
                limit, a = a, self.halves(a)[1]
            else:
                # of equal ranks the left one is merged first, so the right one holds up to its own rank
                limit, b = b + 1, self.halves(b)[0]
        if len(self.known) >= KNOWN:
            self.known.clear()
        self.known[key] = answer
        return answer


@lru_cache(4)
def merges(path: str) -> Merges:
    return Merges(path)


class Borders(dict):
    """Of four bytes in a row, whether no token can lie across their middle, whatever stands around them.

    A token across it holds the middle two bytes: it is just these, or begins with them and the fourth byte, or holds the
    first three.
    """

    def __init__(self, path: str):
        super().__init__()
        self.ranks = merges(path).ranks
        self.heads = {token[:3] for token in self.ranks}
        self.parts = {token[i : i + 3] for token in self.ranks for i in range(len(token) - 2)}

    def __missing__(self, four: bytes) -> bool:
        if len(self) >= KNOWN:
            self.clear()
        found = self[four] = four[1:3] not in self.ranks and four[1:] not in self.heads and four[:3] not in self.parts
        return found


class Runner:
    """Tokens of one piece of bytes, emitted once no continuation can change them."""

    def __init__(self, path: str = VOCABULARY):
        self.merges = merges(path)
        self.lookahead = self.merges.lookahead
        self.fed = 0  # bytes that went through the automaton
        self.reset()

    def reset(self) -> None:
        self.tail = b""  # the bytes behind the last emitted token
        self.last: list[int] = []  # for each byte of the tail the last token of the prefix that ends there

    def feed(self, data: bytes) -> list[int]:
        out, step = [], self.lookahead
        for at in range(0, len(data), step):
            self._extend(data[at : at + step])
            if len(self.tail) >= 4 * step:
                out += self._stable()
        return out

    def _extend(self, data: bytes) -> None:
        tail = self.tail = self.tail + data
        self.fed += len(data)
        last = self.last
        m = self.merges
        get, sizes, may, beside = m.ranks.get, m.sizes.get, m.known.get, m.beside
        for end in range(len(last) + 1, len(tail) + 1):
            for size in sizes(tail[end - 3 : end], ()) if end > 2 else ():
                begin = end - size
                if begin < 0:
                    continue
                token = get(tail[begin:end])
                if token is None:
                    continue
                if begin:
                    before = last[begin - 1]
                    fits = may(before << 20 | token)
                    if not (beside(before, token) if fits is None else fits):
                        continue
                last.append(token)
                break
            else:
                token = get(tail[end - 2 : end]) if end > 1 else None
                if token is not None and end > 2:
                    before = last[end - 3]
                    fits = may(before << 20 | token)
                    if not (beside(before, token) if fits is None else fits):
                        token = None
                last.append(get(tail[end - 1 : end]) if token is None else token)

    def _stable(self) -> list[int]:
        n, size = len(self.tail), self.merges.bytes_of
        ends = set(range(n - self.lookahead, n + 1))
        while len(ends) > 1 and max(ends) > 0:  # walk the furthest path back until all paths meet
            e = max(ends)
            ends.discard(e)
            ends.add(e - len(size[self.last[e - 1]]))
        cut = next(iter(ends))
        out = self._path(cut)
        self.tail, self.last = self.tail[cut:], self.last[cut:]
        return out

    def _path(self, end: int) -> list[int]:
        out, size = [], self.merges.bytes_of
        while end > 0:
            token = self.last[end - 1]
            out.append(token)
            end -= len(size[token])
        return out[::-1]

    def finish(self) -> list[int]:
        out = self._path(len(self.tail))
        self.reset()
        return out


class Pieces(dict):
    """The tokens of pieces, remembered; a piece that is not known goes through the automaton segment by segment."""

    def __init__(self, path: str = VOCABULARY):
        super().__init__()
        self.runner = Runner(path)
        self.borders = Borders(path)
        self.segments: dict[bytes, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        data, borders, begin, parts = _bytes(piece), self.borders, 0, []
        for at in range(2, len(data) - 1):
            if borders[data[at - 2 : at + 2]]:
                parts.append(data[begin:at])
                begin = at
        found = tuple(chain.from_iterable(map(self._segment, [*parts, data[begin:]]))) if parts else self._segment(data)
        if len(piece) <= KNOWN_CHARS:
            if len(self) >= KNOWN:
                self.clear()
            self[piece] = found
        return found

    def _segment(self, data: bytes) -> tuple[int, ...]:
        found = self.segments.get(data)
        if found is None:
            found = (*self.runner.feed(data), *self.runner.finish())
            if len(data) <= KNOWN_CHARS:
                if len(self.segments) >= KNOWN:
                    self.segments.clear()
                self.segments[data] = found
        return found


@lru_cache(4)
def pieces(path: str) -> Pieces:
    """The worker's table of pieces."""
    return Pieces(path)


class SegmentSizes(dict):
    """The numbers of tokens of segments, remembered; a segment that is not known goes through the automaton."""

    def __init__(self, path: str):
        super().__init__()
        self.runner = Runner(path)

    def __missing__(self, data: bytes) -> int:
        found = len(self.runner.feed(data)) + len(self.runner.finish())
        if len(data) <= KNOWN_CHARS:
            if len(self) >= KNOWN:
                self.clear()
            self[data] = found
        return found


class PieceSizes:
    """The numbers of tokens of pieces; those of many new pieces are found at once, their borders in tables of three bytes."""

    def __init__(self, path: str = VOCABULARY):
        self.known: dict[str, int] = {}
        self.segments = SegmentSizes(path)
        borders = Borders(path)
        #: of three bytes in a row, 1: a token may cross behind the first, 2: behind the second
        self.across = np.zeros((256, 256, 256), dtype=np.uint8)
        for token in borders.ranks:
            if len(token) == 2:
                self.across[token[0], token[1]] = 1
        for a, b, c in (head for head in borders.heads if len(head) == 3):
            self.across[a, b, c] |= 1
        for a, b, c in borders.parts:
            self.across[a, b, c] |= 2
        self.across = self.across.ravel()

    def of(self, texts: list[list[str]]) -> list[int]:
        """The number of tokens of each text, given as its pieces."""
        met, known = set().union(*texts), self.known
        new = met.difference(known)
        if len(known) + len(new) > KNOWN:
            known.clear()
            new = met
        if new:
            self._learn(list(new))
        out = [sum(map(known.__getitem__, found)) for found in texts]
        for piece in new:
            if len(piece) > KNOWN_CHARS:
                del known[piece]
        return out

    def _learn(self, new: list[str]) -> None:
        parts = list(map(_bytes, new))
        data = b"".join(parts)
        row = np.frombuffer(data, dtype=np.uint8)
        ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))
        begins = np.append(0, ends[:-1])
        cut = np.zeros(len(row), dtype=bool)
        if len(row) > 3:
            three = row[:-2].astype(np.int32) << 16
            three |= row[1:-1].astype(np.int32) << 8
            three |= row[2:]
            across = self.across[three]
            cut[2:-1] = (across[1:] & 1 | across[:-1] & 2) == 0
            cut[begins[ends - begins > 1] + 1] = False  # a border shows by two bytes of the piece on either side
            cut[ends - 1] = False
        cut[begins] = True
        at = np.flatnonzero(cut)
        found = at.tolist()
        sizes = np.fromiter(map(self.segments.__getitem__, [data[a:b] for a, b in zip(found, [*found[1:], len(data)])]), dtype=np.int64, count=len(found))
        self.known.update(zip(new, np.add.reduceat(sizes, np.searchsorted(at, begins)).tolist()))


@lru_cache(4)
def piece_sizes(path: str) -> PieceSizes:
    """The worker's table of pieces' sizes."""
    return PieceSizes(path)


class Transducer:
    """Ids of a text that comes in parts; memory is bounded by the block, whatever the text's or a piece's length."""

    def __init__(self, path: str = VOCABULARY):
        self.path, self.known = path, pieces(path)
        self.rest = ""
        self.run: regex.Pattern | None = None  # the class of the long run that is being read
        self.runner: Runner | None = None

    def feed(self, part: str) -> list[int]:
        """The ids that are final now."""
        text, out = self.rest + part, []
        if self.run is not None:
            end = self.run.match(text).end()
            if end == len(text):
                return self._go_on(text)
            out = self._close(text, end)
            text = self.rest
        found = _PIECES.findall(text)
        left = len(text)
        while found and left > len(text) - 2:
            left -= len(found.pop())
        out.extend(chain.from_iterable(map(self.known.__getitem__, found)))
        self.rest = text[left:]
        if len(self.rest) > BLOCK:  # one run fills the block: it goes on in a state of its own
            self.run = next(rest for one, rest in _CLASSES if one.match(self.rest[-2]))
            self.runner = Runner(self.path)
            end = self.run.match(self.rest, 1).end()
            out += self._go_on(self.rest) if end == len(self.rest) else self._close(self.rest, end)
        return out

    def _go_on(self, text: str) -> list[int]:
        """Feeds a run that has not ended; its last character waits, since blanks leave theirs to the next piece."""
        self.rest = text[-1:]
        return self.runner.feed(_bytes(text[:-1]))

    def _close(self, text: str, end: int) -> list[int]:
        """Ends the run before ``end``, where another character follows."""
        cut = end - 1 if self.run is _BLANK else end
        out = self.runner.feed(_bytes(text[:cut])) + self.runner.finish()
        self.run = self.runner = None
        self.rest = text[cut:]
        return out

    def finish(self) -> list[int]:
        rest, self.rest = self.rest, ""
        if self.run is None:
            return list(chain.from_iterable(map(self.known.__getitem__, _PIECES.findall(rest))))
        out = self.runner.feed(_bytes(rest)) + self.runner.finish()
        self.run = self.runner = None
        return out


def _bytes(text: str) -> bytes:
    """The text as bytes; half of a surrogate pair is taken as the replacement sign."""
    try:
        return text.encode()
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode()


class Decoder:
    """Text of ids that come one by one; bytes of an unfinished character wait."""

    def __init__(self, path: str = VOCABULARY):
        self.one = merges(path).bytes_of.__getitem__
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return "".join(self.machine.decode(self.one(i)) for i in ids)

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)


def stream(text: str, path: str = VOCABULARY, block: int = BLOCK) -> Iterator[list[int]]:
    """The ids of a text that is read block by block, as they become final."""
    machine = Transducer(path)
    for at in range(0, len(text), block):
        yield machine.feed(text[at : at + block])
    yield machine.finish()


def encode(text: str | None, path: str = VOCABULARY) -> list[int]:
    """The ids of a whole text; null and empty texts have none ([])."""
    return list(chain.from_iterable(stream(text, path))) if text else []


@lru_cache(1)
def _plane() -> tuple[re.Pattern, re.Pattern]:
    """Characters beyond the first plane, and PATTERN with its classes listed within that plane, where ``re`` is faster."""

    def listed(kind: str) -> str:
        of = regex.compile(kind)
        held = [0, *(of.match(chr(c)) is not None for c in range(1 << 16)), 0]
        edge = [c for c in range(len(held) - 1) if held[c] != held[c + 1]]
        return "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in zip(edge[::2], edge[1::2]))

    letters, numbers, blanks = map(listed, (r"\p{L}", r"\p{N}", r"\s"))
    others = f"[^{blanks}{letters}{numbers}]"
    return re.compile("[\U00010000-\U0010ffff]"), re.compile(rf"'(?:[stmd]|re|ve|ll)| ?(?:[{letters}]+|[{numbers}]+|{others}+)|[{blanks}]+(?![^{blanks}])|[{blanks}]+")


def cut(text: str) -> list[str]:
    """The pieces of a text that is read as a whole."""
    beyond, within = _plane()
    return (_PIECES if beyond.search(text) else within).findall(text)


def sizes(texts: Iterable[str | None], path: str = VOCABULARY) -> list[int]:
    """The number of ids of each text, by the same pieces, borders and automaton, without the ids.

    The pieces of about four blocks of text are held at a time; a text longer than a block is streamed.
    """
    known, out, row, held = piece_sizes(path), [], [], 0
    for text in texts:
        text = text or ""
        if len(text) > BLOCK:
            out += [*known.of(row), sum(map(len, stream(text, path)))]
            row, held = [], 0
            continue
        row.append(cut(text))
        held += len(text)
        if held > 4 * BLOCK:
            out += known.of(row)
            row, held = [], 0
    return out + known.of(row)


def decode(ids: Iterable[int], path: str = VOCABULARY) -> str:
    d = Decoder(path)
    return d.feed(ids) + d.finish()


def document_ids(documents: DataFrame, path: str = VOCABULARY, rows: int = 512) -> DataFrame:
    """(doc_id, ids): every document encoded without special tokens, whose strings are ordinary text.

    Null and empty texts get []; ``rows`` documents are sent at a time, their ids in one flat array.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                keys, texts = batch.slice(at, rows).columns
                flat, ends = array("i"), [0]
                for text in texts:
                    text = text.as_py()
                    if text:
                        for ids in stream(text, path):
                            flat.extend(ids)
                    ends.append(len(flat))
                lists = pa.ListArray.from_arrays(pa.array(np.asarray(ends, dtype=np.int32)), pa.array(np.frombuffer(flat, dtype=np.int32) if flat else np.empty(0, dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([keys, lists], names=["doc_id", "ids"])

    return spread(documents.select(F.col("doc_id").cast("long"), "text")).mapInArrow(run, "doc_id long, ids array<int>")
