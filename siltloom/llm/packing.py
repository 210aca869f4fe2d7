"""Containers of fixed capacity filled by lexical retrieval.

Texts are sized in tokens; one larger than a container is cut into full containers and a rest, nothing else is ever
cut.  The items are dealt to shards of about SHARD items by a hash of their key, and each shard is an inverted index
of its own.  In a shard the largest unused item is the seed of a container: the BM25 scores of its terms rank the unused
items, which fill the window greedily in that order as long as the room behind them stays wide or can be closed
exactly.  The room left is closed by one item or two of exactly its size where there are such, else by the largest
items that still fit.  Items of containers that stay more than LOOSE empty are dealt again, to fewer shards, and packed once more.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltloom.common import durable, spread
from siltloom.llm import tokens

CAPACITY, SHARD, LOOSE, WIDE = 2048, 4000, 0.005, 256
#: Bits of a packed term that hold its frequency.
TF_BITS = 31
K1, B = 1.2, 0.75
_TERM = re.compile(r"[a-z0-9_]{3,}|[぀-ヿ㐀-鿿가-힣]{2}|[^\W\d_a-z]{3,}")


class Numbers(dict):
    """The numbers of terms, remembered."""

    def __missing__(self, term: str) -> int:
        if len(self) >= tokens.KNOWN:
            self.clear()
        number = self[term] = zlib.crc32(term.encode("utf-8", "replace"))
        return number


_NUMBERS = Numbers()


def _terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all texts, one text's behind the other's, and where each text's end."""
    number, met = _NUMBERS.__getitem__, []
    for row, text in enumerate(texts):
        found = _TERM.findall(text.lower())
        met.append(np.fromiter(map(number, found), dtype=np.int64, count=len(found)) | row << 32)
    flat, often = np.unique(np.concatenate(met) if met else np.empty(0, dtype=np.int64), return_counts=True)
    return (flat & (1 << 32) - 1) << TF_BITS | often, np.searchsorted(flat, np.arange(1, len(texts) + 1) << 32)


def terms(text: str) -> list[int]:
    """The distinct terms of a text, words and pairs of signs in unspaced scripts: term number << TF_BITS | frequency."""
    return _terms([text])[0].tolist()


def items(documents: DataFrame, capacity: int = CAPACITY, path: str = tokens.VOCABULARY, rows: int = 512) -> DataFrame:
    """(doc_id, part, start, tokens, terms): full containers' parts and rests of larger texts, every other text whole.

    A null or empty text is one item of 0 tokens.  The texts are counted, not encoded; ``rows`` are read at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                keys, texts = batch.slice(at, rows).columns
                texts = texts.to_pylist()
                full, rest = np.divmod(np.asarray(tokens.sizes(texts, path), dtype=np.int64), capacity)
                parts = full + ((rest > 0) | (full == 0))
                last = np.cumsum(parts) - 1
                of = np.repeat(np.arange(len(texts)), parts)
                part = np.arange(len(of)) - (last - parts + 1)[of]
                held = part == full[of]
                ends = np.zeros(len(of) + 1, dtype=np.int32)
                told = np.flatnonzero(rest)
                flat, until = _terms([texts[i] for i in told])
                ends[last[told] + 1] = np.diff(until, prepend=0)
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), pa.array(flat))
                columns = [keys.take(pa.array(of)), part.astype(np.int32), (part * capacity).astype(np.int32), np.where(held, rest[of], capacity).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), lists], names=["doc_id", "part", "start", "tokens", "terms"])

    return spread(documents.select(F.col("doc_id").cast("long"), "text")).mapInArrow(run, "doc_id long, part int, start int, tokens int, terms array<long>")


def pack(sizes: np.ndarray, of: list[np.ndarray], capacity: int = CAPACITY, tf: list[np.ndarray] | None = None) -> list[list[int]]:
    """Containers as lists of item numbers, for items of 1 to ``capacity`` tokens with their terms and, where given, their frequencies."""
    n = len(sizes)
    if n == 0:
        return []
    flat = np.concatenate(of)
    often = np.concatenate(tf).astype(np.float64) if tf is not None else np.ones(len(flat))
    owner = np.repeat(np.arange(n), [len(t) for t in of])
    lengths = np.bincount(owner, weights=often, minlength=n)
    order = np.argsort(flat, kind="stable")
    flat, owner, often = flat[order], owner[order], often[order]
    words, begin = np.unique(flat, return_index=True)
    end = np.append(begin[1:], len(flat))
    word = np.empty(len(flat), dtype=np.int64)  # the number of each item's terms among the words, item by item
    word[order] = np.repeat(np.arange(len(words)), end - begin)
    ends = np.cumsum([len(t) for t in of])
    idf = np.log(1 + (n - (end - begin) + 0.5) / (end - begin + 0.5))
    norm = K1 * (1 - B + B * lengths / max(1.0, lengths.mean()))
    weight = np.repeat(idf, end - begin) * often * (K1 + 1) / (often + norm[owner])
    # the postings of terms that more than a quarter of the items hold are added up as whole rows
    wide = np.flatnonzero(end - begin > max(2, n // 4))
    row_of = np.full(len(words), -1)
    row_of[wide] = np.arange(len(wide))
    rows = np.zeros((len(wide), n))
    for at, k in enumerate(wide):
        rows[at, owner[begin[k] : end[k]]] = weight[begin[k] : end[k]]
    # the seeds become smaller, so the room behind them grows: the postings that are read hold the unused items up to a
    # size a little above the room, and are drawn from all postings again when the room is wider or half of them are used
    live, bound = np.arange(0), -1
    near_begin, near_end, near_weight, near_owner, near_rows = begin, end, weight[:0], owner[:0], rows[:, :0]
    used = np.zeros(n, dtype=bool)
    by_size: dict[int, list[int]] = {}
    for i in range(n - 1, -1, -1):
        by_size.setdefault(int(sizes[i]), []).append(i)
    present = sorted(by_size)

    left = np.bincount(sizes, minlength=capacity + 1)  # unused items by size
    there = left > 0

    def count(size: int, more: int) -> None:
        left[size] += more
        there[size] = left[size] > 0

    def take(i: int) -> None:
        used[i] = True
        count(sizes[i], -1)

    def unused(size: int) -> int:
        stack = by_size[size]
        while used[stack[-1]]:
            stack.pop()
        return stack[-1]

    def closing(room: int) -> list[int]:
        """Sizes of one or two unused items that fill the room exactly, the larger first; [] where there are none."""
        if left[room]:
            return [room]
        half = room // 2
        if room > 2:
            both = there[room - 1 : half : -1] & there[1 : room - half]
            b = int(both.argmax()) + 1
            if both[b - 1]:
                return [room - b, b]
        return [half, half] if room % 2 == 0 and left[half] >= 2 else []

    def largest(room: int) -> int:
        at = bisect_right(present, room) - 1
        while at >= 0:
            stack = by_size[present[at]]
            while stack and used[stack[-1]]:
                stack.pop()
            if stack:
                return stack[-1]
            del by_size[present[at]]
            present.pop(at)
            at -= 1
        return -1

    out = []
    least = int(sizes.min())
    while True:
        seed = largest(capacity)
        if seed < 0:
            return out
        take(seed)
        box, room = [seed], capacity - int(sizes[seed])
        if room >= least and len(of[seed]):
            if room > bound or used[live].sum() > max(len(live) // 2, n // 16):
                free = np.sort(sizes[~used])
                fit = int(np.searchsorted(free, room, side="right"))
                more = fit + max(fit // 2, n // 8)
                bound = int(free[more]) if more < len(free) else capacity
                stay = ~used & (sizes <= bound)
                live, held = np.flatnonzero(stay), stay[owner]
                before, kept = np.append(0, np.cumsum(held)), np.flatnonzero(held)
                near_begin, near_end, near_weight, near_owner, near_rows = before[begin], before[end], weight[kept], (np.cumsum(stay) - 1)[owner[kept]], rows[:, live]
            at = word[ends[seed] - len(of[seed]) : ends[seed]]
            at = at[near_end[at] > near_begin[at]]
            if len(at):
                score = near_rows[row_of[at[row_of[at] >= 0]]].sum(axis=0)
                at = at[row_of[at] < 0]
                if len(at):
                    held = near_end[at] - near_begin[at]
                    hits = np.repeat(near_begin[at] - np.append(0, np.cumsum(held)[:-1]), held) + np.arange(held.sum())
                    score += np.bincount(near_owner[hits], weights=near_weight[hits], minlength=len(live))
                score[used[live] | (sizes[live] > room)] = 0
                near = np.flatnonzero(score)
                near = live[near[np.argsort(-score[near], kind="stable")]]
                while len(near) and room >= least:
                    near = near[sizes[near] <= room]
                    behind = room - sizes[near]
                    sure = np.flatnonzero((behind == 0) | (behind >= WIDE))
                    first = int(sure[0]) if len(sure) else len(near)
                    # items of a size leave the same gap, so only the first of each size is tried
                    at = np.full(WIDE, first)
                    at[behind[:first][::-1]] = np.arange(first - 1, -1, -1)
                    for j in np.sort(at[at < first]).tolist():
                        size = sizes[near[j]]
                        count(size, -1)
                        fits = closing(int(behind[j]))
                        count(size, 1)
                        if fits:
                            first = j
                            break
                    if first == len(near):
                        break
                    i = int(near[first])
                    box.append(i)
                    take(i)
                    room -= int(sizes[i])
                    near = near[first + 1 :]
        if room >= least:
            for size in closing(room):
                i = unused(size)
                take(i)
                box.append(i)
                room -= size
        while room >= least:
            i = largest(room)
            if i < 0:
                break
            take(i)
            box.append(i)
            room -= int(sizes[i])
        out.append(box)


def _packed(dealt: DataFrame, capacity: int, level: int) -> DataFrame:
    """dealt has shard, doc_id, part, start, tokens, terms; gives the same rows with container_id and fill.

    Terms stay only with the items of loose containers, which may be dealt again.
    """

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "part"], ignore_index=True)
        packed = [np.asarray(t, dtype=np.int64) for t in frame["terms"]]
        boxes = pack(frame["tokens"].to_numpy(), [t >> TF_BITS for t in packed], capacity, [t & (1 << TF_BITS) - 1 for t in packed])
        box_of, fill = np.zeros(len(frame), dtype=np.int64), np.zeros(len(frame), dtype=np.int32)
        for k, box in enumerate(boxes):
            box_of[box] = k
            fill[box] = frame["tokens"].to_numpy()[box].sum()
        frame["container_id"] = [f"{level}-{s}-{k}" for s, k in zip(frame["shard"], box_of)]
        frame["fill"] = fill
        frame["terms"] = frame["terms"].where(fill < capacity * (1 - LOOSE), None)
        return frame[["doc_id", "part", "start", "tokens", "terms", "container_id", "fill"]]

    return dealt.groupBy("shard").applyInPandas(one, "doc_id long, part int, start int, tokens int, terms array<long>, container_id string, fill int")


def containers(documents: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """(container_id, doc_id, part, start, tokens): where every part of every text lies.

    Texts of 0 tokens have a null container.  A shard's number of items does not grow with the table.
    """
    every = durable(items(documents, capacity))
    out = ["container_id", "doc_id", "part", "start", "tokens"]
    nothing = every.where("tokens = 0").withColumn("container_id", F.lit(None).cast("string")).select(*out)
    full = every.where(F.col("tokens") == capacity).withColumn("container_id", F.concat(F.lit("full-"), "doc_id", F.lit("-"), "part")).select(*out)
    loose = every.where((F.col("tokens") > 0) & (F.col("tokens") < capacity))
    count = loose.count()

    def deal(df: DataFrame, n: int) -> DataFrame:
        return df.withColumn("shard", F.pmod(F.xxhash64("doc_id", "part"), F.lit(max(1, -(-n // shard)))).cast("int"))

    first = durable(_packed(deal(loose, count), capacity, 1))
    good = F.col("fill") >= capacity * (1 - LOOSE)
    rest = first.where(~good).drop("container_id", "fill")
    second = _packed(deal(rest, rest.count()), capacity, 2)
    return nothing.unionByName(full).unionByName(first.where(good).select(*out)).unionByName(second.select(*out))


def waste(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(containers, tokens, least, unused): the number of containers, the least possible by size alone, the share unused."""
    boxes = placed.where("container_id is not null").groupBy("container_id").agg(F.sum("tokens").alias("fill"))
    total = boxes.agg(F.count("*").alias("containers"), F.sum("fill").alias("tokens"))
    return total.withColumn("least", F.ceil(F.col("tokens") / capacity)).withColumn("unused", F.round(1 - F.col("tokens") / (F.col("containers") * capacity), 6))
