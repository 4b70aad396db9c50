"""Scoring by online logistic context mixing, and by smoothed word counts.

The text that is coded is its words, A-Z lower-cased, each with a gap after it, and one end symbol.  It is coded in binary
decisions:

1. Where the last ``CONTEXT`` words were seen in training, whether the next word is the one that followed them most often.
   Its predictors are the odds of that, learned from the whole corpus for contexts of such counts with one occurrence left
   out, and the odds of the counts themselves; its gate is how the decision before it went.
2. If not, the word's bytes.  A byte is a path in a fixed prefix tree (short for the commonest bytes).  For each decision
   several predictors look up how often it went either way in training, each under the hash of another context (the last 3
   and 5 bytes of the word, and all of it so far), as log-odds; its gate is whether the byte is the word's first.

A gate picks a set of weights; the weighted sum of the log-odds gives a probability.  A last stage moves it by the mean error
made so far at such confidence.  The first weights are fitted on all training words, each with one occurrence left out, in
a few passes of which each adds up the parts' slopes and curvatures; after every stretch of words (the first has ``FIRST_STRETCH``, each next one twice as many, to
``LONGEST_STRETCH``) weights and errors are refined on what was just coded, within the document alone.  So the score of a
document depends on it and on the training rows only.

What is gathered grows with the corpus.  Texts are taken in chunks; a chunk's different words and different pairs of a
context and a word go to parts by hash, with their counts in training rows, in one shuffle of packed rows.  A part counts
its words exactly, finds the word that follows each of its contexts most often, and answers each chunk.  The answers meet
the chunk's texts again in a second shuffle.  The number of parts follows the bytes of text, so none outgrows a task, and
a common word or context is one entry of a chunk however often it occurs.  Only the tables of spelling have a fixed size
and are broadcast; they are added up in two steps, so that no task reads many.

Defined cases: a null text counts as empty (one end symbol).  Without training rows every decision has even odds, and the
base formula has c = N = V = 0.  A text of any length is scored whole; memory is about 100 bytes for each of its words.  Of
words that follow a context equally often, the one of the smallest hash is expected.  Repeated rows are scored one by one.
The report has columns of its own, whatever other columns there are.  An empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Words of a context.
CONTEXT = 2
#: Bytes of context of the predictors of spelling; one more has all of the word so far.
ORDERS = (3, 5)
PREDICTORS = len(ORDERS) + 1
SLOT_BITS = 21
SLOTS = 1 << SLOT_BITS
BLOCK = 1 << 15
END, GAP = 10, 32
#: What is added to both counts of a decision; log-odds are kept as 16-bit multiples of the unit.
PRIOR, ODDS_UNIT = 0.2, 1 / 1024
#: Sets of weights: for the first byte of a word, and for the others; and by how the last expectation went (none, not met, met).
GATES, TRUST_GATES = 2, 3
#: The first weights without any training word; the steps that fit them to all of these at most, and the move below which they end (the
#: next one's is about its square); what sums of a part are rounded to a fraction of.
FIRST_WEIGHT, FIT_STEPS, FIT_MOVE, SUM_UNIT = 0.4, 20, 1e-3, 1 << 16
#: Steps of refining: their rate, and what is added to the curvature for spelling and for expectations.
RATE, CURVE, DAMPING, TRUST_DAMPING = 0.2, 8.0, 100.0, 4.0
#: Levels of confidence of the last stage, what is added to their counts, and how near to certain it gets.
LEVELS, CALM, CERTAIN = 8, 16.0, 2.0**-12
#: Words after which weights are refined: a few at first, then more and more of them, to a limit.
FIRST_STRETCH, LONGEST_STRETCH = 4, 1024
#: Words that are coded side by side, bytes of text of a chunk, and of a part: their tasks take about 50 bytes a byte.
TOGETHER, CHUNK, PART = 1 << 14, 4 << 20, 8 << 20
#: Parts whose tables of spelling one task gathers; more tables than FEW are first added up in groups.
PARTS_A_TABLE, FEW = 16, 32
#: Bytes of words taken at a time for the tables.
WORDS_AT_ONCE = 1 << 17
#: Bytes by how common they are taken to be, the rest by value.
COMMON = b" etaonirshldcumfpgwybvkxjqz\xc3\n.,'\"-0123456789"
#: From which counts on the next class of a context begins: of its commonest word, and of all others together.
TOPS, RESTS = (2, 3, 5), (1, 2, 4)
CLASSES = (len(TOPS) + 1) * (len(RESTS) + 1)
#: Counts that stand for a class.
TOP_OF, REST_OF = (1.0, 2.0, 3.5, 6.0), (0.0, 1.0, 2.5, 6.0)
#: Hashes of the end symbol and of what comes before a text.
END_HASH, START_HASH = np.uint64(0x9D39247E33776D41), np.uint64(0x2AF7398005AAA5C7)


# ---------------------------------------------------------------- the code of a byte


def _code() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte the decisions of its path: where they begin, the nodes, and the branches taken."""
    ranked = list(dict.fromkeys([*COMMON, *range(256)]))
    heap = [(0.87**r + 1e-3, r, b) for r, b in enumerate(ranked)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    for node in range(256, 511):
        (w, i, a), (x, j, b) = heapq.heappop(heap), heapq.heappop(heap)
        parent[a], parent[b] = (node, 0), (node, 1)
        heapq.heappush(heap, (w + x, 256 + node, node))
    paths = []
    for b in range(256):
        path, at = [], b
        while at in parent:
            path.append(parent[at])
            at = parent[at][0]
        paths.append(path[::-1])
    begin = np.concatenate(([0], np.cumsum([len(p) for p in paths])))
    return begin, np.array([n for p in paths for n, _ in p], np.uint64), np.array([t for p in paths for _, t in p], np.uint8)


BEGIN, NODE, TURN = _code()
LENGTH = np.diff(BEGIN)
NODE_VALUE = (C.mix(NODE + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    ends = np.cumsum(size)
    n = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if n + int(start.max(initial=0)) < 1 << 31 else np.int64
    return np.arange(n, dtype=kind) + np.repeat((start - (ends - size)).astype(kind), size)


# ---------------------------------------------------------------- decisions of words


class Decisions(NamedTuple):
    """The decisions of some words, word by word: branch taken, slot by predictor, gate, and ``first[i]:first[i+1]`` of word i."""

    turn: np.ndarray
    slots: list[np.ndarray]
    gate: np.ndarray
    first: np.ndarray


def decisions(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Decisions:
    """Of the words ``data[start[i]:end[i]]``, each with its gap, and of the end symbol as one word more."""
    size = np.append(end - start + 1, 1)
    first = np.concatenate(([0], np.cumsum(size)))
    last = first[1:] - 1
    byte = C.LOWER[np.append(data, np.uint8(GAP))[np.minimum(_spread(np.append(start, 0), size), len(data))]]
    byte[last] = GAP
    byte[-1] = END
    place = np.arange(len(byte)) - np.repeat(first[:-1], size)
    hashed, contexts = np.zeros(len(byte), np.uint64), []
    for j in range(1, max(ORDERS) + 1):
        back = np.zeros(len(byte), np.uint64)
        back[j:] = byte[:-j].astype(np.uint64) + np.uint64(1)
        back[place < j] = 0
        hashed = hashed + back * C.GRAM_VALUE[j]
        if j in ORDERS:
            contexts.append(C.mix(hashed + np.uint64(j)))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(C.BYTE_VALUE[byte] * C.powers(int(size.max()))[place], dtype=np.uint64)))[:-1]
    contexts.append(C.mix(sums - np.repeat(sums[first[:-1]], size)))
    many = LENGTH[byte]
    steps = _spread(BEGIN[:-1][byte], many)
    node, slots = NODE_VALUE[steps], []
    for c in contexts:
        slot = np.repeat((c >> np.uint64(32)).astype(np.uint32), many)
        slot ^= node
        slot *= np.uint32(0x9E3779B1)
        slot >>= np.uint32(32 - SLOT_BITS)
        slots.append(slot.view(np.int32))
    gate = np.repeat(np.minimum(place, GATES - 1).astype(np.int8), many)
    return Decisions(TURN[steps], slots, gate, np.concatenate(([0], np.cumsum(many)))[first])


# ---------------------------------------------------------------- words and contexts of a chunk


class Chunk(NamedTuple):
    """Texts as words, each text's end symbol among them: for each place the index of its word (``len(once)``: the end) and
    of its gram; ``first[i]:first[i+1]`` for text i; the different grams, sorted; the tokens, and where each word is first."""

    word: np.ndarray
    gram: np.ndarray
    first: np.ndarray
    grams: np.ndarray
    tokens: C.Tokens
    once: np.ndarray


def read_chunk(data: np.ndarray, at: np.ndarray) -> Chunk:
    t = C.tokenize(data, at, C.SPACE_CLASS)
    _, once, of = np.unique(t.hash, return_index=True, return_inverse=True)
    first = t.first + np.arange(len(t.first))
    word, h = np.insert(of, t.first[1:], len(once)), np.insert(t.hash, t.first[1:], END_HASH)
    place = np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))
    context = np.zeros(len(h), np.uint64)
    for j in range(1, CONTEXT + 1):
        back = np.full(len(h), START_HASH, np.uint64)
        back[j:] = h[: len(h) - j]
        back[place < j] = START_HASH
        context += back * C.GRAM_VALUE[j]
    grams, gram = np.unique((C.mix(context) & ~np.uint64(0xFFFF)) | (h & np.uint64(0xFFFF)), return_inverse=True)
    return Chunk(word, gram, first, grams, t, once)


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans, A-Z lower-cased, as Arrow strings."""
    size = end - start
    raw = C.LOWER[data[_spread(start, size)]]
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(np.concatenate(([0], np.cumsum(size))).astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes()))


def _word_parts(chunk: Chunk, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of each different word, and of the end symbol, which comes last; and their order by part."""
    h = np.append(chunk.tokens.hash[chunk.once], END_HASH)
    part = _part(h, bits)
    return part, np.argsort(part, kind="stable")


def _part(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def _small(x: np.ndarray) -> np.ndarray:
    """Counts in as many bytes as they need."""
    most = int(x.max(initial=0))
    return x.astype(np.uint8 if most < 1 << 8 else np.uint32 if most < 1 << 32 else np.uint64)


def _check(chunk: Chunk) -> int:
    """A checksum of the words of a chunk."""
    return int((chunk.tokens.hash * C.GRAM_VALUE[0]).sum(dtype=np.uint64) >> np.uint64(1))


def _number(seq: int) -> int:
    return (TaskContext.get().partitionId() << 32) + seq


SENT = ["chunk", "part", "sum", "words", "times", "highs", "lows", "seen"]


def _sent(rows: DataFrame, bits: int) -> DataFrame:
    """For each chunk and part: ``words`` and how often (``times``) they are in training rows; the grams' hashes (32 bits of the
    context beyond the part, 16 of the word) and how often they are (``seen``).  The end symbol is the empty word."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = 0
        for batch in batches:
            learn = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, data, at in C.even_chunks(batch.column(2), CHUNK):
                c = read_chunk(data, at)
                weight = np.repeat(learn[i:j], np.diff(c.first)).astype(np.float64)
                times = np.bincount(c.word, weight, len(c.once) + 1).astype(np.int64)
                seen = np.bincount(c.gram, weight, len(c.grams)).astype(np.int64)
                part, order = _word_parts(c, bits)
                starts, ends = (np.append(x[c.once], 0)[order] for x in (c.tokens.start, c.tokens.end))
                words, grams = (np.searchsorted(x, np.arange((1 << bits) + 1)) for x in (part[order], _part(c.grams, bits)))
                strings = pa.ListArray.from_arrays(pa.array(words, pa.int32()), _strings(data, starts, ends))
                highs, lows = ((c.grams << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32), (c.grams & np.uint64(0xFFFF)).astype(np.uint16)
                full = np.flatnonzero((np.diff(words) > 0) | (np.diff(grams) > 0))
                number, check = _number(seq), _check(c)
                seq += 1
                for low in range(0, len(full), 64):
                    own = full[low : low + 64]
                    raw = [(_small(times[order[words[k] : words[k + 1]]]), *(x[grams[k] : grams[k + 1]] for x in (highs, lows)), _small(seen[grams[k] : grams[k + 1]])) for k in own.tolist()]
                    packed = [pa.array([x.tobytes() for x in column], pa.binary()) for column in zip(*raw, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array([number] * len(own)), pa.array(own, pa.int32()), pa.array([check] * len(own)), strings.take(pa.array(own)), *packed], names=SENT)

    return rows.mapInArrow(C.released(send), "chunk bigint, part int, sum bigint, words array<string>, times binary, highs binary, lows binary, seen binary")


def _counts(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"u{len(raw) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def context_class(top: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return np.searchsorted(TOPS, top, "right") * (len(RESTS) + 1) + np.searchsorted(RESTS, rest, "right")


class Followers(NamedTuple):
    """Of each context, sorted: the gram of the word that follows it most often, and its class; and ``stats``: of all training
    grams with one occurrence left out, by class, how many weren't the expected word and how many were."""

    context: np.ndarray
    expected: np.ndarray
    kind: np.ndarray
    stats: np.ndarray


def followers(grams: np.ndarray, n: np.ndarray) -> Followers:
    """``grams``: contexts above 16 bits of the word; ``n``: how often each is."""
    every, n = grams[n > 0], n[n > 0]
    stats = np.zeros((CLASSES, 2), np.int64)
    if not len(every):
        return Followers(every, every, np.zeros(0, np.int64), stats)
    order = np.argsort(every, kind="stable")  # chunks bring them in order, so this only merges
    every, n = every[order], n[order]
    new = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    every, n = every[new], np.add.reduceat(n, new)
    context, start, size = np.unique(every >> np.uint64(16), return_index=True, return_counts=True)
    total, top = np.add.reduceat(n, start), np.maximum.reduceat(n, start)
    own = np.repeat(np.arange(len(context)), size)
    best = np.flatnonzero(n == top[own])
    best = best[np.unique(own[best], return_index=True)[1]]
    others = n.copy()
    others[best] = 0
    second = np.maximum.reduceat(others, start)
    left = np.maximum(top - 1, second)
    again = total > 1
    np.add.at(stats, (context_class(left, total - 1 - left)[again], (top - 1 >= second).astype(int)[again]), top[again])
    np.add.at(stats, (context_class(top, total - 1 - top)[again], 0), (total - top)[again])
    return Followers(context, every[best], context_class(top, total - top), stats)


def codes(known: Followers, grams: np.ndarray) -> np.ndarray:
    """For each gram 0 if its context was never seen, else 1 + class, and CLASSES more if its word is the expected one."""
    if not len(known.context):
        return np.zeros(len(grams), np.uint8)
    at = np.minimum(np.searchsorted(known.context, grams >> np.uint64(16)), len(known.context) - 1)
    seen = known.context[at] == grams >> np.uint64(16)
    return np.where(seen, 1 + known.kind[at] + CLASSES * (known.expected[at] == grams), 0).astype(np.uint8)


def _answer(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """One part: for each chunk the counts of its words (``times``) and the codes of its grams; and for the part itself (no
    chunk) its training words with their counts, and ``stats``: N, V and the followers'."""
    rows = rows.sort_by("chunk")
    lists = rows["words"].combine_chunks()
    flat = lists.flatten()
    data, at = C.text_buffers(flat)
    h = np.where(np.diff(at) > 0, C.span_hashes(data, at[:-1], at[1:]), END_HASH) if len(flat) else np.zeros(0, np.uint64)
    sizes = pa.compute.list_value_length(lists).to_numpy()
    times = np.concatenate([_counts(x, n) for x, n in zip(rows["times"].to_pylist(), sizes.tolist(), strict=True)])
    _, once, of = np.unique(h, return_index=True, return_inverse=True)
    n = np.bincount(of, times, len(once)).astype(np.int64)
    lows = [np.frombuffer(x, np.uint16).astype(np.uint64) for x in rows["lows"].to_pylist()]
    grams = [(np.frombuffer(x, np.uint32).astype(np.uint64) << np.uint64(16)) | low for x, low in zip(rows["highs"].to_pylist(), lows, strict=True)]
    known = followers(np.concatenate(grams), np.concatenate([_counts(x, len(g)) for x, g in zip(rows["seen"].to_pylist(), grams, strict=True)]))
    cuts = np.cumsum(sizes)[:-1]
    answers = [_small(x).tobytes() for x in np.split(n[of], cuts)]
    learnt = np.flatnonzero(n > 0)
    k = len(rows)
    spelt = learnt[(np.diff(at) > 0)[once[learnt]]] if len(flat) else learnt
    mine = pa.array([0] * (k + 1) + [len(spelt)], pa.int32())
    columns = [
        pa.array([*rows["chunk"].to_pylist(), None], pa.int64()),
        pa.array([int(key[0].as_py())] * (k + 1), pa.int32()),
        pa.array([*rows["sum"].to_pylist(), None], pa.int64()),
        pa.array([*answers, None], pa.binary()),
        pa.array([*(codes(known, g).tobytes() for g in grams), None], pa.binary()),
        pa.ListArray.from_arrays(mine, flat.take(pa.array(once[spelt]))),
        pa.ListArray.from_arrays(mine, pa.array(n[spelt])),
        pa.array([*[None] * k, [int(n.sum()), len(learnt), *known.stats.ravel().tolist()]], pa.list_(pa.int64())),
    ]
    return pa.Table.from_arrays(columns, names=ANSWERED)


ANSWERED = ["chunk", "part", "sum", "times", "codes", "spelt", "n", "stats"]
ANSWERS = "chunk bigint, part int, sum bigint, times binary, codes binary, spelt array<string>, n array<bigint>, stats array<bigint>"


# ---------------------------------------------------------------- tables of spelling


def _tables(counts: DataFrame, groups: int) -> DataFrame:
    """``key, part, sums``: for each task, the blocks of the tables of its words' decisions.  ``counts``: spelt, n, ends."""
    names = ["key", "part", "sums"]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((PREDICTORS, 2 * SLOTS), np.float64)
        for batch in batches:
            n = batch.column(1).flatten().to_numpy()
            for i, j, data, at in C.chunks(batch.column(0).flatten(), WORDS_AT_ONCE):
                d = decisions(data, at[:-1], at[1:])
                weight = np.repeat(np.append(n[i:j], 0), np.diff(d.first)).astype(np.float64)
                for o, slot in enumerate(d.slots):
                    np.add.at(table[o], slot * 2 + d.turn, weight)
            ends = float(pa.compute.sum(batch.column(2)).as_py() or 0)
            d = decisions(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))
            for o, slot in enumerate(d.slots):
                np.add.at(table[o], slot * 2 + d.turn, ends)
        blocks = table.reshape(-1, BLOCK)
        part = TaskContext.get().partitionId() % groups
        for low in range(0, len(blocks), 32):
            full = low + np.flatnonzero(blocks[low : low + 32].any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(np.full(len(full), part, np.int32)), pa.array([_pack(blocks[b]) for b in full.tolist()], pa.binary())], names=names)

    return counts.mapInArrow(C.released(gather), "key bigint, part int, sums binary")


def _pack(block: np.ndarray) -> bytes:
    """The places of a block that aren't 0 and their counts, in 4 bytes each if they fit."""
    where = np.flatnonzero(block)
    kind = np.uint32 if int(block.max()) < 1 << 32 else np.uint64
    return bytes([np.dtype(kind).itemsize]) + where.astype(np.uint16).tobytes() + block[where].astype(kind).tobytes()


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = raw[0]
    n = (len(raw) - 1) // (2 + size)
    return np.frombuffer(raw, np.uint16, n, 1).astype(np.int64), np.frombuffer(raw, np.dtype(f"u{size}"), n, 1 + 2 * n).astype(np.float64)


def _added(*keys: str) -> Callable[..., Iterator[pa.RecordBatch]]:
    """Adds up the blocks of a group, one batch at a time."""

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BLOCK, np.float64)
        for batch in batches:
            for raw in batch.column("sums").to_pylist():
                where, n = _unpack(raw)
                total[where] += n
        own = [pa.array([k.as_py()], pa.int64() if name == "key" else pa.int32()) for k, name in zip(key, keys, strict=True)]
        yield pa.RecordBatch.from_arrays([*own, pa.array([_pack(total)], pa.binary())], names=[*keys, "sums"])

    return add


def _gathered(counts: DataFrame, parts: int) -> np.ndarray:
    """How often each decision went either way: predictor, slot, branch."""
    tasks = -(-parts // PARTS_A_TABLE)
    found = _tables(counts.repartition(tasks), max(1, math.isqrt(tasks)))
    if tasks > FEW:
        found = found.groupBy("key", "part").applyInArrow(_added("key", "part"), "key bigint, part int, sums binary")
    whole = found.groupBy("key").applyInArrow(_added("key"), "key bigint, sums binary")
    table = np.zeros((PREDICTORS * 2 * SLOTS // BLOCK, BLOCK), np.float32)
    for r in C.cut(whole).toLocalIterator():  # at most one row for each block of the fixed-size tables
        where, x = _unpack(bytes(r.sums))
        table[r.key, where] = x
    return table.reshape(PREDICTORS, SLOTS, 2)


SUMS = [(i, j) for i in range(PREDICTORS) for j in range(i + 1)]


def _slopes(counts: DataFrame, tables: Broadcast, weights: np.ndarray) -> DataFrame:
    """For each part and gate: ``gate``; how many decisions its training words have (``total``), the slope of their log-probability by each
    predictor's weight (``s0``...) and its curvature (``c0``..., as ``SUMS``), each word with one of its occurrences left out of the tables.
    They are whole multiples of ``1 / SUM_UNIT``, so that they add up to the same in any order."""
    names = ["total", *(f"s{i}" for i in range(PREDICTORS)), *(f"c{i}" for i in range(len(SUMS)))]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = tables.value
        for batch in batches:
            for row in range(len(batch)):
                words, n = (batch.column(c).slice(row, 1).flatten() for c in (0, 1))
                sums, n = np.zeros((GATES, len(names))), n.to_numpy()
                for i, j, data, at in C.chunks(words, WORDS_AT_ONCE):
                    d = decisions(data, at[:-1], at[1:])
                    inside = slice(0, d.first[-2])
                    turn, times = d.turn[inside], np.repeat(n[i:j].astype(float), np.diff(d.first)[:-1])
                    x = np.stack([np.log(np.maximum(pairs[o, slot[inside], turn] - 1, 0) + PRIOR) - np.log(pairs[o, slot[inside], 1 - turn] + PRIOR) for o, slot in enumerate(d.slots)])
                    for g in range(GATES):
                        own = d.gate[inside] == g
                        xs, t = x[:, own], times[own]
                        missed = 1 / (1 + np.exp(np.clip(weights[:, g] @ xs, -30, 30)))
                        curve = (xs * (t * missed * (1 - missed))) @ xs.T
                        sums[g] += [t.sum(), *(xs @ (t * missed)), *(curve[k] for k in SUMS)]
                exact = [pa.array([Decimal(round(v * SUM_UNIT)) for v in column], pa.decimal128(38)) for column in sums.T.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(range(GATES), pa.int32()), *exact], names=["gate", *names])

    found = counts.select("spelt", "n").mapInArrow(C.released(add), ", ".join(["gate int", *(f"{x} decimal(38,0)" for x in names)]))
    return found.groupBy("gate").agg(*((F.sum(x).cast("double") / SUM_UNIT).alias(x) for x in names))


def _first_weights(counts: DataFrame, tables: Broadcast) -> np.ndarray:
    """Weights by predictor and gate that fit all training words best.  ``counts``: spelt, n, a row for each part."""
    weights = np.full((PREDICTORS, GATES), FIRST_WEIGHT)
    for _ in range(FIT_STEPS):  # Newton's steps, held near where they begin
        before = weights.copy()
        for r in _slopes(counts, tables, before).collect():  # a row for each gate
            total, slope = max(1.0, r.total), np.array(r[2 : 2 + PREDICTORS])
            curve = np.zeros((PREDICTORS, PREDICTORS))
            for (i, j), c in zip(SUMS, r[2 + PREDICTORS :], strict=True):
                curve[i, j] = curve[j, i] = c
            weights[:, r.gate] += np.linalg.solve(curve / total + 1e-3 * np.eye(PREDICTORS), slope / total - 1e-3 * (weights[:, r.gate] - FIRST_WEIGHT))
        if np.abs(weights - before).max() < FIT_MOVE:
            break
    return weights


# ---------------------------------------------------------------- mixing


class Model(NamedTuple):
    """Log-odds of decisions of spelling by predictor and slot; first weights by predictor and gate; log-odds that the expected
    word comes, by class; tokens in all, and different ones."""

    odds: np.ndarray
    first: np.ndarray
    trust: np.ndarray
    n: int
    v: int


def _stretches(n: int) -> list[int]:
    """Where the stretches of a text of n words end."""
    ends, size = [], FIRST_STRETCH
    while n > size:
        ends.append((ends[-1] if ends else 0) + size)
        n, size = n - size, min(2 * size, LONGEST_STRETCH)
    return [*ends, (ends[-1] if ends else 0) + n]


class Mixer:
    """Weights and errors of some documents, side by side."""

    def __init__(self, docs: int, first: np.ndarray, damping: float) -> None:
        self.docs, self.gates, self.damping = docs, first.shape[1], damping
        self.weights = np.tile(first.astype(np.float32), docs)
        self.error, self.count = np.zeros((2, docs * LEVELS))

    def code(self, x: np.ndarray, doc: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Bits of each document for decisions whose log-odds ``x`` (one row a predictor) speak for what came; then refines."""
        at = doc * self.gates + gate
        odds = np.take(self.weights[0], at) * x[0]
        for w, k in zip(self.weights[1:], x[1:], strict=True):
            odds += np.take(w, at) * k
        right, sure = odds > 0, np.abs(odds)
        unlikely = 1 / (1 + np.exp(np.minimum(sure, np.float32(30))))
        level = doc * LEVELS + np.minimum(sure, LEVELS - 1).astype(np.int32)
        moved = np.clip(unlikely - np.take((self.error / (self.count + CALM)).astype(np.float32), level), np.float32(CERTAIN), np.float32(1 - CERTAIN))
        moved += unlikely
        moved *= np.float32(0.5)  # half of the last stage
        moved[sure == 0] = 0.5
        np.subtract(1, moved, out=moved, where=right)
        bits = np.bincount(doc, -np.log2(moved), self.docs)
        missed, size = np.where(right, unlikely, 1 - unlikely), self.docs * self.gates
        curve = CURVE * np.bincount(at, missed * (1 - missed), size) + self.damping
        for w, k in zip(self.weights, x, strict=True):
            w += RATE * np.bincount(at, k * missed, size) / curve
        # an error is 1 or 0, as the likelier branch came or not, less its probability
        self.error += np.bincount(level, right - (1 - unlikely), len(self.error))
        self.count += np.bincount(level, minlength=len(self.count))
        return bits


def _spelling(model: Model, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some words and the end symbol: log-odds of their decisions by predictor (for the branch taken), gates, and where each
    word's begin.  A slice of words is taken at a time."""
    bounds = np.arange(0, len(start) + 1, 1 << 13)
    known, gates, sizes = [], [], []
    for low, high in zip(bounds, [*bounds[1:], len(start)], strict=True):
        d = decisions(data, start[low:high], end[low:high])
        stop = None if high == len(start) else int(d.first[-2])  # the end symbol is in the last slice alone
        sign = np.array([-ODDS_UNIT, ODDS_UNIT], np.float32)[d.turn[:stop]]
        known.append(np.stack([model.odds[o][slot[:stop]] * sign for o, slot in enumerate(d.slots)]))
        gates.append(d.gate[:stop])
        sizes.append(np.diff(d.first)[: None if stop is None else -1])
    return np.concatenate(known, axis=1), np.concatenate(gates), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))


def mixed_bits(model: Model, chunk: Chunk, code: np.ndarray) -> np.ndarray:
    """Bits that each text of a chunk takes.  ``code``: of each place, as ``codes`` gives it."""
    met = code > CLASSES
    spelt = np.zeros(len(chunk.once) + 1, bool)
    spelt[chunk.word[~met]] = True
    spelt[-1] = True
    own = np.flatnonzero(spelt[:-1])
    index = np.cumsum(spelt) - 1
    known, gate, begin = _spelling(model, chunk.tokens.data, chunk.tokens.start[chunk.once[own]], chunk.tokens.end[chunk.once[own]])
    size = np.diff(begin)
    last = np.where(code == 0, 0, 1 + met)  # how expectations went
    before = np.zeros(len(last), np.int64)
    before[1:] = last[:-1]
    before[chunk.first[:-1]] = 0
    counts = np.array([[math.log((t + 0.5) / (r + 0.5)) for r in REST_OF] for t in TOP_OF]).ravel()
    trust = np.stack([model.trust, counts, np.ones(CLASSES)]).astype(np.float32)
    trusted = np.tile(np.array([[1.0], [0.0], [0.0]]), TRUST_GATES)  # at first, what the corpus says
    n = np.diff(chunk.first)
    out, load = np.zeros(len(n)), np.cumsum(np.minimum(n, LONGEST_STRETCH))
    i = 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(load, (load[i - 1] if i else 0) + TOGETHER, "right")))
        spelling, trusting = Mixer(j - i, model.first, DAMPING), Mixer(j - i, trusted, TRUST_DAMPING)
        ends = [_stretches(int(x)) for x in n[i:j]]
        for step in range(max(map(len, ends))):
            docs = np.array([k for k, e in enumerate(ends) if step < len(e)])
            low = np.array([ends[k][step - 1] if step else 0 for k in docs])
            many = np.array([ends[k][step] for k in docs]) - low
            at, doc = _spread(chunk.first[i + docs] + low, many), np.repeat(docs, many)
            seen = code[at] > 0
            if seen.any():
                kind, hit = (code[at[seen]].astype(np.int64) - 1) % CLASSES, met[at[seen]]
                out[i:j] += trusting.code(np.where(hit, np.float32(1), np.float32(-1)) * trust[:, kind], doc[seen], before[at[seen]])
            by_bytes = ~met[at]
            words, doc = index[chunk.word[at[by_bytes]]], doc[by_bytes]
            if len(words):
                where = _spread(begin[words], size[words])
                x = np.stack([np.take(k, where) for k in known])
                out[i:j] += spelling.code(x, np.repeat(doc.astype(np.int32), size[words]), np.take(gate, where))
        i = j
    return out


def _base_terms(c: np.ndarray, n: int, v: int) -> np.ndarray:
    return np.log10((c + 0.5) / (n + 0.5 * (v + 1)))


def _packed(rows: DataFrame) -> DataFrame:
    """``chunk, data``: each chunk's ids and texts, compressed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = 0
        for batch in batches:
            for i, j, _, _ in C.even_chunks(batch.column(2), CHUNK):
                sink = pa.BufferOutputStream()
                own = batch.select([0, 2]).slice(i, j - i)
                with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_batch(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in own.columns], names=own.schema.names))
                yield pa.RecordBatch.from_arrays([pa.array([_number(seq)]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "data"])
                seq += 1

    return rows.mapInArrow(C.released(pack), "chunk bigint, data binary")


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART) -> DataFrame:
    """One row for each document row, learning from those for which ``training`` holds: its id, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (log10 by word counts), ``bits`` (by context mixing), ``n_bytes`` coded, ``bits_per_byte``
    and ``score`` (log10 of the probability of the text).

    ``docs`` are read twice and must come in the same order both times, as a table in storage does; that is checked.
    """
    spark = docs.sparkSession
    C.importable(spark)
    text = C.own(docs, text_col)
    rows = docs.select(C.own(docs, id_col).alias("id"), F.coalesce(training, F.lit(False)).alias("learn"), text.alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    bits = max(0, (-(-size // part_bytes) - 1)).bit_length()
    answers = C.cut(_sent(rows, bits).groupBy("part").applyInArrow(_answer, ANSWERS))
    model = spark.sparkContext.broadcast(_learned(answers, 1 << bits))
    names = ["id", "n_tokens", "n_known", "base_score", "bits", "n_bytes"]

    def judge(key: tuple[pa.Scalar, ...], texts: pa.Table, found: pa.Table) -> pa.Table:
        known = model.value
        batch = pa.ipc.open_stream(texts["data"][0].as_buffer()).read_all().combine_chunks()
        data, at = C.text_buffers(batch.column(1))
        chunk = read_chunk(data, at)
        found = found.sort_by("part")
        part, order = _word_parts(chunk, bits)
        c = np.zeros(len(order), np.int64)
        words, grams = np.bincount(part, minlength=1 << bits), np.bincount(_part(chunk.grams, bits), minlength=1 << bits)
        own = found["part"].to_pylist()
        code = b"".join(found["codes"].to_pylist())
        if set(found["sum"].to_pylist()) != {_check(chunk)} or len(code) != len(chunk.grams) or [len(x) for x in found["codes"].to_pylist()] != grams[own].tolist():
            raise RuntimeError("the documents came in another order when they were read again: write them to a table first")
        c[order] = np.concatenate([_counts(x, int(words[k])) for k, x in zip(own, found["times"].to_pylist(), strict=True)])
        doc = np.repeat(np.arange(len(batch)), np.diff(chunk.first))
        n_known = np.bincount(doc, (c > 0)[chunk.word], len(batch)).astype(np.int64)
        base = np.bincount(doc, _base_terms(c, known.n, known.v)[chunk.word], len(batch))
        spent = mixed_bits(known, chunk, np.frombuffer(code, np.uint8)[chunk.gram])
        coded = np.bincount(chunk.tokens.doc, chunk.tokens.end - chunk.tokens.start + 1, len(batch)) + 1
        ids = batch.column(0)
        out = [ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids, *(pa.array(x) for x in (np.diff(chunk.first), n_known, base, spent, coded.astype(np.int64)))]
        C.give_back()
        return pa.Table.from_arrays(out, names=names)

    left, right = _packed(rows), answers.filter("chunk IS NOT NULL").select("chunk", "part", "sum", "times", "codes")
    schema = C.schema(rows, "id", n_tokens="bigint", n_known="bigint", base_score="double", bits="double", n_bytes="bigint")
    judged = left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(judge, schema)
    per_byte, log10 = F.col("bits") / F.col("n_bytes"), -F.col("bits") * F.lit(math.log10(2))
    return judged.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(model.value.n).cast("bigint").alias("train_tokens"), "base_score", "bits", "n_bytes", per_byte.alias("bits_per_byte"), log10.alias("score"))


def _learned(answers: DataFrame, parts: int) -> Model:
    own = answers.filter("chunk IS NULL")
    total = own.select(*(F.coalesce(F.sum(F.get("stats", F.lit(i))), F.lit(0)).alias(f"s{i}") for i in range(2 + 2 * CLASSES))).first()
    stats = np.array(total[2:], float).reshape(CLASSES, 2)
    trust = np.log(stats[:, 1] + PRIOR) - np.log(stats[:, 0] + PRIOR)
    ends = F.get("stats", F.lit(0)) - F.aggregate("n", F.lit(0).cast("bigint"), lambda a, x: a + x)
    counts = C.cut(own.select("spelt", "n", ends.alias("ends")))
    pairs = _gathered(counts, parts)
    tables = answers.sparkSession.sparkContext.broadcast(pairs)
    first = _first_weights(counts, tables)
    tables.destroy()
    odds = np.rint((np.log(pairs[:, :, 1] + PRIOR) - np.log(pairs[:, :, 0] + PRIOR)) / ODDS_UNIT).astype(np.int16)
    return Model(odds, first, trust, int(total[0]), int(total[1]))


def _remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(C.table(spark, sf_dir, "documents"), _remainder() != 1)
    return found.select("doc_id", F.coalesce(_remainder() == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


QUERIES = {"op8_lm_score": op8_lm_score}
ORACLE_SQL: dict[str, str] = {}
