"""Language identification by interpolated Kneser-Ney character models, one for each language.

Symbols are letters, lower-cased, with one space for each run of anything else.  A language's model is a set of sorted
arrays of 64-bit hashes, for each order those of its n-grams with their discounted probability and those of its contexts
with their weight for the next lower order; the highest order counts occurrences, the lower ones the different symbols
that come before (Kneser-Ney).  A text gets the language of the lowest cross-entropy by symbol.  It is rejected if that
is above what texts of the language reach that were kept out of its model, with room to spare.

Training takes a bounded sample: about ``SAMPLE`` different texts of each language, of at most ``LONGEST`` bytes each and
about ``SAMPLE_BYTES`` together, picked by a hash of the text among all labelled rows.  A language whose texts are all longer is fitted on as many pieces of
them, picked in the same way among all pieces.  Each language is fitted in a task of its own, so the models that
are broadcast are bounded by the sample and the number of languages.  Scoring goes once over all whole texts without a
shuffle; within ``CHUNK`` symbols each different n-gram is looked up once, and memory beside the text follows that.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected; so is every text if there are
no labelled rows.  A text of any length is judged whole, ``CHUNK`` symbols at a time.  Of languages that are equally near,
the first by name wins.  Repeated rows are judged one by one.  The report has columns of its own, whatever other columns
``docs`` has.  An empty table gives an empty report.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

ORDER = 4
SAMPLE, SAMPLE_BYTES = 400, 2_000_000
LONGEST = 200_000
#: Symbols taken at a time: each takes about 150 bytes of memory.
CHUNK = 1 << 18
#: Languages up to which the table of their counts is broadcast: one short row each.
BROADCAST_LANGUAGES = 10_000
#: Probability of a symbol that no training text has, spread over this many.
ALPHABET = 1 << 14
#: Every fifth sampled text calibrates; a text may be this much above the quantile.
CALIBRATION, QUANTILE, ROOM = 5, 0.995, 1.5
#: Bits that a text may be further above, by the root of its number of symbols: short texts vary more.
SHORT = 4.0
#: Symbols that count as independent evidence in the score.
EVIDENCE = 40
UNKNOWN = "und"
SPACE = 32

VALUE = C.GRAM_VALUE[:ORDER]


class Model(NamedTuple):
    lang: str
    limit: float
    grams: list[np.ndarray]
    direct: list[np.ndarray]
    contexts: list[np.ndarray]
    lower: list[np.ndarray]


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, and its lower case (itself if that is not one code point)."""
    points = range(0x110000)
    letter = np.array([chr(i).isalpha() for i in points])
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero(letter).tolist():
        if len(x := chr(i).lower()) == 1:
            lower[i] = ord(x)
    return letter, lower


def _code_points(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = data.tobytes()
    try:
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        return points, heads[at]
    except UnicodeError:  # not UTF-8: what can't be read is no letter
        each = [raw[a:z].decode("utf-8", "replace") for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        points = np.frombuffer("".join(each).encode("utf-32-le", "replace"), np.uint32)
        return points, np.concatenate(([0], np.cumsum([len(x) for x in each])))


def symbols(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of each text and their bounds: ``first[i]:first[i+1]`` for text i."""
    letter, lower = _letters()
    points, bounds = _code_points(data, at)
    is_letter = letter[points]
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]
    heads = bounds[:-1][bounds[:-1] < len(points)]
    kept[heads] = is_letter[heads]
    points = points[kept]
    return np.where(is_letter[kept], lower[points], np.uint32(SPACE)), np.concatenate(([0], np.cumsum(kept)))[bounds]


def hashes(s: np.ndarray, first: np.ndarray, a: int = 0, z: int | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For orders 1 to ORDER, the hash of the n-gram that ends at each symbol from a to z and of its context; spaces precede a
    text."""
    bounds = np.clip(first, a, len(s) if z is None else z)
    size = int(bounds[-1]) - a
    place = np.arange(a, a + size) - np.repeat(first[:-1], np.diff(bounds))
    context, gram, contexts = np.zeros(size, np.uint64), [], []
    own = (s[a : a + size].astype(np.uint64) + np.uint64(1)) * VALUE[0]
    for n in range(1, ORDER + 1):
        if n > 1:
            back = np.full(size, SPACE, np.uint64)
            seen = np.flatnonzero(place >= n - 1)
            back[seen] = s[seen + (a - (n - 1))]
            context = context + (back + np.uint64(1)) * VALUE[n - 1]
        contexts.append(context)
        gram.append(C.mix(context + own))
    return gram, contexts


def fit(s: np.ndarray, first: np.ndarray) -> tuple[list[np.ndarray], ...]:
    """Grams, direct probabilities, contexts and their weights for the lower order, by order."""
    gram, context = hashes(s, first)
    out: tuple[list[np.ndarray], ...] = ([], [], [], [])
    at = np.arange(len(s))
    for n in range(ORDER, 0, -1):
        keys, where, counts = np.unique(gram[n - 1][at], return_index=True, return_counts=True)
        at = at[where]  # each n-gram once: below, it counts as one way to go on
        ones, twos = (counts == 1).sum(), (counts == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        held, of, kinds = np.unique(context[n - 1][at], return_inverse=True, return_counts=True)
        total = np.bincount(of, counts, len(held))
        for k, x in enumerate((keys, ((counts - discount) / total[of]).astype(np.float32), held, (discount * kinds / total).astype(np.float32))):
            out[k].insert(0, x)
    return out


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing, np.float32)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], np.float32(missing))


def cross_entropies(models: list[Model], data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits a symbol of each text by each model, and the number of symbols; 0 symbols give 0 bits."""
    s, first = symbols(data, at)
    n, out = np.diff(first), np.zeros((len(at) - 1, len(models)))
    for a in range(0, len(s), CHUNK):
        bounds = np.clip(first, a, min(len(s), a + CHUNK)) - a
        gram, context = hashes(s, first, a, a + CHUNK)
        _, once, back = np.unique(gram[-1], return_index=True, return_inverse=True)
        gram, context = [g[once] for g in gram], [c[once] for c in context]
        here = np.flatnonzero(np.diff(bounds))
        for k, m in enumerate(models):
            p = np.full(len(once), 1 / ALPHABET)
            for o in range(ORDER):
                p = _found(m.grams[o], m.direct[o], gram[o], 0) + _found(m.contexts[o], m.lower[o], context[o], 1) * p
            out[here, k] += np.add.reduceat(-np.log2(p)[back], bounds[here])
    return out / np.maximum(n, 1)[:, None], n


def _drawn(rows: DataFrame, counts: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` different texts of each language; ``counts`` has how many there are."""
    counts = C.bounded_broadcast(counts, counts.count(), BROADCAST_LANGUAGES)
    drawn = F.shiftrightunsigned("key", 11).cast("double") * F.lit(2.0**-53) * F.col("texts") < sample
    found = rows.join(counts, "lang").filter(drawn).dropDuplicates(["lang", "key"])
    before = F.sum(F.octet_length("text")).over(Window.partitionBy("lang").orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
    return found.select("lang", "key", "text", F.coalesce(before, F.lit(0)).alias("before")).filter(F.col("before") < SAMPLE_BYTES).drop("before")


def _pieces(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts ``lang, text`` into pieces of ``size`` characters (at most four times as many bytes)."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                whole = text.as_buffer().to_pybytes().decode("utf-8", "replace")
                texts = [whole[i : i + size] for i in range(0, len(whole), size)]
                yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(texts), pa.string()), pa.array(texts, pa.string())], names=["lang", "text"])

    return cut_up


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, longest: int = LONGEST) -> list[Model]:
    """Models of the languages in ``labelled`` (null texts and languages don't count), by name."""
    every = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    short = F.octet_length("text") <= longest
    keyed = every.select("lang", F.when(short, F.xxhash64("text")).alias("key"))  # a null key: longer texts
    counts = C.cut(keyed.groupBy("lang", "key").count().groupBy("lang").agg(F.count("key").alias("texts")))
    picked = _drawn(every.filter(short).withColumn("key", F.xxhash64("text")), counts.filter("texts > 0"), sample)
    lone = counts.filter("texts = 0").select("lang")
    if n := lone.count():
        long = every.filter(~short).join(C.bounded_broadcast(lone, n, BROADCAST_LANGUAGES), "lang", "left_semi")
        pieces = long.mapInArrow(_pieces(max(1, longest // 4)), "lang string, text string").withColumn("key", F.xxhash64("text"))
        counts = C.cut(pieces.groupBy("lang", "key").count().groupBy("lang").agg(F.count("*").alias("texts")))
        picked = picked.unionAll(_drawn(pieces, counts, sample))

    def fitted(key: tuple[pa.Scalar, ...], texts: pa.Table) -> pa.Table:
        order = np.argsort(texts["key"].to_numpy(), kind="stable")
        texts = texts.take(pa.array(order))["text"]
        data, at = C.text_buffers(texts)
        s, first = symbols(data, at)
        kept_out = np.arange(len(texts)) % CALIBRATION == CALIBRATION - 1
        inside = np.repeat(~kept_out, np.diff(first))
        arrays = fit(s[inside], np.concatenate(([0], np.cumsum(np.diff(first)[~kept_out]))))
        limit = float("inf")
        if kept_out.any():
            bits, n = cross_entropies([Model("", 0.0, *arrays)], data, at)
            if len(own := bits[kept_out & (n > 0), 0]):
                limit = float(np.quantile(own, QUANTILE)) * ROOM
        lists = [pa.array([[x.tobytes() for x in a]], pa.list_(pa.binary())) for a in arrays]
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.string()), pa.array([limit]), *lists], names=["lang", "limit", "grams", "direct", "contexts", "lower"])

    found = picked.groupBy("lang").applyInArrow(fitted, "lang string, limit double, grams array<binary>, direct array<binary>, contexts array<binary>, lower array<binary>").collect()
    kinds = {"grams": np.uint64, "direct": np.float32, "contexts": np.uint64, "lower": np.float32}
    return [Model(r.lang, r.limit, *([np.frombuffer(x, kind) for x in r[name]] for name, kind in kinds.items())) for r in sorted(found, key=lambda r: r.lang)]


def identify(docs: DataFrame, models: list[Model] | Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document row: its id, ``text_key`` (a hash of its text), ``lang_pred``, ``score`` (of the language
    against the others, 0 to 1), ``bits`` (a symbol) and ``rejected``."""
    sent = models if isinstance(models, Broadcast) else docs.sparkSession.sparkContext.broadcast(models)
    names = ["id", "text_key", "lang_pred", "score", "bits", "rejected"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        langs, limits = np.array([*(m.lang for m in known), UNKNOWN], object), np.array([*(m.limit for m in known), -1.0])
        for batch in batches:
            for i, j, data, at in C.chunks(batch.column(2), CHUNK):
                best, score, least, room = np.full(j - i, len(known)), *np.zeros((3, j - i))
                if known:
                    bits, n = cross_entropies(known, data, at)
                    full = n > 0
                    least[full] = bits[full].min(axis=1)
                    best[full] = bits[full].argmin(axis=1)
                    weight = np.exp2((least[:, None] - bits) * np.minimum(n, EVIDENCE)[:, None])
                    room[full] = SHORT / np.sqrt(n[full])
                    score[full] = 1 / weight[full].sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], pa.array(langs[best], pa.string()), pa.array(score), pa.array(least), pa.array(least > limits[best] + room)], names=names)

    id_, text = C.own(docs, id_col), C.own(docs, text_col)
    rows = docs.select(id_.alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(C.released(judge), C.schema(rows, "id", "text_key", lang_pred="string", score="double", bits="double", rejected="boolean")).withColumnRenamed("id", id_col)


def _remainder(id_col: str, by: int) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % by


def learned_from(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows that models learn from: those with an id whose remainder isn't 1."""
    return docs.filter(_remainder(id_col, 3) != 1)


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with all their columns, without the rows that are rejected by models learned from their own labelled rows."""
    models = docs.sparkSession.sparkContext.broadcast(train(learned_from(docs, id_col), text_col, lang_col))
    bad = identify(docs, models, id_col, text_col).filter("rejected").select(F.col(id_col).alias("id"), "text_key").distinct()
    out = C.matched(docs, bad, id_col, text_col, "left_anti")
    models.unpersist()  # all is judged
    return out


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    found = identify(docs, train(learned_from(docs)))
    return found.select("doc_id", F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {"op5_language_id": op5_language_id}
ORACLE_SQL: dict[str, str] = {}
