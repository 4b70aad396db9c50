"""What the operators of this subpackage share: session helpers, and tokenising and hashing of Arrow text in numpy.

Texts are handled as the UTF-8 bytes Arrow holds, without a Python object for a text or a word.  Memory follows
``CHUNK_BYTES`` and ``BATCH_BYTES``, not the number of rows or the partition; only a single text longer than that takes
more (about 12 bytes a byte).
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

CHUNK_BYTES = 1 << 20
#: Bytes of a batch of rows that goes to Python, unless the session sets a limit: Spark's own counts rows alone.
BATCH_BYTES = 8 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Short rows (two keys and a count) up to which a table of decisions is broadcast.
BROADCAST_ROWS = 500_000
ROWS_A_PARTITION = 100_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of ASCII digits, letters and anything beyond ASCII; and words of anything but white space.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_CLASS = r"[^\x20\x09-\x0D]+"
#: DuckDB's lower-cased words of a text, by class.
SQL_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD_CLASS}')"
SQL_SPACED = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{SPACE_CLASS}')"


# ---------------------------------------------------------------- session


def importable(spark: SparkSession) -> None:
    """In local mode, lets Python workers find this package wherever the driver was started.  (On a cluster it is deployed with
    the job, as any package.)  Where the session has no limit of bytes for batches, it gets ``BATCH_BYTES``."""
    context, root = spark.sparkContext, str(Path(__file__).resolve().parents[2])
    paths = context.environment.get("PYTHONPATH", "")
    if context.master.startswith("local") and root not in paths.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: what the session names, else (tests, local mode) a new local one."""
    importable(spark)
    sc = spark.sparkContext
    found = sc._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quarry-checkpoint-")
    sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for what is written and read again; it is deleted when the driver ends."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    return f"{hadoop.toString()}/{name}"


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` computed once and kept in the shared folder; its lineage ends there, and Spark's cleaner removes it.  Where it is
    known that the work is on so many rows at most, they go to no more partitions (and files) than these need."""
    shared_dir(df.sparkSession)
    return (df if rows is None else df.coalesce(max(1, -(-rows // ROWS_A_PARTITION)))).checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z alone (``lower`` would change other letters)."""
    return F.translate(c, UPPER, UPPER.lower())


def bounded_broadcast(df: DataFrame, rows: int, most: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are at most ``most``; else as it is, for a shuffled join."""
    return F.broadcast(df) if rows <= most else df


def own(df: DataFrame, name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


def schema(rows: DataFrame, *kept: str, **more: str) -> StructType:
    """The columns ``kept`` of ``rows``, and ``more`` with their types."""
    return struct({c: rows.schema[c].dataType for c in kept} | more)


def struct(fields: dict[str, str | DataType]) -> StructType:
    return StructType([StructField(c, DataType.fromDDL(t) if isinstance(t, str) else t) for c, t in fields.items()])


def released(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``f`` for ``mapInArrow``; after its last batch the worker, which Spark uses again, gives memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        give_back()

    return run


def give_back() -> None:
    """Returns what numpy and Arrow freed to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def matched(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, how: str, *more: str) -> DataFrame:
    """``docs`` joined with ``found`` (``id``, ``text_key``: a hash of the text, each pair once); null ids match each other.

    Up to ``BROADCAST_ROWS`` rows found are broadcast, so that no text is shuffled.  An inner join brings the columns ``more``.
    """
    found = cut(found)
    i, k = fresh(docs, "id_found", "key_found")
    near = bounded_broadcast(found.select(F.col("id").alias(i), F.col("text_key").alias(k), *more), found.count(), BROADCAST_ROWS)
    return docs.join(near, own(docs, id_col).eqNullSafe(F.col(i)) & (F.xxhash64(own(docs, text_col)) == F.col(k)), how)


# ---------------------------------------------------------------- hashing

_RNG = np.random.default_rng(20240229)
BYTE_VALUE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUE_LOWER = BYTE_VALUE.copy()
BYTE_VALUE_LOWER[65:91] = BYTE_VALUE[97:123]
GRAM_VALUE = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
RADIX = 0x9E3779B97F4A7C15
RADIX_INVERSE = pow(RADIX, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_b = np.arange(256)
#: True for the bytes of a word, by class.
IS_WORD = {
    WORD_CLASS: ((_b >= 48) & (_b <= 57)) | ((_b >= 97) & (_b <= 122)) | ((_b >= 65) & (_b <= 90)) | (_b >= 128),
    SPACE_CLASS: ~((_b == 32) | ((_b >= 9) & (_b <= 13))),
}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class _Powers:
    """Powers of RADIX and of its inverse, grown when a longer stretch asks for it."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            powers = np.ones((2, size), np.uint64)
            powers[0, 1:], powers[1, 1:] = RADIX, RADIX_INVERSE
            self.up, self.down = np.cumprod(powers, axis=1, dtype=np.uint64)
        return self.up, self.down


_powers = _Powers()


def powers(n: int) -> np.ndarray:
    """The first n powers of RADIX."""
    return _powers.upto(n)[0]


class Tokens(NamedTuple):
    """Words of some texts: byte spans in ``data``, hashes of the lower-cased words, and ``first[i]:first[i+1]`` for text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def words(self, i: int, j: int) -> str:
        """Words i to j (exclusive), lower-cased, joined by spaces."""
        return b" ".join(LOWER[self.data[a:b]].tobytes() for a, b in zip(self.start[i:j].tolist(), self.end[i:j].tolist(), strict=True)).decode("utf-8", "replace")


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array and its offsets; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``most`` bytes: first and last index, their bytes and offsets."""
    data, at = text_buffers(texts)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def even_chunks(texts: pa.Array, about: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As ``chunks``, in as many runs as there are times ``about`` bytes, all of nearly the same size."""
    data, at = text_buffers(texts)
    parts = max(1, round(len(data) / about))
    ends = np.searchsorted(at, len(data) * np.arange(1, parts) // parts)
    bounds = np.unique(np.concatenate(([0], ends, [len(at) - 1]))).tolist()
    for i, j in zip(bounds[:-1], bounds[1:], strict=True):
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]


def tokenize(data: np.ndarray, at: np.ndarray, word_class: str) -> Tokens:
    """Words of the texts ``data[at[i]:at[i+1]]``: maximal runs of ``word_class``, hashed with A-Z lower-cased."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Tokens(data, none, none, np.zeros(0, np.uint64), np.zeros(len(at), np.int64))
    inside = IS_WORD[word_class][data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    full = at[:-1] < at[1:]
    heads, tails = at[:-1][full], at[1:][full] - 1
    opens[heads] = inside[heads]
    closes[tails] = inside[tails]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Tokens(data, start, end, span_hashes(data, start, end), np.searchsorted(start, at))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray = BYTE_VALUE_LOWER) -> np.ndarray:
    """64-bit polynomial hashes of ordered spans that don't overlap, by running sums over about a megabyte at a time."""
    out, i, n = np.empty(len(start), np.uint64), 0, len(start)
    while i < n:
        a = int(start[i])
        j = max(i + 1, int(np.searchsorted(end, a + CHUNK_BYTES, "right")))
        z = int(end[j - 1])
        up, down = _powers.upto(z - a + 1)
        sums = np.zeros(z - a + 1, np.uint64)
        np.cumsum(value[data[a:z]] * up[: z - a], out=sums[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(RADIX))
        i = j
    return out


def grams(t: Tokens, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words within one text, and the index of each run's first word."""
    n = len(t.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = t.hash[:n] * GRAM_VALUE[0]
    for j in range(1, k):
        out += t.hash[j : j + n] * GRAM_VALUE[j]
    doc = t.doc
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    return mix(out[at] + np.uint64(k)), at


def long(x: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


# ---------------------------------------------------------------- bitmaps

#: Bits of a bitmap for each row, and at least and at most in all.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 30


def hash_bitmap(df: DataFrame, col: str, bits: int | None = None) -> np.ndarray:
    """A bitmap with the places of the column's hashes set, of ``bits`` bits, or by the counted rows, within bounds.

    Spark builds it in pieces of 4 KB; the driver sees at most bits / 32768 of them.
    """
    if bits is None:
        bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * df.count()).bit_length()))
    at = F.pmod(F.col(col), F.lit(bits)) + 1  # Spark numbers bits from 1
    rows = df.select(F.bitmap_bucket_number(at).alias("k"), F.bitmap_bit_position(at).alias("p")).groupBy("k").agg(F.bitmap_construct_agg("p").alias("bits")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:  # pieces of 32768 bits, numbered from 1
        out[(r.k - 1) * 4096 : r.k * 4096] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h & np.uint64(len(bitmap) * 8 - 1)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
