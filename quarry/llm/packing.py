"""Packing along a space-filling curve: neighbours on the curve share sequences of a fixed number of tokens.

1. Each text is encoded once, as a whole, and the end token added.  Its tokens' hashed vector (square roots of counts, signed,
   of unit length) is projected to a few dimensions, and the cell it falls in gives its place on a Hilbert curve.
2. (key, tie, size) rows, without tokens, are range-sorted along the curve.  Each range sums its own sizes, after the sums of the
   ranges before it, so that every document knows where it starts among all tokens; no task sees more than its range.
3. The documents' tokens are cut where sequences end: each piece has its sequence and its place there.

What remains after the last full sequence is cut in descending powers of two, which need no padding: there is none at all.
``sequences`` gathers the pieces, at most ``width`` tokens each.

Tokens are written once, two bytes each (the vocabulary has fewer than 65,536), and then meet their places: these are broadcast up to
``BROADCAST_ROWS`` documents and joined by a shuffle beyond.  Copies share a key and are told apart by hash and row, so a range
boundary can fall between them.

Defined cases: a null or empty text is the end token alone.  A null id stays null; each row is a document of its own, repeated
ones too.  A text of any length is encoded whole (memory follows the longest) and fills as many sequences as it needs.  The special
token's string in a text is that token, as the vocabulary's own library reads it.  Other columns are ignored, whatever their names.
An empty table gives no pieces.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from . import token_counts as T

WIDTH = 2048
END = 1
# Fixed value: the special token of the vocabulary and its id.
SPECIAL = ("<|endoftext|>", 50256)
BUCKETS, DIMENSIONS, BITS = 1024, 4, 15
BROADCAST_ROWS = C.BROADCAST_ROWS
#: Documents of a range of the curve, and of a block of vectors.
RANGE_ROWS = 1_000_000
BLOCK = 512


def encoded(text: str, raw: bytes, pattern: str = T.PATTERN, special: tuple[str, int] = SPECIAL, end: int = END) -> np.ndarray:
    """The ids of a text, and ``end``.  A long run of white space is encoded apart, as ``token_counts`` does."""
    encoder, _ = T._encoder(raw, pattern)
    ids = array("H")
    for k, part in enumerate(text.split(special[0])):
        if k:
            ids.append(special[1])
        a = 0
        for run in T.LONG_RUN.finditer(part):
            z = run.end() - (run.end() < len(part))
            ids.extend(encoder.encode_ordinary(part[a : run.start()]))
            ids.extend(encoder._encode_single_piece(part[run.start() : z]))
            a = z
        ids.extend(encoder.encode_ordinary(part[a:] if a else part))
    ids.append(end)
    return np.frombuffer(ids, np.uint16)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (a row each, with coordinates below 2^bits), by exchanging and inverting axes from the
    highest bit down and interleaving the Gray code that results."""
    x = cells.astype(np.int64).T.copy()
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for axis in x:
            high = axis >> b & 1 == 1
            swap = np.where(high, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(high, low, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> b & 1 == 1, (1 << b) - 1, 0)
    x ^= flip
    key = np.zeros_like(flip)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | axis >> b & 1
    return key


def _directions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and sign of each id, and the projection."""
    rng = np.random.default_rng(12)
    return rng.integers(0, BUCKETS, 1 << 16), rng.choice([-1.0, 1.0], 1 << 16), rng.standard_normal((BUCKETS, DIMENSIONS))


BUCKET, SIGN, PROJECTION = _directions()


def curve_keys(documents: list[np.ndarray]) -> np.ndarray:
    """Each document's place on the curve, from its ids."""
    keys = [np.zeros(0, np.int64)]
    for a in range(0, len(documents), BLOCK):
        block = documents[a : a + BLOCK]
        ids = np.concatenate(block).astype(np.int64)
        row = np.repeat(np.arange(len(block)), [len(d) for d in block])
        held = np.bincount(row * BUCKETS + BUCKET[ids], SIGN[ids], len(block) * BUCKETS).reshape(len(block), BUCKETS)
        held = np.sign(held) * np.sqrt(np.abs(held))
        held /= np.maximum(np.sqrt((held * held).sum(axis=1, keepdims=True)), 1e-9)
        cells = (1 << BITS) / (1 + np.exp(-1.702 * (held @ PROJECTION)))  # about uniform in each dimension
        keys.append(hilbert(np.minimum(cells.astype(np.int64), (1 << BITS) - 1), BITS))
    return np.concatenate(keys)


def encode(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, pattern: str) -> DataFrame:
    """``row, id, key, tie, n, ids`` of each document, written and read again; ``ids``: little-endian, of 2 bytes."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at, size = batch.column(3), 0, 0
            for k in range(len(batch) + 1):
                if k == len(batch) or size >= C.CHUNK_BYTES:
                    found = [encoded(texts[j].as_py() or "", sent.value, pattern) for j in range(at, k)]
                    row, ids, tie = (batch.column(c)[at:k] for c in range(3))
                    yield pa.RecordBatch.from_arrays([row, ids, pa.array(curve_keys(found)), tie, pa.array([len(x) for x in found], pa.int64()), pa.array([x.astype("<u2", copy=False).tobytes() for x in found], pa.binary())], names=names)
                    at, size = k, 0
                if k < len(batch):
                    size += len(texts[k].as_buffer() or b"")

    own = C.own(docs, id_col)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), own.alias("id"), F.xxhash64(C.own(docs, text_col), own).alias("tie"), C.own(docs, text_col).alias("text"))
    names = ["row", "id", "key", "tie", "n", "ids"]
    schema = C.struct({"row": "bigint", "id": rows.schema["id"].dataType, "key": "bigint", "tie": "bigint", "n": "bigint", "ids": "binary"})
    path = C.scratch(spark, "tokens")
    rows.mapInArrow(C.released(each), schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def places(tokens: DataFrame, rows: int) -> DataFrame:
    """``row, at``: where each document starts among all tokens, along the curve.  The sums of ranges are one row each."""
    ranges = max(1, -(-rows // RANGE_ROWS))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            n = batch.column(2).to_numpy()
            ends = total + np.cumsum(n)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ends - n), pa.array(n)], names=["range", "row", "local", "n"])
            total = int(ends[-1]) if len(ends) else total

    sorted_rows = tokens.select("key", "tie", "row", "n").repartitionByRange(ranges, "key", "tie", "row").sortWithinPartitions("key", "tie", "row")
    summed = C.cut(sorted_rows.select(F.spark_partition_id().alias("range"), "row", "n").mapInArrow(add_up, "range int, row bigint, local bigint, n bigint"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    starts = summed.groupBy("range").agg(F.sum("n").alias("held")).select("range", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    return summed.join(F.broadcast(starts), "range").select("row", (F.col("start") + F.col("local")).alias("at"))


def bounds(total: int, width: int) -> tuple[int, np.ndarray]:
    """The number of full sequences, and where the ones after them start: the rest in descending powers of two."""
    full, rest = divmod(total, width)
    sizes = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return full, full * width + np.cumsum([0, *sizes])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, vocabulary: str = T.VOCABULARY, pattern: str = T.PATTERN) -> DataFrame:
    """One row a piece: the document's id, ``row`` (which tells documents apart), ``start, length`` (its tokens), ``ids`` (little-endian,
    of 4 bytes), ``doc_tokens``, ``sequence_id`` (from 0, along the curve) and ``offset`` (there)."""
    C.importable(docs.sparkSession)
    tokens = encode(docs, id_col, text_col, vocabulary, pattern)
    held = tokens.agg(F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    at = places(tokens, held.rows)
    full, tail = bounds(held.total, width)
    names = ["id", "row", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    schema = C.schema(tokens, "id", row="bigint", start="bigint", length="bigint", ids="binary", doc_tokens="bigint", sequence_id="bigint", offset="bigint")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, n, at = (batch.column(c).to_numpy() for c in (1, 2, 4))
            owner, start, length, raw, sequence, offset = [], [], [], [], [], []
            for k in range(len(batch)):
                a, z = int(at[k]), int(at[k] + n[k])
                ids = np.frombuffer(batch.column(3)[k].as_buffer(), "<u2").astype("<u4").tobytes()
                cuts = [a, *range((a // width + 1) * width, min(z, full * width + 1), width), *(int(t) for t in tail[1:] if a < t < z), z]
                for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                    if x == y:
                        continue
                    s = x // width if x < full * width else full + int(np.searchsorted(tail, x, "right")) - 1
                    owner.append(k)
                    start.append(x - a)
                    length.append(y - x)
                    raw.append(ids[4 * (x - a) : 4 * (y - a)])
                    sequence.append(s)
                    offset.append(x - (s * width if s < full else int(tail[s - full])))
            at_owner = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at_owner), pa.array(row[owner]), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(raw, pa.binary()), pa.array(n[owner]), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=names,
            )

    near = C.bounded_broadcast(at, held.rows, BROADCAST_ROWS)
    met = tokens.select("id", "row", "n", "ids").join(near, "row").select("id", "row", "n", "ids", "at")
    return met.mapInArrow(C.released(cut), schema).withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, length, ids`` of each sequence, its pieces put one after another."""
    put = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(put, F.lit(b"").cast("binary"), lambda done, piece: F.concat(done, piece["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(C.table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {"op12_packing": op12_packing}
ORACLE_SQL: dict[str, str] = {}
