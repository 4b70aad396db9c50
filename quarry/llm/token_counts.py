"""Token counts by offset-mapped attribution.

A document is encoded once, as a whole, so that no section's tokens depend on where it was cut.  The tokens' lengths in
bytes give each token's span, mapped to characters; the spans are joined with the sections' spans.  Sections are the
lines of a text, or named fields put one after another, and cover it without gaps; a character that separates two
sections belongs to the first.

A token that crosses a boundary goes to one section by an explicit rule: ``start`` (where its first character is),
``end`` (where its last is) or ``most`` (where most of its characters are, the earliest of equals).  Every token is given
to exactly one section, so the sections' counts add up to the document's.

One scan, no shuffle.  The vocabulary is read by the driver from a path that is a parameter, and sent as it is; its size
does not depend on the data.  Memory follows the longest document.

Defined cases: a null or empty text has no tokens and no sections.  A text of any length is encoded whole, long runs of white
space in parts where the vocabulary's pattern splits them too.  The report has columns of its own, whatever others there are.  A token within a character (a byte of it) has that
character as its span.  Repeated rows are counted one by one.  An empty table gives an empty one.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator, Sequence
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

if TYPE_CHECKING:
    import tiktoken

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of (Unicode's) white space that are long.
LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
RULES = ("start", "end", "most")


@functools.cache
def _encoder(raw: bytes, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder, and its tokens' lengths in bytes."""
    import tiktoken  # only this operator needs it

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size


def _encoded(encoder: tiktoken.Encoding, text: str) -> Iterator[Sequence[int]]:
    """The tokens of a text, in parts.  A long run of white space is a part of its own, since the pattern would step back through
    it once for each of its characters; where a word follows, the run's last character goes with the word, as in the pattern."""
    a = 0
    for run in LONG_RUN.finditer(text):
        z = run.end() - (run.end() < len(text))
        yield encoder.encode_to_numpy(text[a : run.start()], disallowed_special=())
        yield encoder._encode_single_piece(text[run.start() : z])
        a = z
    yield encoder.encode_to_numpy(text[a:], disallowed_special=())


def token_spans(text: str, raw: bytes, pattern: str = PATTERN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of a text, and the first and last (inclusive) character of each."""
    encoder, size = _encoder(raw, pattern)
    tokens = np.concatenate([np.asarray(x, np.int64) for x in _encoded(encoder, text)])
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    ends = np.cumsum(size[tokens])
    return tokens, char[ends - size[tokens]], char[ends - 1]


def line_starts(text: str) -> np.ndarray:
    """Where the lines of a text start; a newline belongs to the line that it ends."""
    newline = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32) == 10) + 1
    return np.concatenate(([0], newline[newline < len(text)])) if text else np.zeros(0, np.int64)


def attribute(first: np.ndarray, last: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token, and whether it crosses a boundary.  ``starts``: where the sections start, ascending from 0."""
    low, high = (np.searchsorted(starts, x, "right") - 1 for x in (first, last))
    if rule == "start":
        return low, low < high
    if rule == "end":
        return high, low < high
    best = low.copy()
    bounds = np.append(starts, np.iinfo(np.int64).max)
    for t in np.flatnonzero(low < high).tolist():
        held = np.minimum(bounds[low[t] + 1 : high[t] + 2], last[t] + 1) - np.maximum(bounds[low[t] : high[t] + 1], first[t])
        best[t] = low[t] + int(held.argmax())
    return best, low < high


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fields: Sequence[str] = (), rule: str = "start", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """One row for each document row: its id, ``n_tokens``, ``n_crossing`` and ``sections``: ``section`` (a field's name, or a
    line's number from 0), ``start, end`` (characters, end exclusive) and ``tokens``.

    Sections are the lines of ``text_col``; or, if given, ``fields``: string columns, each followed by a newline.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(vocabulary, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["id", "n_tokens", "n_crossing", "sections"]
    section = pa.struct([("section", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, crossings, found, sizes = [], [], [[], [], [], []], [0]
            for k in range(len(batch)):
                parts = [batch.column(c)[k].as_py() or "" for c in range(1, batch.num_columns)]
                if fields:
                    text = "\n".join([*parts, ""])
                    starts = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])
                else:
                    text = parts[0]
                    starts = line_starts(text)
                tokens, first, last = token_spans(text, sent.value, pattern)
                where, crosses = attribute(first, last, starts, rule)
                n = np.bincount(where, minlength=len(starts)) if len(starts) else starts
                totals.append(len(tokens))
                crossings.append(int(crosses.sum()))
                found[0] += fields or map(str, range(len(starts)))
                for column, values in zip(found[1:], (starts, np.append(starts[1:], len(text))[: len(starts)], n), strict=True):
                    column.append(values)
                sizes.append(sizes[-1] + len(starts))
            flat = [pa.array(found[0], pa.string()), *(pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)) for x in found[1:])]
            structs = pa.StructArray.from_arrays(flat, fields=list(section))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64()), pa.array(crossings, pa.int64()), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), structs)], names=names)

    rows = docs.select(C.own(docs, id_col).alias("id"), *(C.own(docs, c).alias(f"f{k}") for k, c in enumerate(fields or [text_col])))
    schema = C.schema(rows, "id", n_tokens="bigint", n_crossing="bigint", sections="array<struct<section:string,start:bigint,end:bigint,tokens:bigint>>")
    return rows.mapInArrow(C.released(count), schema).withColumnRenamed("id", id_col)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = count_tokens(C.table(spark, sf_dir, "documents"))
    tokens = F.transform("sections", lambda s: s["tokens"])
    return found.select("doc_id", "n_tokens", F.size("sections").cast("bigint").alias("n_sections"), "n_crossing", F.coalesce(F.get(tokens, F.lit(0)), F.lit(0)).alias("first_section"), F.array_max(tokens).alias("largest_section"), tokens.alias("section_tokens"))


QUERIES = {"op10_token_counts": op10_token_counts}
ORACLE_SQL: dict[str, str] = {}
