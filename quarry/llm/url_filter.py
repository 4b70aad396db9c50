"""URL filters: a bit-parallel wildcard automaton.

All glob rules are packed side by side into one multiword Shift-And state: bit i of a rule says that its first i symbols
are matched.  A byte c moves every rule at once, ``D = ((D << 1) & B[c]) | (D & S[c])``: B has the places where c may come
next, S those followed by a wildcard that swallows c.  The URLs of a batch go through it together, byte by byte, longest
first, so that each step is one numpy expression over (URLs still running, words of the state).

Globs match a whole canonical URL (host with A-Z lower-cased, then path): ``*`` is any run without ``/``, ``**`` any run,
``?`` any one byte; a host rule such as ``example.com/en/`` becomes ``example.com/en/**`` and ``*.example.com/en/**``.

The state's size follows the rules' text, never the data; the rules travel with the function.  No shuffle.

Defined cases: a null URL, or one without ``://``, has an empty host and path and meets no host rule.  Repeated rows are
judged one by one; an empty table gives an empty one.  Where several host rules fit, the longest text wins, then the first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C


class HostRule(NamedTuple):
    """Fits its host and all subdomains where the URL's path starts with the rule's."""

    verdict: str
    text: str


# The contract's rules.
RULES = (HostRule("allow", "com/"), HostRule("block", "example.com/en/"), HostRule("allow", "www.example.com/en/"), HostRule("block", "net/es/"), HostRule("block", "net/fr/"))
#: What the method blocks where no host rule fits.
GLOBS = ("**spam**", "**pills**", "**casino**", "**/wp-login.php", "**.exe")


class Automaton:
    """Globs over bytes, packed into ``words`` 64-bit words."""

    def __init__(self, globs: Sequence[str]) -> None:
        bit, places, loops, self.accept, first = 0, [], [], [], []
        for g in globs:
            raw, i = g.encode(), 0
            first.append(bit)
            while i < len(raw):
                if raw[i : i + 2] == b"**":
                    loops.append((bit, None))
                    i += 2
                elif raw[i : i + 1] == b"*":
                    loops.append((bit, ord("/")))
                    i += 1
                else:
                    bit += 1
                    places.append((bit, None if raw[i : i + 1] == b"?" else raw[i]))
                    i += 1
            self.accept.append(bit)
            bit += 1
        self.words = max(1, -(-bit // 64))
        self.next, self.stay = np.zeros((2, 256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for b in first:
            self.start[b // 64] |= np.uint64(1 << (b % 64))
        for b, c in places:
            self.next[slice(None) if c is None else c, b // 64] |= np.uint64(1 << (b % 64))
        for b, but in loops:
            kept = np.arange(256) != (-1 if but is None else but)
            self.stay[kept, b // 64] |= np.uint64(1 << (b % 64))

    def match(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each text ``data[at[i]:at[i+1]]`` and glob, whether it matches."""
        size = np.diff(at)
        order = np.argsort(-size, kind="stable")
        begin, size = at[:-1][order], size[order]
        state = np.repeat(self.start[None, :], len(order), axis=0)
        running, ends = len(order), np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left")
        for step, running in enumerate(ends.tolist()):  # texts longer than step
            d, c = state[:running], data[begin[:running] + step]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:running] = (moved & self.next[c]) | (d & self.stay[c])
        found = np.empty((len(order), len(self.accept)), bool)
        for k, b in enumerate(self.accept):
            found[order, k] = (state[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1) == 1
        return found


def host(url: Column) -> Column:
    return C.ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[HostRule] = RULES, globs: Sequence[str] = GLOBS) -> DataFrame:
    """One row for each page: its id, host, path, ``rule`` (the host rule that decides, else null), ``globs`` (those of the
    method that match) and ``verdict``: the rule's, else block if a glob matches, else allow."""
    C.importable(pages.sparkSession)
    ranked = sorted(rules, key=lambda r: -len(r.text))
    patterns = [x for r in ranked for x in (f"{r.text}**", f"*.{r.text}**")] + list(globs)
    names, verdicts = [r.text for r in ranked] + [None], [r.verdict for r in ranked]
    automaton = Automaton(patterns)
    kind = pages.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in C.chunks(batch.column(3)):
                m = automaton.match(data, at)
                n, own = j - i, m[:, 2 * len(ranked) :]
                fits = np.ones((n, len(ranked) + 1), bool)
                fits[:, :-1] = m[:, 0 : 2 * len(ranked) : 2] | m[:, 1 : 2 * len(ranked) : 2]
                rule = fits.argmax(axis=1).tolist()
                verdict = [verdicts[r] if r < len(ranked) else "block" if g else "allow" for r, g in zip(rule, own.any(axis=1).tolist(), strict=True)]
                matched = [[globs[k] for k in np.flatnonzero(row)] for row in own]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], batch.column(2)[i:j], pa.array([names[r] for r in rule], pa.string()), pa.array(matched, pa.list_(pa.string())), pa.array(verdict, pa.string())], names=["id", "host", "path", "rule", "globs", "verdict"])

    url = C.own(pages, url_col)
    h, p = host(url), path(url)
    rows = pages.select(C.own(pages, id_col).alias("id"), h.alias("host"), p.alias("path"), F.concat(h, p).alias("canonical"))
    return rows.mapInArrow(judge, f"id {kind}, host string, path string, rule string, globs array<string>, verdict string").withColumnRenamed("id", id_col)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(C.table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {"op6_url_filter": op6_url_filter}

ORACLE_SQL = {
    "op6_url_filter": f"""
    WITH p AS (
      SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{C.UPPER}', '{C.UPPER.lower()}') AS host,
        regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages
    ), rules(verdict, host, path) AS (
      VALUES {", ".join(f"('{r.verdict}', '{r.text[: r.text.index('/')]}', '{r.text[r.text.index('/') :]}')" for r in RULES)}
    ), fits AS (
      SELECT page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS k
      FROM p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    )
    SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host || path LIKE '%spam%' OR host || path LIKE '%pills%' OR host || path LIKE '%casino%'
      OR host || path LIKE '%/wp-login.php' OR host || path LIKE '%.exe' THEN 'block' ELSE 'allow' END) AS verdict FROM fits WHERE k = 1
    """
}
