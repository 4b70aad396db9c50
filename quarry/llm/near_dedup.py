"""MinHash near-dedup on SetSketch registers.

1. Sketch.  A document's set of word shingles gives ``REGISTERS`` registers: each hash function's minimum over the set,
   as an exponential variate, on a scale of powers of ``BASE``.  Registers merge by maximum.  Documents with equal sets
   are one node from here on, so copies cost no pairs.
2. Candidates.  ``BAND`` registers make a band; nodes that agree in a band meet in a bucket.  A bucket pairs each member
   with its centre alone, so the count is linear in the bucket.  The centre is the member that meets most others in all
   of its buckets: of a group of altered copies, the one that is altered least.
3. Estimate.  For a pair, the counts of registers that are larger, smaller or equal, together with both sizes, give the
   maximum-likelihood Jaccard similarity; pairs far below the threshold go.
4. Verify.  What is left is decided on the full sets, exactly.  A centre's members are dealt into blocks of about
   ``BLOCK``; each member's set is sent once for each of its centres, a centre's once for each of its blocks, and a
   task holds a batch of members and one centre at a time.
5. Components.  Verified links join nodes by distributed minimum-label hooking with pointer jumping.
6. The rest.  Where the members around a centre are then in several components, those outside the centre's component are
   compared with all members in other components, in pairs of blocks whose intersections are matrix products.  A block's
   task holds two blocks of sets and returns what it joins, a row for each component at most.  So no link between nodes
   that meet in any bucket is lost, with no cap on bucket or partners.

At similarity 0.8 a pair misses all 48 bands with a probability below 1e-6, and the estimate's margin is five standard
deviations.  Texts are read three times and never shuffled; sets are shuffled for candidates only.  A bitmap picks those:
16 bits for each, at most ``common.MOST_BITS`` (128 MB) in all; a fuller one lets more sets into the shuffle and changes no result.

Defined cases: no words (or a null text) is an empty set, linked with nothing; the document is its own component.  With
fewer words than a shingle, the whole sequence is the one shingle.  A component's id is its smallest document id; null
ids count only if there is no other, and are kept then.  Repeated rows are reported one by one; of those that stand for a
component, one stays in ``one_of_each``.  A text of any length is one set (about 24 bytes a word while it is made).  The report
has columns of its own, whatever other columns ``docs`` has.  An empty table gives an empty report.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SHINGLE = 5
PERCENT = 80
BAND, BANDS = 6, 48
REGISTERS = BAND * BANDS
BASE, RATE, TOP = 1.02, 20.0, (1 << 16) - 1
#: Five standard deviations of the estimate at similarity 0.8.
MARGIN = 0.12
#: Bytes of sets in a block of those compared at last, and nodes in any block.
BLOCK_BYTES, BLOCK = 4 << 20, 1024
#: Bytes of a node beside its shingles.
OVERHEAD = 2 * REGISTERS + 64

_rng = np.random.default_rng(77)
FACTORS = _rng.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
BAND_VALUE = _rng.integers(0, 1 << 63, (BANDS, BAND), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
NAMES = ["rid", "id", "text_key", "n", "f1", "f2", "bands"]


# ---------------------------------------------------------------- sets and sketches


def shingle_sets(data: np.ndarray, at: np.ndarray, k: int, word_class: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted: all hashes, and ``first[i]:first[i+1]`` for text i."""
    t = C.tokenize(data, at, word_class)
    h, start = C.grams(t, k)
    doc = t.doc[start]
    for n in range(1, k):
        few = np.flatnonzero(np.diff(t.first) == n)
        if len(few):
            whole = np.zeros(len(few), np.uint64)
            for j in range(n):
                whole += t.hash[t.first[few] + j] * C.GRAM_VALUE[j]
            h, doc = np.concatenate((h, C.mix(whole + np.uint64(n)))), np.concatenate((doc, few))
    if k > 1:
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    first = np.searchsorted(doc, np.arange(len(at)))
    for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        h[a:z].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.concatenate(([0], np.cumsum(new)))[first]


def set_registers(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SetSketch registers (uint16, one row a set) of the sets ``h[first[i]:first[i+1]]``, none of them empty."""
    low, x = np.empty((len(first), REGISTERS), np.uint32), (h >> np.uint64(32)).astype(np.uint32)
    for r in range(REGISTERS):
        low[:, r] = np.minimum.reduceat(x * FACTORS[r], first)
    exponential = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def bands(registers: np.ndarray) -> np.ndarray:
    """A hash for each band of each row of registers."""
    grouped = registers.reshape(len(registers), BANDS, BAND).astype(np.uint64) + np.uint64(1)
    return C.mix((grouped * BAND_VALUE).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def likeliest_jaccard(more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity from the registers that are larger in a and in b, and both sizes, on a grid of 1/256."""
    u = (n_a / (n_a + n_b))[:, None]
    v, equal = 1 - u, REGISTERS - more - less
    j = np.linspace(0, 1, 257)[None, :] * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    fit = more[:, None] * log(up) + less[:, None] * log(down) + equal[:, None] * log(1 - up - down)
    return j[np.arange(len(j)), fit.argmax(axis=1)]


def _fingerprints(h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.add.reduceat(C.mix(h), starts), np.add.reduceat(C.mix(h ^ np.uint64(C.RADIX)), starts)


def sketches(docs: DataFrame, id_col: str, text_col: str, k: int, word_class: str) -> DataFrame:
    """``rid, id, text_key, n`` (set size), ``f1, f2`` (128 bits of the set) and ``bands``; an empty set has f1 = rid, f2 = null."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = batch.column(0).to_numpy()
            for i, j, data, at in C.chunks(batch.column(3)):
                h, first = shingle_sets(data, at, k, word_class)
                n = np.diff(first)
                full = np.flatnonzero(n)
                f1, f2, found = rid[i:j].copy(), np.zeros(j - i, np.int64), np.zeros(0, np.uint64)
                if len(full):
                    a, b = _fingerprints(h, first[full])
                    f1[full], f2[full] = a.view(np.int64), b.view(np.int64)
                    found = bands(set_registers(h, first[full])).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.where(n > 0, BANDS, 0)))).astype(np.int32)), C.long(found))
                f2s = pa.compute.if_else(pa.array(n == 0), pa.scalar(None, pa.int64()), pa.array(f2))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], batch.column(2)[i:j], pa.array(n), pa.array(f1), f2s, lists], names=NAMES)

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), C.own(docs, id_col).alias("id"), F.xxhash64(C.own(docs, text_col)).alias("text_key"), C.own(docs, text_col).alias("text"))
    return rows.mapInArrow(C.released(sketch), C.schema(rows, "rid", "id", "text_key", n="bigint", f1="bigint", f2="bigint", bands="array<bigint>"))


def _sets(docs: DataFrame, text_col: str, wanted: DataFrame, k: int, word_class: str) -> DataFrame:
    """``f1, f2, registers, shingles`` (sorted hashes as bytes), each set once, of the documents whose f1 is among those of
    ``wanted``, and of a few more."""
    sent = docs.sparkSession.sparkContext.broadcast(C.hash_bitmap(wanted, "f1"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, at in C.chunks(batch.column(0)):
                h, first = shingle_sets(data, at, k, word_class)
                full = np.flatnonzero(np.diff(first))
                if not len(full):
                    continue
                f1, f2 = _fingerprints(h, first[full])
                own: dict[tuple[int, int], int] = {}
                for x in np.flatnonzero(C.in_bitmap(sent.value, f1)).tolist():
                    own.setdefault((int(f1[x]), int(f2[x])), x)
                if not own:
                    continue
                at_ = list(own.values())
                sets = [h[first[full[x]] : first[full[x] + 1]] for x in at_]
                registers = set_registers(np.concatenate(sets), np.cumsum([0, *(len(x) for x in sets[:-1])]))
                yield pa.RecordBatch.from_arrays([C.long(f1[at_]), C.long(f2[at_]), pa.array([r.tobytes() for r in registers], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["f1", "f2", "registers", "shingles"])

    return docs.select(C.own(docs, text_col)).mapInArrow(C.released(pick), "f1 bigint, f2 bigint, registers binary, shingles binary").dropDuplicates(["f1", "f2"])


# ---------------------------------------------------------------- links


def _salts(members: str) -> Column:
    return F.ceil(F.col(members) / BLOCK).cast("int")


def _salt(node: str, members: str) -> Column:
    """The part of its group that a node is in: parts have about ``BLOCK`` nodes."""
    return F.pmod(F.xxhash64(node), _salts(members)).cast("int")


def _met(rows: DataFrame, few: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` (with node, and the size of the key's group) joined by key with ``few``, which has one row for each key and
    that size as ``most``.  A large group is spread by parts, to each of which its row goes."""
    parts = few.withColumn("salt", F.explode(F.sequence(F.lit(0), _salts("most") - 1))).drop("most")
    return rows.withColumn("salt", _salt("node", size)).join(parts, [key, "salt"]).drop("salt")


def _verified(pairs: DataFrame, nodes: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """The ``pairs`` (centre, node, and how many the centre met in all of its buckets) that are links, as ``a, b``: likely by their registers,
    and confirmed on the full sets."""
    placed = pairs.withColumn("block", _salt("node", "met"))
    members = placed.select("centre", "block", "node")
    centres = placed.select("centre", "block").distinct().select("centre", "block", F.col("centre").alias("node"))
    dealt = C.cut(members.unionAll(centres).join(nodes.select("node", "f1", "f2", "n"), "node"))
    rows = sets(dealt).join(dealt, ["f1", "f2"]).select("centre", "block", "node", "n", "registers", "shingles")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come centre by centre and block by block, the centre first."""
        last: tuple[int, bytes, bytes] | None = None  # size, registers and shingles of the last batch's last centre
        for batch in batches:
            if not len(batch):
                continue
            centre, node, n = (batch.column(c).to_numpy() for c in (0, 2, 3))
            head = centre == node
            registers, shingles = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            of = np.maximum.accumulate(np.where(head, np.arange(len(head)), -1))  # each row's centre; -1: the last batch's
            if last is not None:  # behind all others: where -1 points to
                n, registers, shingles = np.append(n, last[0]), [*registers, last[1]], [*shingles, last[2]]
            raw = np.frombuffer(b"".join(registers), np.uint16).reshape(-1, REGISTERS)
            rows, linked = np.flatnonzero(~head), np.zeros(len(head), bool)
            if len(rows):
                mine, its = raw[rows], raw[of[rows]]
                n_a, n_b = n[rows], n[of[rows]]
                likely = likeliest_jaccard((mine > its).sum(axis=1), (mine < its).sum(axis=1), n_a, n_b) >= percent / 100 - MARGIN
                likely &= 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
                for x in rows[likely].tolist():
                    a, b = (np.frombuffer(shingles[y], np.uint64) for y in (x, of[x]))
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    linked[x] = 100 * both >= percent * (len(a) + len(b) - both)
            if of[-1] >= 0:
                last = int(n[of[-1]]), registers[of[-1]], shingles[of[-1]]
            yield pa.RecordBatch.from_arrays([pa.array(centre[linked]), pa.array(node[linked])], names=["a", "b"])

    ordered = rows.repartition("centre", "block").sortWithinPartitions("centre", "block", F.col("node") != F.col("centre"))
    return ordered.mapInArrow(C.released(verify), "a bigint, b bigint")


def _shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections between two lists of sets, as products of incidence matrices."""
    at = np.unique(np.concatenate(a + b), return_inverse=True)[1]
    row = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in a + b])
    left = row < len(a)
    wanted = np.isin(at, at[left]) & np.isin(at, at[~left])  # the others can't be shared
    at, row = np.unique(at[wanted], return_inverse=True)[1], row[wanted]
    out, wide = np.zeros((len(a), len(b)), np.float32), max(64, (4 << 20) // (len(a) + len(b)))
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, wide):
        i, j = np.searchsorted(at, (low, low + wide))
        incident = np.zeros((len(a) + len(b), wide), np.float32)
        incident[row[i:j], at[i:j] - low] = 1
        out += incident[: len(a)] @ incident[len(a) :].T
    return out


def _joined_blocks(percent: int) -> Callable[[tuple[pa.Scalar, ...], pa.Table], pa.Table]:
    """What the links between the two sides of a unit (or within its one side) join: ``a, b`` are nodes of two components that
    become one, a row for each component at most."""

    def join(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        side, node, comp, n = (rows[c].to_numpy() for c in ("side", "node", "comp", "n"))
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if (side == 1).any() else left
        _, lead, own = np.unique(comp, return_index=True, return_inverse=True)
        label = np.arange(len(lead))
        if len(left):
            shared = _shared([sets[x] for x in left], [sets[x] for x in right])
            joint = n[left][:, None] + n[right][None, :] - shared
            x, y = np.nonzero(100 * shared >= percent * joint)
            x, y = own[left[x]], own[right[y]]
            while True:
                low = np.minimum(label[x], label[y])
                was = label.copy()
                np.minimum.at(label, x, low)
                np.minimum.at(label, y, low)
                label = label[label]
                if (label == was).all():
                    break
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.Table.from_arrays([pa.array(node[lead[label[moved]]]), pa.array(node[lead[moved]])], names=["a", "b"])

    return join


def _remaining(around: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """What links between nodes of different components among those around a centre join (``a, b``).  ``around``: centre,
    node, comp, home (the centre's component), met (by the centre), f1, f2, n."""
    outer = F.col("comp") != F.col("home")

    def blocks(which: Column) -> Column:
        size = F.sum(F.when(which, 8 * F.col("n") + OVERHEAD)) / BLOCK_BYTES
        return F.coalesce(F.ceil(F.greatest(size, F.count_if(which) / BLOCK)), F.lit(0)).cast("int")

    counts = around.groupBy("centre").agg(blocks(outer).alias("outers"), blocks(~outer).alias("homes"), F.max("met").alias("most")).filter("outers > 0")
    rows = _met(around, counts, "centre", "met").withColumn("outer", outer)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("outer"), F.col("outers")).otherwise(F.col("homes"))).cast("int"))

    def units(n: Column, f: Callable[[Column], list[Column]]) -> Column:
        named = lambda k: F.struct(*(c.cast("int").alias(x) for c, x in zip(f(k), ("kind", "i", "j", "side"), strict=True)))
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), named)).otherwise(F.array())

    own, zero, one = F.col("own"), F.lit(0), F.lit(1)
    with_home = units(F.col("homes"), lambda k: [zero, own, k, zero])
    with_outer = units(F.col("outers"), lambda k: [one, F.least(own, k), F.greatest(own, k), (k < own).cast("int")])
    of_home = units(F.col("outers"), lambda k: [zero, k, own, one])
    placed = C.cut(rows.withColumn("units", F.when(F.col("outer"), F.concat(with_home, with_outer)).otherwise(of_home)).select("f1", "f2", "centre", "units", "node", "comp", "n"))
    dealt = sets(placed).join(placed, ["f1", "f2"]).select("centre", F.explode("units").alias("u"), "node", "comp", "n", "shingles")
    keyed = dealt.select("centre", "u.kind", "u.i", "u.j", "u.side", "node", "comp", "n", "shingles")
    return keyed.groupBy("centre", "kind", "i", "j").applyInArrow(_joined_blocks(percent), "a bigint, b bigint").distinct()


def connected(links: DataFrame) -> DataFrame:
    """``node, comp``: the smallest node reachable over the links ``a, b``, for nodes that have links."""
    edges = C.cut(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    n = edges.count()
    labels = C.cut(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("comp")), n)
    while True:
        seen = edges.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("low"))
        hooked = labels.join(seen, "node").select("node", F.col("comp").alias("was"), F.least("comp", "low").alias("comp"))
        # a root that has seen a smaller label takes it to all that point to it
        roots = hooked.groupBy(F.col("was").alias("root")).agg(F.min("comp").alias("lowest"))
        jumped = hooked.join(roots, hooked["was"] == roots["root"]).select("node", "was", F.least("comp", "lowest").alias("comp"))
        step = C.cut(jumped, n)
        labels = step.select("node", "comp")
        if not step.filter("was <> comp").limit(1).count():
            return labels


def _judged(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, percent: int = PERCENT, word_class: str = C.SPACE_CLASS) -> DataFrame:
    """What ``near_duplicates`` gives, and ``comp``: a number of the component that no other has (null without words)."""
    sketched = C.cut(sketches(docs, id_col, text_col, shingle, word_class))
    classes = sketched.filter("n > 0").groupBy("f1", "f2").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = C.cut(classes.withColumn("node", F.monotonically_increasing_id()))

    rows = nodes.select(F.explode("bands").alias("bucket"), "node")
    crowded = rows.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    crowds = C.cut(rows.join(crowded, "bucket").select("bucket", "node", "members"))
    scored = crowds.join(crowds.groupBy("node").agg(F.sum("members").alias("met")), "node")
    centres = scored.groupBy("bucket").agg(F.max(F.struct("met", "node")).alias("top"), F.max("members").alias("most")).select("bucket", F.col("top.node").alias("centre"), "top.met", "most")
    members = C.cut(_met(crowds, centres, "bucket", "members").filter("node <> centre"))

    def sets(wanted: DataFrame) -> DataFrame:
        return _sets(docs, text_col, wanted, shingle, word_class)

    links = C.cut(_verified(members.select("centre", "node", "met").distinct(), nodes, sets, percent))
    comps = connected(links)

    placed = members.filter("members > 2").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    homes = placed.groupBy("centre").agg(F.max("met").alias("most")).join(comps.withColumnRenamed("node", "centre").withColumnRenamed("comp", "home"), "centre", "left")
    placed = C.cut(_met(placed, homes.withColumn("home", F.coalesce("home", "centre")), "centre", "met"))
    split = placed.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.max("members").alias("most"))
    around = _met(placed, split.filter("low < high").select("bucket", "most"), "bucket", "members").select("centre", "node", "comp", "home", "met").distinct()
    around = C.cut(around.join(nodes.select("node", "f1", "f2", "n"), "node"))
    if around.limit(1).count():
        more = C.cut(_remaining(around, sets, percent))
        comps = connected(links.unionAll(more)) if more.limit(1).count() else comps

    rooted = C.cut(nodes.select("node", "f1", "f2", "id").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    ids = rooted.groupBy("comp").agg(F.min("id").alias("component"))
    by_set = rooted.join(ids, "comp").select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), "comp", "component")
    out = sketched.join(by_set, (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), "comp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, word_class: str = C.SPACE_CLASS) -> DataFrame:
    """One row for each document row: its id, ``text_key`` (a hash of its text), ``n_shingles``, ``component_id`` and ``kept``
    (whether the row has the component's id)."""
    return _judged(docs, id_col, text_col, shingle, percent, word_class).select(id_col, "text_key", "n_shingles", "component_id", "kept")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all their columns, one row of each component: that with the component's id (of several, one of them).
    Rows without words, and those without an id whose component has none, all stay but for repeated rows."""
    found = _judged(docs, id_col, text_col, **options).filter("kept").select(F.col(id_col).alias("id"), "text_key", "n_shingles", "comp")
    alone = (F.col("n_shingles") == 0) | F.col("id").isNull()
    times, key = C.fresh(docs, "times", "text_key")
    texts = found.groupBy("id", "text_key", "comp", F.when(alone, F.col("text_key")).alias("own")).agg(F.count("*").alias(times))
    first = texts.groupBy("id", "comp", "own").agg(F.min(F.struct("text_key", times)).alias("first")).select("id", "first.*")
    kept = C.matched(docs, first, id_col, text_col, "inner", times).withColumn(key, F.xxhash64(C.own(docs, text_col)))
    # only rows that are repeated have to meet, to leave one
    repeated = kept.filter(F.col(times) > 1).dropDuplicates([id_col, key])
    return kept.filter(F.col(times) == 1).unionAll(repeated).select(*(C.own(docs, c) for c in docs.columns))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(C.table(spark, sf_dir, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


QUERIES = {"op3_near_dedup": op3_near_dedup}

ORACLE_SQL = {
    "op3_near_dedup": """
    WITH RECURSIVE d AS (SELECT doc_id, {words} AS w FROM documents),
    s AS (
      SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS g FROM d, unnest(range(1, len(w))) AS t(i) WHERE len(w) >= 2
      UNION ALL SELECT DISTINCT doc_id, w[1] FROM d WHERE len(w) = 1
    ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id, doc_id AS seen FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.seen = e.a),
    m AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY 1)
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
    """.replace("{words}", C.SQL_SPACED)
}
