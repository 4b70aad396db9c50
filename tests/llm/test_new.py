"""The filter audit, packing and periodic runs, against slow versions and on odd data."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import common, filter_audit, mix, packing, runs, token_counts, url_filter

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice("a b c D É 日 x7".split(), rng.integers(1, 400))), "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(60, None, "en", "s0", 0), (61, "", "en", "s0", 0), (62, " \n\t", None, None, None), (None, "no id", "en", "s1", 0), (None, None, None, None, None)]
    rows += [(63, "the same #text", "en", "s1", 0)] * 3 + [(64, "the same #text", "en", None, 0), (65, "the same #text", "en", "", 0), (None, "the same #text", "en", "", 0)]
    rows += [(66, "go " * 60_000, "en", "s2", 0), (67, "z" * 100_000, "en", "s2", 0), (68, "A " * 300 + "<|endoftext|> b" + " " * 3000, "en", "s2", 0)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("n", "part", "subset", "flag", "before", "row", "key", "tie", "ids", "start", "runs", "mark", "A", "E", "digest", "id", "a.b"):
        df = df.withColumn(c, F.lit("mine"))
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---------------------------------------------------------------- filter audit


def audit_slowly(docs, labels):
    """By the definition: each order's filters one after another, over all documents."""
    fails, part, good, toxic = [], [], [], []
    first = {}
    for r in docs:
        if r.doc_id is not None:
            t = r.text or ""
            first[t] = min(first.get(t, r.doc_id), r.doc_id)
    for r in docs:
        t = r.text or ""
        w = SPACED.findall(t)
        own = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t))}
        own["E"] = r.doc_id is not None and first[t] < r.doc_id
        fails.append({f for f, bad in own.items() if bad})
        part.append(r.source or "")
        good.append(any(x.quality == 1 for x in labels if x.doc_id == r.doc_id and r.doc_id is not None))
        toxic.append(any(x.toxic == 1 for x in labels if x.doc_id == r.doc_id and r.doc_id is not None))
    out, shapley = {}, Counter()
    for p in set(part):
        for order in permutations("ABCDE"):
            left = [i for i, x in enumerate(part) if x == p]
            gone = []
            for step, f in enumerate(order, 1):
                lost = [i for i in left if f in fails[i]]
                out[p, "".join(order), step] = [len(left) - len(lost), len(lost), sum(f in fails[i] for i in gone), sum(fails[i] == {f} for i in range(len(part)) if part[i] == p), sum(good[i] for i in lost), sum(toxic[i] for i in lost)]
                shapley[p, f] += len(lost)
                left = [i for i in left if f not in fails[i]]
                gone += lost
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_slowly(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (2, 0, 1), (63, 1, 1), (64, 1, 0), (64, 0, 1), (None, 1, 1), (66, 1, 1), (999, 1, 1)], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(odd, labels).collect()
    want = audit_slowly(odd.select("doc_id", "text", "source").collect(), labels.collect())
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got} == want
    assert len(got) == len(want) == 600 * 4
    without = filter_audit.audit(odd).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(without) == (0, 0)
    assert filter_audit.audit(empty, labels).collect() == []


def test_survivors_by_subset(spark):
    counted = spark.createDataFrame([("p", True, False, 3), ("p", False, True, 5), ("p", False, False, 7), ("q", True, True, 2)], "part string, x boolean, y boolean, n long").withColumns({"good": F.lit(True), "toxic": F.col("x")})
    got = {(r.part, r.subset): (r.n, r.good, r.toxic) for r in filter_audit.survivors(counted, ["x", "y"]).collect()}
    assert got == {("p", 0): (15, 15, 3), ("p", 1): (12, 12, 0), ("p", 2): (10, 10, 3), ("p", 3): (7, 7, 0), ("q", 0): (2, 2, 2)}


# ---------------------------------------------------------------- packing


def test_curve_visits_neighbours():
    """Every cell once, each beside the one before it."""
    for dimensions, bits in ((2, 1), (2, 4), (3, 3), (4, 2)):
        cells = np.indices([1 << bits] * dimensions).reshape(dimensions, -1).T
        keys = packing.hilbert(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def check_packed(pieces, docs, encode, width):
    """The pieces hold each document's ids exactly once and fill their sequences without gaps; no padding is needed."""
    rows, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        rows[p.row].append(p)
        sequences[p.sequence_id].append(p)
    got = Counter()
    for held in rows.values():
        held.sort(key=lambda p: p.start)
        assert [p.start for p in held] == np.cumsum([0, *(p.length for p in held)])[:-1].tolist()
        ids = b"".join(bytes(p.ids) for p in held)
        assert all(p.length > 0 and p.doc_tokens == len(ids) // 4 for p in held)
        got[held[0].doc_id, ids] += 1
    assert got == Counter((r.doc_id, np.array([*encode(r.text or ""), 1], "<u4").tobytes()) for r in docs)
    assert sorted(sequences) == list(range(len(sequences)))
    for held in sequences.values():
        held.sort(key=lambda p: p.offset)
        assert [p.offset for p in held] == np.cumsum([0, *(p.length for p in held)])[:-1].tolist()
        size = sum(p.length for p in held)
        assert size == width or (size < width and size & (size - 1) == 0)


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(str(public.path("byte_bpe_50k.json")))


@pytest.mark.parametrize("width", [2048, 64, 100])
def test_packed_once(odd, tokenizer, width, monkeypatch):
    monkeypatch.setattr(packing, "RANGE_ROWS", 20)  # several ranges
    pieces = packing.pack(odd, width=width)
    check_packed(pieces.collect(), odd.select("doc_id", "text").collect(), lambda t: tokenizer.encode(t, add_special_tokens=False).ids, width)


def test_shuffled_places_agree(odd, monkeypatch):
    whole = sorted((r.sequence_id, r.offset, r.length) for r in packing.pack(odd).collect())
    monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)
    assert sorted((r.sequence_id, r.offset, r.length) for r in packing.pack(odd).collect()) == whole


def test_packing_query(spark, tokenizer):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen = Counter()
    for r in packing.op12_packing(spark, SF).collect():
        ids = np.array([*tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
        seen[r.doc_id] += r.length
    assert seen == {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in docs.items()}


def test_sequences_hold_their_pieces(odd):
    pieces = packing.pack(odd, width=128)
    total = pieces.agg(F.sum("length")).first()[0]
    held = packing.sequences(pieces).collect()
    assert sum(r.length for r in held) == total and all(len(r.ids) == 4 * r.length and r.length <= 128 for r in held)


def test_neighbours_share_words(spark):
    """Along the curve, documents stand beside ones with the same words far more often than by chance."""
    rng = np.random.default_rng(8)
    words = np.array([f"word{k}" for k in range(4000)])
    topics = [words[rng.integers(0, 4000, 60)] for _ in range(20)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(topics[i % 20], 150)), None, None, 0) for i in range(400)], DOCS)
    order = [r.doc_id % 20 for r in packing.pack(docs, width=1 << 30).orderBy("sequence_id", "offset").collect() if r.start == 0]
    assert len(order) == 400 and np.mean([a == b for a, b in zip(order[:-1], order[1:], strict=True)]) > 0.4


def test_nothing_to_pack(empty):
    assert packing.pack(empty).collect() == []
    assert packing.bounds(0, 2048)[0] == 0 and packing.bounds(2048 * 3 + 5, 2048)[1].tolist() == [6144, 6148, 6149]


# ---------------------------------------------------------------- runs


def runs_slowly(w, least):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s >= q and i - s + q >= least:
                found.setdefault((s, i + q), q)  # the smallest period comes first
    return sorted((s, e, q) for (s, e), q in found.items())


def strings(rng, n_trials):
    for trial in range(n_trials):
        k, n = rng.integers(1, 4), rng.integers(1, 90)
        w = rng.integers(0, k, n)
        if trial % 4 == 1:
            w = np.tile(w[: rng.integers(1, 12)], 40)[:n]
        elif trial % 4 == 2:
            b = rng.integers(0, 2, rng.integers(1, 15))
            w = np.concatenate([b, b, rng.integers(0, 2, 3), b, b, b, rng.integers(0, 2, 2), b, b])
        elif trial % 4 == 3:
            w = np.concatenate([w, w[: n // 2], w, w])
            w[rng.integers(len(w))] = rng.integers(k)
        yield w


@pytest.mark.parametrize("least", [12, 6])
def test_runs_slowly(least, monkeypatch):
    monkeypatch.setattr(runs, "PAIRS", 37)
    for w in strings(np.random.default_rng(least), 1500):
        assert sorted(map(tuple, runs.find_runs(np.append(w, 10**6), least).tolist())) == runs_slowly(w.tolist(), least), w.tolist()


def test_lz_blocks_and_factors():
    for w in strings(np.random.default_rng(7), 300):
        text = [*w.tolist(), -1]
        size, source = runs.previous_factors(runs.doubled_ranks(np.append(w, 10**6)))
        for i in range(len(text)):
            shared = [next(m for m in range(len(text)) if i + m >= len(text) - 1 or text[j + m] != text[i + m]) for j in range(i)]
            assert size[i] == max(shared, default=0) and (size[i] == 0 or shared[source[i]] == size[i])
        border = runs.blocks(size)
        assert border[0] == 0 and border[-1] == len(text) and (np.diff(border) == np.maximum(size[border[:-1]], 1)).all()


def report_slowly(doc_id, text, plant):
    w = SPACED.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if plant and doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    found = runs_slowly(w, 12)
    found.sort(key=lambda r: (r[0], r[2]))
    dropped = {i for s, e, q in found for i in range(s + q, e)}
    best = max(((e - s, -s, -q) for s, e, q in found), default=None)
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    top = (-best[1], best[0], -best[2], 1000 * best[0] // -best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_query(spark):
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect() if len(r.text or "") < 8000]
    got = {r.doc_id: tuple(r) for r in runs.op13_periodic_runs(spark, SF).collect()}
    want = [report_slowly(r.doc_id, r.text, True) for r in docs]
    assert len(want) > 150 and sum(w[1] > 0 for w in want) > 15
    assert [got[w[0]] for w in want] == want


def test_runs_on_odd_data(odd, empty, spark):
    got = Counter((r.doc_id, tuple(map(tuple, r.runs)), r.n_words, r.collapsed) for r in runs.periodic_runs(odd).collect())
    want = Counter()
    for r in odd.select("doc_id", "text").collect():
        w = SPACED.findall(r.text or "")
        if len(w) > 10_000:
            assert set(w) == {"go"}
            want[r.doc_id, ((0, len(w), 1),), len(w), "go"] += 1
            continue
        found = runs_slowly(w, 12)
        dropped = {i for s, e, q in found for i in range(s + q, e)}
        want[r.doc_id, tuple(sorted((s, e - s, q) for s, e, q in found)), len(w), " ".join(x for i, x in enumerate(w) if i not in dropped)] += 1
    assert got == want
    assert runs.periodic_runs(empty).collect() == []
    case = spark.createDataFrame([(1, "Go go " * 6, None, None, 0)], DOCS)
    assert [tuple(r) for r in runs.periodic_runs(case).first().runs] == [(0, 12, 2)]


def test_long_repetitions_are_quick():
    """A text of a million words in one period, and one of two letters at random."""
    w = np.tile(np.arange(1000), 300)
    assert runs.find_runs(np.append(w, 10**7)).tolist() == [[0, 300_000, 1000]]
    fibonacci = [0], [0, 1]
    while len(fibonacci[1]) < 50_000:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    found = runs.find_runs(np.append(np.array(fibonacci[1]), 10**7))
    assert len(np.unique(found[:, :2], axis=0)) == len(found) > 10_000


def test_special_token_is_read_as_the_library_does(tokenizer):
    with open(token_counts.VOCABULARY, "rb") as f:
        raw = f.read()
    for text in ("a<|endoftext|>b", "<|endoftext|><|endoftext|>", " x  <|endoftext|>  \n\n y", "ab  \t\n" * 50 + " " * 2500 + "<|endoftext|>" + "\n" * 1500 + "z", "<|endoftext|"):
        assert packing.encoded(text, raw).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_targets_of_many_sources(spark, monkeypatch):
    """Turns in several ranges and levels that need rounds, against filling up one source after another."""
    monkeypatch.setattr(common, "ROWS_A_PARTITION", 50)
    rng = np.random.default_rng(3)
    sizes = {f"s{i:03}": int(v) for i, v in enumerate(np.exp(rng.uniform(0, 16, 300)))} | {None: 7, "": 0}
    units = spark.createDataFrame([(k, v, 1) for k, v in sizes.items()], "source string, size long, rows long")
    for share, most in ((1.5, 2.0), (0.3, 2.0), (3.0, 2.0), (2.0, 2.0)):
        got = {r.source: (r.source_size, r.target) for r in mix.source_targets(units, share=share, most=most).collect()}
        order = sorted(sizes, key=lambda k: (k is None, k or ""))
        weight = {k: mix.WEIGHTS[i % 3] for i, k in enumerate(order)}
        left, weights, want = share * sum(sizes.values()), sum(weight.values()), {}
        for k in sorted(sizes, key=lambda k: most * sizes[k] / weight[k]):
            want[k] = min(most * sizes[k], left * weight[k] / weights)
            left, weights = left - want[k], weights - weight[k]
        assert {k: v for k, (v, _) in got.items()} == sizes
        assert all(got[k][1] == pytest.approx(want[k], rel=1e-9) for k in sizes)
    named = spark.createDataFrame([(1, "a b", "x")], "`id.of` long, `te.xt` string, `so.urce` string")
    assert mix.mixed_rows(named, "id.of", "te.xt", "so.urce").columns == named.columns
    pages = spark.createDataFrame([(1, "http://example.com/en/x")], "`id.of` long, `u.rl` string")
    assert url_filter.judge_urls(pages, id_col="id.of", url_col="u.rl").count() == 1
