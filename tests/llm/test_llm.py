"""The training-data operators on small fixtures, against brute force; odd inputs; the pipeline."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import ann, common, decontaminate, language_id, license_scan, lm_score, mix, near_dedup, shard, token_counts, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans(common.UPPER, common.UPPER.lower())
WORDS = "the of license token copy mit apache general public über straße niño été don 7th x".split()


def words(text, word_class=common.WORD_CLASS):
    return re.findall(word_class, (text or "").translate(LOWER))


def documents(spark, rows, extra=False):
    df = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOCS)
    if extra:  # names that operators use themselves
        for c in ("rid", "n_words", "h", "hash", "size", "target", "shard", "slot", "node", "score", "__key", "id", "n", "key", "copies"):
            df = df.withColumn(c, F.lit("mine"))
    return df


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(WORDS, rng.integers(1, 60))), ["en", "de"][i % 2], f"s{i % 3}") for i in range(40)]
    rows += [(40, None, "en", "s0"), (41, "", "de", None), (42, "   \n", None, "s1"), (None, "no id at all", "en", "s1"), (None, None, None, None)]
    rows += [(43, "The MIT License. Apache license; GENERAL public license", "en", "s2")] * 3  # repeated rows
    rows += [(44, "same text twice", "en", "s2"), (45, "same text twice", "en", "s2"), (46, "\x00\t¿?\u00a0日本語 " * 3, "xx", "s2"), (47, "word " * 60_000, "en", "s0"), (48, "z" * 100_000, "en", "s0")]
    return documents(spark, rows, extra=True)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def texts_of(df):
    return [(r.doc_id, r.text, r.source, r.lang) for r in df.select("doc_id", "text", "source", "lang").collect()]


# ---------------------------------------------------------------- common


def test_tokenising_is_the_regex():
    texts = ["Hello, World éÉ 12x", "", None, "a b a b", "x" * 300, "tail ", " head", "Ünï-cödé\u2003wide"]
    for word_class in (common.WORD_CLASS, common.SPACE_CLASS):
        for most in (4, 1 << 20):
            got, hashes = [], {}
            for _, _, data, at in common.chunks(pa.array(texts), most):
                t = common.tokenize(data, at, word_class)
                for a, z in zip(t.first[:-1], t.first[1:], strict=True):
                    got.append(t.words(a, z).split(" ") if z > a else [])
                    for w, h in zip(got[-1], t.hash[a:z].tolist(), strict=True):
                        assert hashes.setdefault(w, h) == h
            assert got == [words(x, word_class) for x in texts]
            assert len(set(hashes.values())) == len(hashes)


def test_long_spans_hash_alike(monkeypatch):
    data = np.frombuffer(("ab cd " * 50).encode(), np.uint8)
    whole = common.tokenize(data, np.array([0, len(data)]), common.SPACE_CLASS).hash
    monkeypatch.setattr(common, "CHUNK_BYTES", 7)
    assert (common.tokenize(data, np.array([0, len(data)]), common.SPACE_CLASS).hash == whole).all()


def test_bitmap(spark):
    values = np.random.default_rng(0).integers(-(1 << 63), 1 << 63, 500)
    bits = common.hash_bitmap(spark.createDataFrame([(int(v),) for v in values], "h long"), "h", 1 << 20)
    assert common.in_bitmap(bits, values.view(np.uint64)).all() and int(np.unpackbits(bits).sum()) <= 500
    assert not common.hash_bitmap(spark.createDataFrame([], "h long"), "h", 1 << 20).any()


# ---------------------------------------------------------------- 1 decontamination


def contaminated(docs, bench, width=13):
    windows = {}
    for item, text in bench:
        w = words(text)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for i, text, *_ in docs:
        w, hit, items = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    items |= {str(x) for x in found if x is not None}
        out.append((i, len(w), len(hit), ",".join(sorted(items)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_decontamination(spark, odd, empty, monkeypatch):
    sample = [t for _, t, *_ in texts_of(odd) if t and 5 < len(words(t)) < 1000]
    long = " ".join(words(sample[0]) + words(sample[1]))
    bench = [(1, long), (2, sample[2]), (10, sample[2].upper()), (3, "mit"), (4, "license token"), (5, ""), (6, None), (None, sample[3]), (2, sample[2])]
    bench_df = spark.createDataFrame(bench, "item_id long, text string")
    want = contaminated(texts_of(odd), bench)
    for most in (100_000, 0):  # broadcast and shuffled
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", most)
        got = decontaminate.decontaminate(odd, bench_df).collect()
        assert sorted([(r.doc_id, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in got], key=str) == want
        assert all(sum(s.end - s.start for s in r.spans) == r.n_hit for r in got)
    kept = decontaminate.remove_contaminated(odd, bench_df)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(w[0]) for w in want if not w[4])
    assert decontaminate.decontaminate(empty, bench_df).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(odd, none).filter("n_hit > 0 OR contaminated").count() == 0


# ---------------------------------------------------------------- 2 mixing


def targets(sizes):
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    left, full = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in sizes if s not in full]
        share = {s: left * weights[s] / sum(weights[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = 2.0 * sizes[s]
            left -= full[s]


def test_mixing(spark, odd, empty):
    rows = texts_of(odd)
    size = lambda t: len(words(t, common.SPACE_CLASS))
    sizes = Counter()
    for _, t, s, _ in rows:
        sizes[s] += size(t)
    want = targets(sizes)
    got = mix.mix_sources(odd).collect()
    assert sum(r.rows for r in got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] and 0 <= r.copies <= 2 * r.rows
        taken[r.source] += r.copies * r["size"]
    for s in sizes:
        assert abs(taken[s] - want[s]) < max(size(t) for _, t, x, _ in rows if x == s) + 1e-6
    again = mix.mix_sources(odd.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    mixed = mix.mixed_rows(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.copies for r in got)
    assert mix.mix_sources(empty).count() == 0 and mix.mixed_rows(empty).count() == 0


def test_mixing_keeps_expectations(spark):
    rows = [(i, "w " * (1 + i % 9), "en", "a") for i in range(300)] + [(1000 + i, "w " * 5, "en", "b") for i in range(40)]
    docs = documents(spark, rows)
    runs = [{r.doc_id: (r.copies, r.target / r.source_size) for r in mix.mix_sources(docs, seed=s).collect()} for s in range(6)]
    for run in runs:
        assert all(math.floor(c - 1e-9) <= n <= math.ceil(c + 1e-9) for n, c in run.values())
    mean = np.mean([[run[i][0] for i in range(300)] for run in runs])
    assert mean == pytest.approx(runs[0][0][1], abs=0.02)


# ---------------------------------------------------------------- 3 near duplicates


def components(rows, k, percent=80):
    sets = []
    for _, t, *_ in rows:
        w = words(t, common.SPACE_CLASS)
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = {}
    for x in range(len(rows)):
        groups.setdefault(find(x), []).append(rows[x][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted([(r[0], len(sets[x]), least[find(x)], r[0] == least[find(x)]) for x, r in enumerate(rows)], key=str)


def near_copies(seed, n):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = rng.choice(vocabulary, 120)
    rows = []
    for i in range(n):
        w = base.copy() if i % 3 else rng.choice(vocabulary, 60)
        at = rng.choice(len(w), rng.integers(0, 16), replace=False)
        w[at] = rng.choice(vocabulary, len(at))
        rows.append((i, " ".join(w), "en", "s"))
    return rows


@pytest.mark.parametrize("k", [1, 2, 5])
def test_near_duplicates(spark, odd, empty, k, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 1 << 15)
    for docs in (odd, documents(spark, near_copies(k, 90))):
        got = near_dedup.near_duplicates(docs, shingle=k).collect()
        assert sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got], key=str) == components(texts_of(docs), k)
    assert near_dedup.near_duplicates(empty).count() == 0


def test_one_of_each(spark, odd, empty):
    kept = near_dedup.one_of_each(odd)
    ids = Counter(r.doc_id for r in kept.collect())
    assert kept.columns == odd.columns and ids[43] == 1 and ids[44] == 1 and ids[45] == 0 and ids[40] == 1 and ids[None] == 2
    assert near_dedup.one_of_each(empty).count() == 0


def test_one_of_each_of_a_shared_id(spark):
    rows = [(7, f"{w} " * 3 + " ".join(f"{w}{i}" for i in range(30)), "en", "s") for w in ("alpha", "beta", "gamma")]
    rows += [rows[0], (7, rows[1][1] + " more", "en", "s"), (9, rows[2][1], "en", "s")]  # repeated, nearly the same, the same
    kept = near_dedup.one_of_each(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.text.split()[0]) for r in kept) == [(7, "alpha"), (7, "beta"), (7, "gamma")]


def test_estimates_and_merging():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 63, 900, dtype=np.uint64) * np.uint64(2))
    b = np.unique(np.concatenate((a[:700], rng.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2) + np.uint64(1))))
    r = near_dedup.set_registers(np.concatenate((a, b)), np.array([0, len(a)]))
    union = np.union1d(a, b)
    assert (near_dedup.merge(r[0], r[1]) == near_dedup.set_registers(union, np.array([0]))[0]).all()
    j = near_dedup.likeliest_jaccard(np.array([(r[0] > r[1]).sum()]), np.array([(r[0] < r[1]).sum()]), np.array([len(a)]), np.array([len(b)]))
    assert abs(j[0] - len(np.intersect1d(a, b)) / len(union)) < near_dedup.MARGIN


# ---------------------------------------------------------------- 4 licenses


def test_licenses(spark, odd, empty):
    phrases = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
    want = []
    for i, t, *_ in texts_of(odd):
        w = words(t)
        found = sorted((k, label) for label, p in phrases.items() for k in range(len(w)) if w[k : k + len(p)] == p)
        want.append((i, len(w), found))
    got = license_scan.license_spans(odd).collect()
    assert sorted([(r.doc_id, r.n_words, sorted((s.start, s.label) for s in r.spans if s.phrase)) for r in got], key=str) == sorted(want, key=str)
    assert license_scan.license_spans(empty).count() == 0


def test_license_passages(spark):
    bsd = next(t.text for t in license_scan.PASSAGES if t.label == "bsd").split()
    dropped, swapped, half = bsd[:9] + bsd[10:], bsd[:5] + ["zzz"] + bsd[6:], bsd[:6]
    docs = documents(spark, [(i, " ".join(["lorem", "ipsum"] + w + ["dolor"]), "en", "s") for i, w in enumerate((bsd, dropped, swapped, half))])
    got = {r.doc_id: [(s.label, s.start, s.end) for s in r.spans] for r in license_scan.license_spans(docs).collect()}
    assert got[0] == [("bsd", 2, 2 + len(bsd))] and got[1] == [("bsd", 2, 1 + len(bsd))] and got[2] == [("bsd", 2, 2 + len(bsd))] and got[3] == []


# ---------------------------------------------------------------- 5 languages


def tongue(rng, lang, n):
    syllables = {"en": "th er in ing ed ly wh st an".split(), "de": "sch ein ung keit ge ach zu ö ä".split(), "fr": "eau ou é è ai qu eux re ç".split()}[lang]
    return " ".join("".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(n))


def test_languages(spark, odd, empty):
    rng = np.random.default_rng(1)
    rows = [(i, tongue(rng, lang, 40), lang, "s") for i, lang in enumerate(["en", "de", "fr"] * 80)]
    docs = documents(spark, rows)
    models = language_id.train(language_id.learned_from(docs))
    assert [m.lang for m in models] == ["de", "en", "fr"]
    found = {r.doc_id: r for r in language_id.identify(docs, models).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert sum(found[r[0]].lang_pred == r[2] for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 and not r.rejected for r in found.values())
    judged = {r.doc_id: r for r in language_id.identify(odd, models).collect()}
    for i in (40, 41, 42):
        assert judged[i].lang_pred == "und" and judged[i].score == 0 and judged[i].rejected
    foreign = language_id.identify(documents(spark, [(0, "жщю яыэ " * 40, None, None)]), models).first()
    assert foreign.rejected and foreign.lang_pred != "und"
    kept = language_id.accepted(docs.unionByName(documents(spark, [(999, "12 34", "en", "s")])))
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert language_id.train(empty) == [] and language_id.identify(empty, []).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd, []).collect()} == {"und"}
    assert language_id.identify(odd, models).count() == odd.count()


def test_languages_of_long_texts_alone(spark):
    rng = np.random.default_rng(2)
    docs = documents(spark, [(i, tongue(rng, lang, n), lang, "s") for i, (lang, n) in enumerate([("en", 20), ("fr", 400)] * 30)])
    models = language_id.train(docs, longest=400)
    assert [m.lang for m in models] == ["en", "fr"]
    assert {r.lang_pred for r in language_id.identify(docs.filter("lang = 'fr'"), models).collect()} == {"fr"}


def test_kneser_ney_sums_to_one():
    data = np.frombuffer(b"the cat sat on the mat the end", np.uint8)
    m = language_id.Model("x", 0.0, *language_id.fit(*language_id.symbols(data, np.array([0, len(data)]))))
    alphabet = sorted(set(data.tolist()))
    total = 0.0
    for c in alphabet:
        text = b"the ca" + bytes([c])
        s, first = language_id.symbols(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        gram, context = language_id.hashes(s, first)
        p = np.full(1, 1 / language_id.ALPHABET)
        for o in range(language_id.ORDER):
            p = language_id._found(m.grams[o], m.direct[o], gram[o][-1:], 0) + language_id._found(m.contexts[o], m.lower[o], context[o][-1:], 1) * p
        total += float(p[0])
    assert 0.97 < total <= 1 + 1e-6  # the rest is for symbols that weren't seen


# ---------------------------------------------------------------- 6 URLs


def globbed(pattern, url):
    out = re.escape(pattern).replace(r"\*\*", "<any>").replace(r"\*", "[^/]*").replace(r"\?", ".").replace("<any>", ".*")
    return re.fullmatch(out.encode(), url.encode(), re.S) is not None


def test_automaton_is_globbing():
    rng = np.random.default_rng(2)
    globs = ["**a**b", "*.x/**", "a?c/*", "", "**", "*", "?" * 70 + "**", "ab/c" * 20, "**" + "ab" * 40 + "*"]
    urls = ["", "abc/", "a.x/y", "é" * 40, "ab/c" * 20, "q" + "ab" * 40] + ["".join(rng.choice(list("abcx./"), rng.integers(0, 90))) for _ in range(200)]
    raw = [u.encode() for u in urls]
    found = url_filter.Automaton(globs).match(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
    for u, row in zip(urls, found, strict=True):
        assert [globbed(g, u) for g in globs if "?" not in g or u.isascii()] == [bool(x) for g, x in zip(globs, row, strict=True) if "?" not in g or u.isascii()], u


def test_url_rules(spark):
    urls = ["http://WWW.Example.com/en/1?x#y", "https://a.example.com/en/", "http://example.com", "ftp://net/es/1", "x://b.net/fr/", "//no", None, "", "a://evil.org/x.example.com/en/", "http://cheap-pills.org/", "http://notcom/", "a://b.com/?q=http://c.net/es/", "http://" + "h" * 5000 + ".net/fr/"]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)] + [(0, urls[0], "mine")], "page_id long, url string, host string")
    got = sorted((r.page_id, r.host if len(r.host) < 99 else "long", r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect())
    assert got == [
        (0, "www.example.com", "/en/1", "www.example.com/en/", "allow"), (0, "www.example.com", "/en/1", "www.example.com/en/", "allow"), (1, "a.example.com", "/en/", "example.com/en/", "block"), (2, "example.com", "", None, "allow"),
        (3, "net", "/es/1", "net/es/", "block"), (4, "b.net", "/fr/", "net/fr/", "block"), (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "", "", None, "allow"),
        (8, "evil.org", "/x.example.com/en/", None, "allow"), (9, "cheap-pills.org", "/", None, "block"), (10, "notcom", "/", None, "allow"), (11, "b.com", "/", "com/", "allow"), (12, "long", "/fr/", "net/fr/", "block"),
    ]
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


# ---------------------------------------------------------------- 7 neighbours


def nearest(rows, top):
    rows = sorted(rows)
    x = np.array([v for _, v in rows], float)
    out = []
    for i, v in rows:
        if i % 20 == 0:
            s = np.einsum("d,cd->c", np.array(v, float), x)
            ranked = sorted((-score, j) for (j, _), score in zip(rows, s, strict=True) if j != i)[:top]
            out += [(i, k + 1, j, -score) for k, (score, j) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("scaled", [False, True])
def test_neighbours(spark, scaled):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 24)) + 2 * rng.normal(size=(8, 24))[rng.integers(0, 8, 400)]
    x /= np.linalg.norm(x, axis=1)[:, None]
    if scaled:
        x *= rng.uniform(0.5, 3, 400)[:, None]
    x[50:60] = x[40]  # equal vectors
    rows = [(i, v.astype(np.float32).astype(float).tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1020, [0.0] * 24), (1040, [float("nan")] + [1.0] * 23), (1060, [None] + [1.0] * 23), (1080, [1.0] * 5), (None, [1.0] * 24), (40, rows[40][1]), (1100, [float("inf")] * 24), (1120, [])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    query = F.col("id") % 20 == 0
    want = nearest(rows, 20)
    scores = {(q, v): x for q, _, v, x in nearest(rows, 400)}
    for options in ({}, {"block": 64}, {"block": 64, "bucket_size": 4}):  # one axis a bucket, and several
        got = sorted(map(tuple, ann.neighbours(df, query, **options).collect()))
        assert len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}) >= 0.9 * len(want)
        assert [g[:2] for g in got] == [w[:2] for w in want] and all(abs(scores[q, v] - x) < 1e-12 for q, _, v, x in got)
        assert got == sorted((q, k + 1, v, x) for q in {g[0] for g in got} for k, (_, v, x) in enumerate(sorted((-x, v, x) for p, _, v, x in got if p == q)))
    few = spark.createDataFrame(rows[:5], "vec_id long, embedding array<float>")
    assert ann.neighbours(few, query).count() == 4
    assert ann.neighbours(few.limit(0), query).count() == 0


def reached(spark, x, **options):
    """The share of the true neighbours of every 200th vector that is found."""
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id) for r in ann.neighbours(df, F.col("id") % 200 == 0, **options).collect()}
    asked = np.arange(0, len(x), 200)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    want = {(int(i), int(j)) for i, row in zip(asked, np.argsort(-score, axis=1)[:, :20], strict=True) for j in row}
    return len(got & want) / len(want)


@pytest.mark.parametrize(("axes", "dimensions", "unit"), [(1, 64, 6144), (2, 64, 6144), (2, 64, 100), (3, 14, 500), (None, 64, 6144)])
def test_neighbours_by_axes(spark, monkeypatch, axes, dimensions, unit):
    """One, two and three axes a bucket, in one unit and many: recall, and the share of all vectors that a query is ranked
    against.  None: the number of axes by cost."""
    seen, met, taken, needed, cost = [], ann._met, [], ann.needed, ann.Range.cost

    def counted(inside, asked, *a):
        probed = asked.select("t", F.explode("buckets").alias("bucket"))
        seen.append(inside.select("t", F.col("buckets")[0].alias("bucket")).join(probed, ["t", "bucket"]).count())
        return met(inside, asked, *a)

    monkeypatch.setattr(ann, "_met", counted)
    monkeypatch.setattr(ann, "UNIT_BYTES", unit * 8 * dimensions)
    monkeypatch.setattr(ann, "needed", lambda q, x, of: taken.append((of.k, needed(q, x, of))) or taken[-1][1])
    monkeypatch.setattr(ann.Range, "cost", lambda of, n: cost(of, n) if axes is None else abs(of.k - axes))
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6000, dimensions)) + 0.8 * rng.normal(size=(200, dimensions))[rng.integers(0, 200, 6000)]
    x /= np.linalg.norm(x, axis=1)[:, None]
    recall = reached(spark, x, **({"bucket_size": 16} if axes == 3 else {}))
    print(f"axes and probes {taken}, recall {recall:.3f}, met {seen[0] / (30 * 6000):.3f} of all pairs, copies counted")
    assert recall >= 0.9 and [k for k, _ in taken] == ([2, 3] if axes == 3 else [1, 2])
    assert axes is not None or seen[0] < 0.25 * 30 * 6000


def test_short_lists_are_filled(spark, monkeypatch):
    monkeypatch.setattr(ann, "needed", lambda *a: 1)  # as if nearly nothing had to be probed
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 16)))], "vec_id long, embedding array<double>")
    assert ann.neighbours(df, F.col("id") % 20 == 0, tables=1).count() == 15 * 20


def test_neighbours_beside_a_long_vector(spark, monkeypatch):
    taken, needed = [], ann.needed
    monkeypatch.setattr(ann, "needed", lambda *a: taken.append(needed(*a)) or taken[-1])
    rng = np.random.default_rng(7)
    x = rng.normal(size=(5000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[1] *= 10
    assert reached(spark, x) >= 0.9
    alone, _, others, _ = taken  # with one axis and with two: the probes in the range of the long vector, and in that of the others
    assert alone < 64 and others <= 20  # by direction, not by nearly all 256 buckets


# ---------------------------------------------------------------- 8 language model


def tokens_of(text):
    return words(text, common.SPACE_CLASS) + [None]


def training(c="doc_id"):
    return F.crc32(F.col(c).cast("string")) % 5 != 1


def is_training(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 != 1


def test_scores(spark, odd, empty):
    rows = texts_of(odd)
    c = Counter(w for i, t, *_ in rows if is_training(i) for w in tokens_of(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((i, len(tokens_of(t)), sum(c[w] > 0 for w in tokens_of(t)), sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens_of(t))) for i, t, *_ in rows), key=str)
    near = lm_score.score(odd, training()).collect()
    for found in (near, lm_score.score(odd.repartition(6), training(), part_bytes=1 << 12).collect()):  # one part, and many
        got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in found), key=str)
        assert [g[:3] for g in got] == [w[:3] for w in want] and {r.train_tokens for r in found} == {n}
        assert np.allclose(sorted(g[3] for g in got), sorted(w[3] for w in want), rtol=1e-9)
        assert sorted(round(r.score, 2) for r in found) == pytest.approx(sorted(round(r.score, 2) for r in near), rel=1e-3)
    assert all(r.score < 0 and r.bits_per_byte > 0 for r in near)
    assert lm_score.score(empty, training()).count() == 0
    even = lm_score.score(odd.filter("doc_id = 41"), F.lit(False)).first()
    assert even.base_score == 0 and even.train_tokens == 0 and even.bits == pytest.approx(lm_score.LENGTH[lm_score.END], rel=1e-5)


def slow_bits(rows, first):
    """Bits of each text, decision by decision.  ``rows``: text, whether it is learned from; ``first``: first weights of spelling."""
    L = lm_score
    word_hash = lambda w: int(L.END_HASH if w is None else common.tokenize(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]), common.SPACE_CLASS).hash[0]) & 0xFFFF
    with_context = lambda text: [(tuple((["<s>"] * L.CONTEXT + tokens_of(text))[k : k + L.CONTEXT]), w) for k, w in enumerate(tokens_of(text))]
    follow, told, spelt = {}, {}, {}
    for text, learn in rows:
        for c, w in with_context(text) if learn else []:
            follow.setdefault(c, Counter())[w] += 1

    def best(counts):
        return min(counts, key=lambda w: (-counts[w], word_hash(w)))

    def kind(counts, expected):
        top, rest = counts[expected], sum(counts.values()) - counts[expected]
        return sum(top >= x for x in L.TOPS) * (len(L.RESTS) + 1) + sum(rest >= x for x in L.RESTS)

    for counts in follow.values():
        for w, n in counts.items():
            left = counts - Counter([w])
            if left:
                expected = best(counts) if left[best(counts)] == max(left.values()) else max(left, key=left.get)
                told.setdefault(kind(left, expected), [0, 0])[w == expected == best(counts)] += n
    trust = {k: math.log((y + L.PRIOR) / (x + L.PRIOR)) for k, (x, y) in told.items()}

    def decided(word):  # per decision: keys by predictor, branch, gate
        raw = bytes([L.END]) if word is None else word.encode() + bytes([L.GAP])
        for place, byte in enumerate(raw):
            for s in range(L.BEGIN[byte], L.BEGIN[byte + 1]):
                yield [(o, raw[max(0, place - n) : place], int(L.NODE[s])) for o, n in enumerate((*L.ORDERS, 1 << 30))], int(L.TURN[s]), min(place, 1)

    for w, n in sum(follow.values(), Counter()).items():
        for keys, turn, _ in decided(w):
            for key in keys:
                spelt.setdefault(key, [0, 0])[turn] += n

    def odds(key):
        zero, one = spelt.get(key, (0, 0))
        return round((math.log(one + L.PRIOR) - math.log(zero + L.PRIOR)) / L.ODDS_UNIT) * L.ODDS_UNIT

    class Slow:
        def __init__(self, weights, damping):
            self.weights, self.damping, self.levels = np.array(weights, float), damping, np.zeros((L.LEVELS, 2))

        def code(self, decisions):  # of one stretch: log-odds for what came, gate
            bits, steps, curves, moved = 0.0, np.zeros(self.weights.shape), np.zeros(self.weights.shape[1]), np.zeros((L.LEVELS, 2))
            for x, gate in decisions:
                o = float(self.weights[:, gate] @ x)
                likely, level = 1 / (1 + math.exp(-abs(o))), min(int(abs(o)), L.LEVELS - 1)
                error, count = self.levels[level]
                final = (likely + min(max(likely + error / (count + L.CALM), L.CERTAIN), 1 - L.CERTAIN)) / 2 if o else 0.5
                bits -= math.log2(final if o > 0 else 1 - final)
                missed = 1 - likely if o > 0 else likely
                steps[:, gate] += np.array(x) * missed
                curves[gate] += missed * (1 - missed)
                moved[level] += ((o > 0) - likely, 1)
            self.weights += L.RATE * steps / (L.CURVE * curves + self.damping)
            self.levels += moved
            return bits

    out = []
    for text, _ in rows:
        spelling, trusting = Slow(first, L.DAMPING), Slow([[1.0] * 3, [0.0] * 3, [0.0] * 3], L.TRUST_DAMPING)
        total, at, size, before, places = 0.0, 0, L.FIRST_STRETCH, 0, with_context(text)
        while at < len(places):
            trusted, bytewise = [], []
            for c, w in places[at : at + size]:
                gate, before = before, 0
                if c in follow:
                    expected = best(follow[c])
                    k, hit = kind(follow[c], expected), w == expected
                    sign, top, rest = 1 if hit else -1, L.TOP_OF[k // 4], L.REST_OF[k % 4]
                    trusted.append(([sign * trust.get(k, 0.0), sign * math.log((top + 0.5) / (rest + 0.5)), sign], gate))
                    before = 1 + hit
                    if hit:
                        continue
                bytewise += [([odds(key) * (1 if turn else -1) for key in keys], gate) for keys, turn, gate in decided(w)]
            total += trusting.code(trusted) + spelling.code(bytewise)
            at, size = at + size, min(2 * size, L.LONGEST_STRETCH)
        out.append(total)
    return out


def test_scores_decision_by_decision(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vocabulary = "ab abc an and ant bad ä x".split()
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 70)))) for i in range(40)]
    rows += [(50, rows[3][1]), (51, rows[4][1]), (52, None), (53, "new words here"), (54, "AB abc " * 30)]
    kept, learned = [], lm_score._learned
    monkeypatch.setattr(lm_score, "_learned", lambda *a: kept.append(learned(*a)) or kept[-1])
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    found = {r.doc_id: r.bits for r in lm_score.score(docs, training(), part_bytes=1 << 10).collect()}
    want = slow_bits([(t, is_training(i)) for i, t in rows], kept[0].first)
    assert [found[i] for i, _ in rows] == pytest.approx(want, rel=2e-3, abs=1e-2)
    assert kept[0].first.shape == (3, 2) and not np.allclose(kept[0].first, lm_score.FIRST_WEIGHT)


def test_code_is_complete_and_learning_helps(spark):
    assert sum(2.0 ** -int(n) for n in lm_score.LENGTH) == 1
    rng = np.random.default_rng(0)
    rows = [(i, tongue(rng, "en", 60), "en", "s") for i in range(60)] + [(60, tongue(rng, "fr", 60), "fr", "s")]
    rows += [(61, rows[7][1], "en", "s"), (62, tongue(rng, "en", 60), "en", "s")]
    found = {r.doc_id: r.bits_per_byte for r in lm_score.score(documents(spark, rows), F.col("doc_id") < 50).collect()}
    like = np.mean([found[i] for i in range(50, 60)])
    assert found[61] < found[62] / 3 and like < 3 < found[60]  # a copy of what was learned; like it; unlike it


def test_short_texts_are_mixed_online(spark):
    rng = np.random.default_rng(0)
    rows = [(i, tongue(rng, "en", 60), "en", "s") for i in range(50)] + [(100 + n, "eauqueux " * n, "fr", "s") for n in (0, 20, 40, 60)]
    found = {r.doc_id: r.bits for r in lm_score.score(documents(spark, rows), F.col("doc_id") < 50).collect()}
    none, once, twice, thrice = (found[100 + n] for n in (0, 20, 40, 60))
    assert thrice - twice < 0.99 * (once - none)  # fixed weights give as many bits each time


# ---------------------------------------------------------------- 9 shards


def test_shards(spark, odd, empty, tmp_path):
    for size in (64, 1 << 24):
        out = shard.shard_documents(odd, bucket_bytes=size)
        rows = out.collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, *_ in texts_of(odd)) and set(out.columns) == set(odd.columns)
        slots = {}
        for r in rows:
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        again = shard.shard_documents(odd.repartition(5), bucket_bytes=size).collect()
        assert sorted((str(r.doc_id), str(r.text), r.shard, r.slot) for r in again) == sorted((str(r.doc_id), str(r.text), r.shard, r.slot) for r in rows)
    keys = spark.range(500).select(shard.shard_of(F.col("id"), 24).alias("a"), shard.shard_of(F.col("id"), 25).alias("b")).collect()
    assert all(k.a == k.b or k.b == 24 for k in keys) and any(k.b == 24 for k in keys) and {k.a for k in keys} == set(range(24))
    written = shard.write_shards(odd, str(tmp_path / "shards"), n_shards=3)
    assert written.count() == odd.count() and written.select("shard").distinct().count() <= 3
    assert shard.shard_documents(empty).count() == 0


# ---------------------------------------------------------------- 10 tokens


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_tokens(spark, odd, empty, rule):
    raw = open(token_counts.VOCABULARY, "rb").read()
    encoder = token_counts._encoder(raw, token_counts.PATTERN)[0]
    rows = [(1, "héllo wörld\n\n\n  foo 日本語\nlast", "en", "s"), (2, "a\n\n\n\nb", "en", "s")]
    docs = odd.select(*documents(spark, []).columns).unionByName(documents(spark, rows))
    got = Counter((r.doc_id, r.n_tokens, tuple((x.start, x.end, x.tokens) for x in r.sections)) for r in token_counts.count_tokens(docs, rule=rule).collect())
    want = Counter()
    for doc_id, text, *_ in texts_of(docs):
        lines = [m.span() for m in re.finditer(r"[^\n]*\n|[^\n]+$", text or "")]
        tokens = by_hand(encoder, text or "", rule)
        want[doc_id, sum(tokens), tuple((a, z, n) for (a, z), n in zip(lines, tokens, strict=True))] += 1
    assert got == want and sum(want.values()) == docs.count()
    assert token_counts.count_tokens(empty).count() == 0


def by_hand(encoder, text, rule):
    """The tokens of each line, token by token."""
    line, counts = [], [0] * len(re.findall(r"[^\n]*\n|[^\n]+$", text))
    for ch in text:
        line.append((line[-1][0] + (text[len(line) - 1] == "\n") if line else 0, len(line)))
    place = [k for k, ch in enumerate(text) for _ in ch.encode()]
    at = 0
    for t in encoder.encode_ordinary(text):
        size = len(encoder.decode_single_token_bytes(t))
        held = Counter(line[k][0] for k in range(place[at], place[at + size - 1] + 1))
        at += size
        own = {"start": min(held), "end": max(held), "most": min(held, key=lambda k: (-held[k], k))}[rule]
        counts[own] += 1
    return counts


def test_token_fields(spark):
    docs = documents(spark, [(1, "some text", "en", "src"), (2, None, None, "x")])
    rows = token_counts.count_tokens(docs, fields=["source", "lang", "text"]).orderBy("doc_id").collect()
    assert [s.section for s in rows[0].sections] == ["source", "lang", "text"] and all(sum(s.tokens for s in r.sections) == r.n_tokens for r in rows)
    with pytest.raises(ValueError, match="rule"):
        token_counts.count_tokens(docs, rule="first")


# ---------------------------------------------------------------- queries and pipeline


def test_contract_columns(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    got = decontaminate.op1_decontaminate(spark, folder)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert got.filter("n_items = 0").first().items_sha256 == hashlib.sha256(b"").hexdigest()
    assert dict(shard.op9_shard(spark, folder).dtypes)["text_crc32"] == "bigint"


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(8)
    texts = [(i, tongue(rng, ["en", "de", "fr"][i % 3], 60), ["en", "de", "fr"][i % 3], f"s{i % 4}") for i in range(90)]
    leaked = texts[3][1]
    rows = texts + [(100, texts[0][1], "en", "s0"), (101, None, "en", "s1"), (102, "12 34 !!", "de", "s1"), (103, texts[1][1] + " more", "de", "s2")]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leaked)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = Counter(r.doc_id for r in docs.collect())
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert set(kept["language_id"]) == set(range(90)) | {100, 103}
    assert set(kept["near_dedup"]) == set(range(90))
    assert set(kept["decontaminate"]) == set(range(90)) - {3}
    assert set(kept["mix"]) <= set(kept["decontaminate"]) and max(kept["mix"].values()) <= 2
    assert kept["shard"] == kept["mix"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == sum(kept["shard"].values())
