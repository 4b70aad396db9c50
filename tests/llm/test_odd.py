"""Odd data through the operators; slow versions of those that have no SQL; the SQL of those that have."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import common, decontaminate, language_id, license_scan, lm_score, mix, near_dedup, shard, token_counts, url_filter
from quarry.llm import queries as llm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def strange(spark):
    """Columns whose names have dots, spaces and other cases, and whose types are nested."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice("alpha beta gamma delta".split(), 20)), "en", f"s{i % 2}", 1) for i in range(30)]
    df = spark.createDataFrame([*rows, rows[0], (None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    nested = F.struct(F.lit(1).alias("a field"), F.lit("x").alias("b.c"))
    return df.withColumns({"a.b": F.lit("mine"), "SHARD": F.lit(5), "Slot": F.lit("old"), "st": nested, "m": F.create_map(F.lit("k"), F.col("doc_id")), "Text_Key": F.lit(0), "with `tick`": F.lit(1)})


def test_strange_columns(spark, strange, tmp_path):
    mixed = mix.mixed_rows(strange)
    assert mixed.columns == strange.columns and mixed.count() > 0
    one = near_dedup.one_of_each(strange)
    assert one.columns == strange.columns and one.filter("doc_id = 0").count() <= 1
    assert language_id.accepted(strange).columns == strange.columns
    item = spark.createDataFrame([(1, "alpha beta gamma delta " * 5)], "item_id long, text string")
    assert decontaminate.remove_contaminated(strange, item).columns == strange.columns
    out = shard.shard_documents(strange)
    assert out.columns == [c for c in strange.columns if c not in ("SHARD", "Slot")] + ["shard", "slot"]
    assert out.count() == strange.count() and out.schema["st"].dataType == strange.schema["st"].dataType
    written = shard.write_shards(strange.drop("m"), str(tmp_path / "out"), n_shards=3)
    assert written.count() == strange.count()


def test_repeated_rows_fill_no_bucket(spark):
    rows = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same text again").alias("text"), F.lit("x").alias("source"))
    docs = rows.unionAll(spark.range(50).select("id", F.concat(F.lit("text "), F.col("id").cast("string")), F.lit("y")))
    out = shard.shard_documents(docs, bucket_bytes=1 << 16)
    sizes = out.withColumn("task", F.spark_partition_id()).groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high"), F.countDistinct("slot").alias("slots")).collect()
    assert sum(r.n for r in sizes) == 100_050 and all((r.low, r.high, r.slots) == (0, r.n - 1, r.n) for r in sizes)
    hot = out.filter("source = 'x'")
    assert hot.count() == 100_000 and hot.select("shard").distinct().count() == 1
    again = shard.shard_documents(docs.repartition(7), bucket_bytes=1 << 16)
    assert sorted(map(tuple, again.select("doc_id", "text", "shard", "slot").collect())) == sorted(map(tuple, out.select("doc_id", "text", "shard", "slot").collect()))


def test_shards_slowly(spark):
    """Size, checksum and the law by hand: a shard depends on the id and the number of shards, a 25th takes rows only into itself."""
    got = {r.doc_id: r for r in shard.op9_shard(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    scores = {(r.id, r.s): r.x for r in spark.range(len(docs)).crossJoin(spark.range(25).withColumnRenamed("id", "s")).select("id", F.col("s").cast("int").alias("s"), F.xxhash64(F.col("id").isNull(), "id", F.col("s").cast("int")).alias("x")).collect()}
    for d in docs:
        raw, r = (d.text or "").encode(), got[d.doc_id]
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert r.shard == max(range(24), key=lambda s: scores[d.doc_id, s]) and r.grown_shard == max(range(25), key=lambda s: scores[d.doc_id, s])
        assert r.grown_shard in (r.shard, 24)
    by_shard = defaultdict(list)
    for r in got.values():
        by_shard[r.shard].append((r.slot, r.doc_id))
    assert all([s for s, _ in sorted(x)] == list(range(len(x))) for x in by_shard.values())
    orders = [[i for _, i in sorted(x)] for x in by_shard.values() if len(x) > 8]
    assert any(o != sorted(o) for o in orders)


def test_long_white_space():
    raw = open(token_counts.VOCABULARY, "rb").read()
    encoder = token_counts._encoder(raw, token_counts.PATTERN)[0]
    rng = np.random.default_rng(0)
    for _ in range(100):
        text = "".join(rng.choice(["a", "b1", "\n", " ", ".", " x", " " * 1200, "\n" * 1100, "　" * 1001, "\t"], 10))
        assert token_counts.token_spans(text, raw)[0].tolist() == encoder.encode_ordinary(text)
    tokens, first, last = token_counts.token_spans(" " * 5_000_000 + "word", raw)
    assert first[0] == 0 and last[-1] == 5_000_003 and (first[1:] == last[:-1] + 1).all()


def test_joined_blocks_are_linear():
    """A group whose members are alike among themselves, each a component of its own: what joins them is a row for each."""
    rng = np.random.default_rng(0)
    base = np.sort(rng.integers(0, 1 << 62, 200, dtype=np.uint64))
    sets = [np.sort(np.concatenate((np.delete(base, rng.choice(200, 5, replace=False)), rng.integers(0, 1 << 62, 5, dtype=np.uint64)))) for _ in range(300)]
    sets.append(np.sort(rng.integers(0, 1 << 62, 200, dtype=np.uint64)))  # alike to none
    rows = pa.table({"side": [0] * 150 + [1] * 151, "node": range(301), "comp": range(301), "n": [len(x) for x in sets], "shingles": pa.array([x.tobytes() for x in sets], pa.binary())})
    out = near_dedup._joined_blocks(80)((), rows)
    assert len(out) == 299 and set(out["b"].to_pylist()) == set(range(1, 300)) and set(out["a"].to_pylist()) == {0}


def test_near_duplicates_unlike_their_centre(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(500)]
    base = rng.choice(vocabulary, 200)
    rows = []
    for group in range(6):  # alike within a group, less so between them
        own = base.copy()
        at = rng.choice(200, 22, replace=False)
        own[at] = rng.choice(vocabulary, 22)
        for _ in range(20):
            w = own.copy()
            w[rng.choice(200, 3, replace=False)] = rng.choice(vocabulary, 3)
            rows.append((len(rows), " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [{tuple(t.split()[i : i + 2]) for i in range(199)} for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:  # smallest label reachable, by rounds
        for a in range(len(rows)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if all(label[label[a]] == label[a] for a in range(len(rows))):
            break
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, shingle=2).collect()}
    assert got == dict(enumerate(label))


def kneser_ney(texts, order):
    """Interpolated Kneser-Ney probabilities by dictionaries: of a symbol after a context."""
    levels = []
    grams = Counter()
    for t in texts:
        padded = " " * (order - 1) + t
        for i in range(len(t)):
            grams[padded[i : i + order]] += 1
    for n in range(order, 0, -1):
        levels.insert(0, grams)
        ones, twos = sum(c == 1 for c in grams.values()), sum(c == 2 for c in grams.values())
        levels[0] = (grams, ones / (ones + 2 * twos) if ones and twos else 0.5)
        grams = Counter(g[1:] for g in grams)  # different symbols before

    def probability(context, symbol):
        p = 1 / language_id.ALPHABET
        for n, (counts, discount) in enumerate(levels, 1):
            c = context[len(context) - (n - 1) :] if n > 1 else ""
            after = {g: k for g, k in counts.items() if g[:-1] == c}
            if after:
                total = sum(after.values())
                p = max(after.get(c + symbol, 0) - discount, 0) / total + discount * len(after) / total * p
        return p

    return probability


def symbols_by_hand(text):
    out = re.sub(r"[\W\d_]+", " ", text.lower())
    return out.lstrip(" ")


def test_kneser_ney_by_dictionaries():
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abcde  é,.1"), rng.integers(1, 60))) for _ in range(40)]
    data, at = common.text_buffers(pa.array(texts[:30]))
    model = language_id.Model("x", 0.0, *language_id.fit(*language_id.symbols(data, at)))
    p = kneser_ney([symbols_by_hand(t) for t in texts[:30]], language_id.ORDER)
    for size in (language_id.CHUNK, 7):  # whole, and in blocks
        language_id.CHUNK, was = size, language_id.CHUNK
        try:
            bits, n = language_id.cross_entropies([model], *common.text_buffers(pa.array(texts)))
        finally:
            language_id.CHUNK = was
        for t, got, k in zip(texts, bits[:, 0], n, strict=True):
            s = symbols_by_hand(t)
            padded = " " * (language_id.ORDER - 1) + s
            want = [-np.log2(p(padded[i : i + language_id.ORDER - 1], s[i])) for i in range(len(s))]
            assert k == len(s) and got == pytest.approx(np.mean(want) if want else 0.0, rel=1e-4)


def test_taken_slowly(spark):
    """Pivotal rounding by hand, from the units' keys on: the same draws give the same copies."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150).cache()
    seed = 17
    units = mix.mix_sources(docs, seed=seed).collect()
    by_source = defaultdict(list)
    for u in units:
        by_source[u.source].append(u)
    hashed = {}

    def prepare(level, keys):
        df = spark.createDataFrame([(a, b) for a, b in keys], "u1 long, u2 long")
        cols = [F.xxhash64("u1", "u2", F.lit(level), F.lit(seed)), F.xxhash64("u2", "u1", F.lit(level), F.lit(seed))]
        for r in df.select("u1", "u2", *(c.alias(f"h{k}") for k, c in enumerate(cols))).collect():
            hashed[level, r.u1, r.u2] = (r.h0, r.h1)

    uniform = lambda h: ((h % (1 << 64)) >> 11) * 2.0**-53
    for source, own in by_source.items():
        active, copies = [], {}
        for u in own:
            wanted = u.rows * u.target / u.source_size if u.source_size else 0.0
            copies[u.u1, u.u2] = int(wanted)
            if u["size"] and wanted > int(wanted):
                active.append(((u.u1, u.u2), u["size"], wanted - int(wanted)))
        level, buckets = 0, len(own)
        for _ in range(9):
            level, buckets = level + 1, -(-len(own) // mix.BUCKET ** (level + 1))
            prepare(level, [k for k, *_ in active])
            cells = defaultdict(list)
            for e in active:
                cells[hashed[level, *e[0]][0] % max(1, buckets)].append(e)
            active = []
            for cell in cells.values():
                cell.sort(key=lambda e: (hashed[level, *e[0]][1], e[0]))
                (key, size, x), rest = cell[0], cell[1:]
                for k2, s2, x2 in rest:
                    up, down = min(size * (1 - x), s2 * x2), min(size * x, s2 * (1 - x2))
                    rises = uniform(hashed[level, *k2][0]) * (up + down) < down
                    first_done = size * (1 - x) <= s2 * x2 if rises else size * x <= s2 * (1 - x2)
                    moved = up if rises else -down
                    done, more = (key, rises) if first_done else (k2, not rises)
                    copies[done] += more
                    key, size, x = (k2, s2, x2 - moved / s2) if first_done else (key, size, x + moved / size)
                    x = min(1.0, max(0.0, x))
                active.append((key, size, x))
            if max(-(-len(o) // mix.BUCKET**level) for o in by_source.values()) <= 1:
                break
        prepare(level + 1, [k for k, *_ in active])
        for key, _, x in active:
            copies[key] += uniform(hashed[level + 1, *key][1]) < x
        assert {(u.u1, u.u2): u.copies for u in own} == copies, source


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = llm.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    rel = con.execute(llm.ORACLE_SQL[name])
    names = [d[0] for d in rel.description]
    want = sorted(str(tuple(row[names.index(c)] for c in cols)) for row in rel.fetchall())
    assert sorted(names) == cols and sorted(str(tuple(r[c] for c in cols)) for r in got.collect()) == want


def test_very_long_texts(spark):
    text = "mit license word " * 30_000
    docs = spark.createDataFrame([(1, text, "en", "s"), (2, "y" * 3_000_000, "en", "s"), (3, " " * 2_000_000, "en", "s")], "doc_id long, text string, lang string, source string")
    assert {r.doc_id: (r.n_words, len(r.spans)) for r in license_scan.license_spans(docs).collect()} == {1: (90_000, 30_000), 2: (1, 0), 3: (0, 0)}
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs).collect()}[3] > 0
    assert language_id.accepted(docs).count() >= 1 and near_dedup.near_duplicates(docs).count() == 3
    assert shard.shard_documents(docs).count() == 3 and mix.mix_sources(docs).count() == 3
    assert url_filter.judge_urls(spark.createDataFrame([(1, "http://a.com/" + "b" * 2_000_000)], "page_id long, url string")).count() == 1
    item = spark.createDataFrame([(1, "mit license word " * 9), (2, "z " * 20)], "item_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_hit, len(r.spans), r.items) for r in decontaminate.decontaminate(docs, item).collect()}
    assert found == {1: (90_000, 90_000, 1, ["1"]), 2: (1, 0, 0, []), 3: (0, 0, 0, [])}


def test_very_long_texts_scored(spark, tmp_path):
    rows = [(1, "mit license word " * 30_000), (2, "y" * 300_000), (3, " " * 2_000_000), (4, "a b c")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    found = {r.doc_id: r for r in lm_score.score(spark.read.parquet(str(tmp_path / "d")), F.lit(True)).collect()}
    assert {k: r.n_tokens for k, r in found.items()} == {1: 90_001, 2: 2, 3: 1, 4: 4}
    assert all(np.isfinite(r.score) and r.score <= 0 for r in found.values())


def test_many_hits_in_one_document(spark):
    """Apart, touching and overlapping: as many as the text has, in time linear in them; a window that many items share."""
    words = [f"w{k}" for k in range(13)]
    item = [(k, " ".join(words)) for k in range(30_000)] + [(None, " ".join(words)), (7, " ".join(words[:5]))]
    text = " ".join([*words, "gap"] * 20_000 + words * 2)
    docs = spark.createDataFrame([(1, text), (2, " ".join(words[:5])), (3, "w1 w2")], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs, spark.createDataFrame(item, "item_id long, text string")).collect()}
    assert (got[1].n_words, got[1].n_hit, len(got[1].spans), len(got[1].items)) == (280_026, 260_026, 20_001, 30_000) and got[1].contaminated
    assert (got[2].n_hit, got[2].items, got[3].n_hit, got[3].items) == (5, ["7"], 0, [])
    assert got[1].spans[0].asDict() == {"start": 0, "end": 13} and got[1].spans[-1].asDict() == {"start": 280_000, "end": 280_026}
    strange = docs.withColumnRenamed("text", "a.text").withColumnRenamed("doc_id", "an.id")
    odd_items = spark.createDataFrame([(1, "w1 w2")], "item_id long, text string").withColumnRenamed("text", "t.t")
    assert decontaminate.remove_contaminated(strange, odd_items, "an.id", "a.text", item_text_col="t.t").columns == strange.columns


def test_batches_follow_bytes(spark):
    """Long texts come in batches of about ``BATCH_BYTES``, whatever their number; the runs that a batch is cut into are whole and even."""
    common.importable(spark)
    assert int(spark.conf.get(common.BATCH_LIMIT)) == common.BATCH_BYTES

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    long = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 200_000).alias("t"))
    assert max(r.n for r in long.mapInArrow(sizes, "n bigint").collect()) <= common.BATCH_BYTES + 400_000
    texts = pa.array(["", "a" * 10, None, "b" * 25, "c" * 5, "", "d" * 100, "e"])
    for about in (1, 20, 60, 1000):
        runs = list(common.even_chunks(texts, about))
        assert [i for i, *_ in runs] == [0, *(j for _, j, *_ in runs[:-1])] and runs[-1][1] == len(texts)
        assert b"".join(d.tobytes() for _, _, d, _ in runs) == "".join(x or "" for x in texts.to_pylist()).encode()
        assert all(len(at) == j - i + 1 and at[-1] == len(d) for i, j, d, at in runs)
    assert list(common.even_chunks(texts[:0], 5)) == []
