"""Golden rows of the rules, one operator after another."""

import json
import struct
import zlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry import config, schemas
from quarry.functions import shapes, text
from quarry.operators import grids, items, labels, posts, stats, sync, validate
from quarry.sources import files, imagebytes, listings
from quarry.streaming import incremental


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_whole_words(spark):
    texts = ["a photograph of nature", "Anime style, MEME", "3d_render, scenic", "comic-book hero", "éanime", None, "speech bubbles"]
    words = ["graph", "anime", "meme", "3d render", "comic", "speech bubble", "speech bubbles"]
    assert column(spark, texts, lambda c: text.reject_signals(c, words)) == [[], ["anime", "meme"], [], ["comic"], [], [], ["speech bubbles"]]
    paired = column(spark, ["a wooden table", "table with text"], lambda c: text.reject_signals(c, [], ["table"], ["text", "data"]))
    assert paired == [[], ["table"]]


@pytest.mark.parametrize("few", [0, 16])
def test_words_in_one_pass(spark, monkeypatch, few):
    """The list's words by tokens, against each word's own pattern."""
    monkeypatch.setattr(text, "FEW", few)
    words = ["graph", "3d render", "comic-book", "@", "speech bubble", "speech bubbles", "a b", "日本", "é", "_x", "c++", "b a"]
    texts = ["3D-render 3d render, graph", "a speech bubbles b", "speech bubble;a b a", "@ x @home c++ c++x", "日本 日本語 É é_x _x", "comic-book comic book", None, "", "graph_ 2graph"]
    got = column(spark, texts, lambda c: text.words_found(F.lower(F.coalesce(c, F.lit(""))), words))
    each = column(spark, texts, lambda c: text.named([(w, text.has_word(F.lower(F.coalesce(c, F.lit(""))), w)) for w in words]))
    assert got == each and got[2] == ["speech bubble", "a b", "b a"]
    assert column(spark, texts, lambda c: text.any_word(F.lower(F.coalesce(c, F.lit(""))), words)) == [bool(x) for x in each]
    assert column(spark, texts[:3], lambda c: text.words_found(c, [])) == [[]] * 3


def test_configurations():
    sizes = {n: len(config.dataset(n).reject) for n in config.dataset_names()}
    assert sizes == {"midjourney_v7": 102, "soul2": 101, "flux1": 102, "nano_banana_1_2": 78, "instagram_ai_influencer": 9, "recraft_3_4": 101, "gpt_image_1": 87, "grok": 102, "flux2": 102, "seedream4": 101, "instagram_real": 0}
    assert [len(config.dataset(n).ratios) for n in ("grok", "gpt_image_1", "nano_banana_1_2", "seedream4", "soul2", "midjourney_v7")] == [15, 3, 14, 17, 13, 17]
    assert len(config.TEXT_PAIRED_KEYWORDS) == 32 and len(config.TEXT_INDICATORS) == 22 and len(grids.TILES) == 51 == len(set(grids.TILES))
    config.register_dataset(config.DatasetConfig("mine", 1))
    assert config.dataset("mine").max_pixels == 5_000_000


def test_dimensions(spark):
    assert config.dim_dataset(spark).count() == len(config.dataset_names())
    assert config.dim_keyword(spark).filter("dataset = 'grok' AND kind = 'reject'").count() == 102
    assert config.dim_ratio(spark).filter("dataset = 'gpt_image_1'").count() == 3


def test_known_ratio(spark):
    grok = config.dataset("grok")
    sizes = [(1024, 1024), (1024, 559), (1408, 768), (2000, 900), (1242, 1656), (1000, 920), (1000, 833), (0, 100), (100, 0)]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(sizes)], "i int, w int, h int")
    got = df.select("i", shapes.known_ratio(F.col("w"), F.col("h"), grok.ratios, 0.05).alias("r")).orderBy("i").collect()
    assert [r.r for r in got] == ["1:1", "16:9", "16:9", "19.5:9", "3:4", None, None, None, None]


def test_extension(spark):
    cases = [("a.PNG?x=1", "", ".png"), ("a.jpg", "image/webp", ".webp"), ("a?format=png&name=orig", "", ".png"), ("a.gif", "image/gif", ".jpg")]
    df = spark.createDataFrame(cases, "u string, t string, want string")
    assert df.filter(text.extension(F.col("u"), F.col("t")) != F.col("want")).count() == 0


def greedy(rows):
    urls, hashes, out = set(), set(), []
    for u, h in rows:
        if u in urls:
            out.append("dup_url")
        elif h in hashes:
            out.append("dup_hash")
        else:
            urls.add(u)
            hashes.add(h)
            out.append("ok")
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=25))
def test_first_arrivals_are_greedy(spark, pairs):
    rows = [(i, f"u{u}" if u else None, h or None) for i, (u, h) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, url string, hash int")
    got = [r.outcome for r in items.first_arrivals(df, "url", "hash", ["i"]).orderBy("i").collect()]
    assert got == greedy([(u, h) for _, u, h in rows])


def test_small_images_go_but_undecoded_stay(spark):
    assert column(spark, [0, 10_000, 200_000], lambda c: items.large_enough(c, 200_000), "long") == [True, False, True]


def test_post_ladder(spark):
    rules = config.PostRules(1743465600, False, [], ["meme"], [" vs.", "flux", "review"])
    rows = [(1743465599.0, False, None, "x"), (1743465600.0, False, " MEME ", "x"), (1743465600.0, False, "", "GROK VS. flux"), (1743465600.0, False, None, "preview shots"), (None, False, None, "x"), (1743465601.0, None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c double, s boolean, f string, t string")
    got = df.select("i", posts.skip_reason(rules, F.col("c"), F.col("s"), F.col("f"), F.col("t")).alias("r")).orderBy("i").collect()
    assert [r.r for r in got] == ["too_old", "flair:meme", "title_keyword:vs.", "title_keyword:review", "too_old", None]
    asked = config.PostRules(require_flairs=["gpt-4o"], skip_self=True)
    got = df.select("i", posts.skip_reason(asked, F.col("c"), F.lit(True), F.col("f"), F.col("t")).alias("r")).collect()
    assert {r.r for r in got} == {"self_post"}
    none = df.select(posts.skip_reason(config.PostRules(require_flairs=["gpt-4o"]), F.col("c"), F.col("s"), F.col("f"), F.col("t")).alias("r")).first()
    assert none.r == "flair_not_required:none"


def test_versions(spark):
    cases = [("midjourney_v7", "", "midjourney_v7:vunknown", "v7"), ("flux1", "civitai", "onsite:model_version:699279", "schnell"), ("flux1", "civitai", "onsite:model_version:1892523", "unknown"), ("seedream4", "", "", "seedream_4.0"),
             ("recraft_3_4", "", "recraft:recraftv4_pro_raster:any", "v4_pro"), ("nano_banana_1_2", "higgsfield_nano_banana_2", "", "v2"), ("nope", "", "", "unknown")]
    for dataset, source, flair, want in cases:
        assert spark.range(1).select(labels.model_version(dataset, F.lit(source), F.lit(flair))).first()[0] == want
    labels.register_ladder("own", lambda s, f: F.when(s == "a", "A").otherwise("B"))
    assert spark.range(1).select(labels.model_version("own", F.lit("a"), F.lit(None))).first()[0] == "A"


def test_chat_messages(spark):
    ids = spark.createDataFrame([(["a", "X_v6_", "MJ_v7_up"], ""), (None, "x --v  6.1"), ([], None), (["v6r1"], "--v 7")], "c array<string>, t string")
    got = [r.v for r in ids.select(text.message_version(F.col("c"), F.col("t")).alias("v")).collect()]
    assert got == ["6", "6.1", "unknown", "6.1"]
    assert column(spark, ["**a cat** - by", "plain", None], text.message_prompt) == ["a cat", "plain", ""]
    ms = column(spark, [1704067200000], lambda c: text.snowflake_ms(text.snowflake_of(c)), "long")
    assert ms == [1704067200000]
    df = spark.createDataFrame([("d", "u1 320w, u2 1440w, u3 1440w", 100), ("d", "", 5), ("d", None, None), ("d", "u1 50w", 60)], "u string, s string, w int")
    assert [r[0] for r in df.select(text.largest_source(F.col("u"), F.col("s"), F.col("w"))).collect()] == ["u2", "d", "d", "d"]


def test_answers(spark):
    got = column(spark, ["", None, "<Category> meme </category>", "<is_ai_art>No", "<is_ai_art> YES </is_ai_art><reason>a\nb</reason>"], text.parsed_answer)
    assert [(r.category, r.is_ai_art, r.reason) for r in got] == [("UNKNOWN", True, "Empty response"), ("UNKNOWN", True, "Empty response"), ("MEME", True, ""), ("UNKNOWN", True, ""), ("UNKNOWN", True, "a\nb")]


ITEM = "filename string, width int, height int, format string, file_size long, avg_quantization double, camera_exif_tags array<string>, opened boolean"


def decided(spark, rows, captions, scores, **options):
    conf = config.DatasetConfig("t", 200_000, 5_000_000, ["JPEG", "PNG"], 40.0, [(1, 1)], 0.05, ["Make"], ["meme"])
    flagged = validate.structural(spark.createDataFrame(rows, ITEM), conf)
    caps = spark.createDataFrame(captions, "filename string, caption string, should_reject boolean, reject_signals array<string>, error string")
    scored = spark.createDataFrame(scores, "filename string, z_score double, is_fake boolean")
    out = validate.decide(flagged, validate.reclassified(caps, conf), scored, **options)
    return {r.filename: (r.state, r.reasons) for r in out.collect()}, out


def image(name, w=1000, h=1000, fmt="JPEG", q=5.0, tags=(), opened=True):
    return (name, w, h, fmt, 1000, q, list(tags), opened)


def test_decisions(spark):
    rows = [image("ok.jpg"), image("small.jpg", 100, 100), image("thin.png", 100, 300), image("gif.jpg", fmt="GIF"), image("broken.jpg", 0, 0, opened=False), image("heavy.jpg", q=50.0), image("camera.JPG", tags=["Make"]),
            image("uncaptioned.jpg"), image("failed.jpg"), image("meme.jpg"), image("real.jpg"), image("x.webp")]
    captions = [(r[0], "a cat", None, None, None) for r in rows if r[0] not in ("uncaptioned.jpg", "failed.jpg", "meme.jpg")]
    captions += [("failed.jpg", None, None, None, "timeout"), ("meme.jpg", "a MEME", None, None, None)]
    scores = [("ok.jpg", -3.0, True), ("real.jpg", 1.0, False)]
    got, out = decided(spark, rows, captions, scores, relaxed=False)
    assert got == {
        "ok.jpg": ("images", []), "small.jpg": ("rejected", ["too_small"]), "thin.png": ("rejected", ["too_small", "bad_aspect_ratio"]), "gif.jpg": ("images", []), "broken.jpg": ("images", []),
        "heavy.jpg": ("rejected", ["high_compression"]), "camera.JPG": ("rejected", ["camera_exif"]), "uncaptioned.jpg": ("staging", []), "failed.jpg": ("rejected", []), "meme.jpg": ("rejected", []),
        "real.jpg": ("rejected", ["fsd_real"]), "x.webp": ("staging", []),
    }
    assert decided(spark, rows, captions, scores, relaxed=True)[0]["heavy.jpg"] == ("images", [])
    assert decided(spark, rows, captions, scores, fsd_mode="tag")[0]["real.jpg"] == ("images", [])
    assert decided(spark, rows, [], scores)[0]["uncaptioned.jpg"] == ("images", [])
    report = json.loads(validate.report(out, relaxed=False).first().report)
    assert (report["total"], report["passed"], report["rejected"]) == (8, 3, 5) and report["rejection_reasons"]["too_small"] == 2
    assert report["timestamp"].endswith("+00:00") and json.loads(validate.report(out, at=F.lit("2024-05-06 07:08:09.5").cast("timestamp")).first().report)["timestamp"] == "2024-05-06T07:08:09.500000+00:00"
    twice = decided(spark, rows, [*captions, ("ok.jpg", "a meme", None, None, None)], [*scores, ("ok.jpg", -9.0, True)])[1]
    assert twice.count() == len(rows) and twice.filter("filename = 'ok.jpg'").first().state == "rejected"
    empty = json.loads(validate.report(out.limit(0)).first().report)
    assert empty["total"] == 0 and empty["rejection_reasons"] == {}
    assert validate.reset(out).filter("state = 'rejected'").count() == 0


def test_grids(spark):
    cases = [("2048", "2048", "true", "single"), ("1024", "1024", "false", "single"), ("2048", "2048", "false", "grid"), ("896", "1312", "false", "grid"), ("3000", "2000", "", "grid"), ("1501", "3001", "", "unknown"), ("1000", "1000", "", "unknown"), ("abc", "10", "", "unknown")]
    df = spark.createDataFrame([(f"f{i}.png", "midjourney_v7:v7:grid", *c) for i, c in enumerate(cases)], "filename string, flair string, width string, height string, is_upscaled string, want string")
    assert grids.classified(df).filter("grid_class <> want").count() == 0
    one = spark.createDataFrame([("ab12.png", "m:v7:grid", "2049", "2048", "false")], "filename string, flair string, width string, height string, is_upscaled string")
    tiles = grids.tile_rows(one).orderBy("filename").collect()
    assert [(t.filename, t.width, t.height, t.flair) for t in tiles] == [(f"ab12_{i}.png", [1024, 1025][i % 2], 1024, f"m:v7:tile{i}") for i in range(4)]
    manifest = df.drop("want")
    once = grids.split(manifest)
    assert once.count() == 5 + 4 * 3
    assert sorted(map(tuple, grids.split(once).collect())) == sorted(map(tuple, once.collect()))
    assert grids.split(manifest, limit=1).count() == 7 + 4


def test_stats(spark):
    df = spark.createDataFrame([("-2.0",), ("-2.1",), ("",), ("x",), ("1",)], "z_score string")
    s = stats.score_stats(df).first()
    assert (s.total, s.detected, s.rate, round(s.mean_z, 6)) == (4, 1, 25.0, -0.775)
    none = stats.score_stats(df.limit(0)).first()
    assert none.total == 0 and none.rate is None and none.mean_z is None
    states = spark.createDataFrame([("a", "images")] * 3 + [("a", "rejected")] + [("a", "staging")] * 9, "dataset string, state string")
    total = stats.state_counts(states).filter("dataset IS NULL").first()
    assert total.pass_rate == 75.0 and total.total == 12
    one = spark.createDataFrame([("s", 3)], "source string, n long")
    assert stats.top_if_several(one, "source", 6).count() == 0
    assert stats.version_breakdown(spark.createDataFrame([("",), (None,), ("v1",)], "model_version string")).count() == 2


def test_streaks(spark):
    rows = [("a", i, y) for i, y in enumerate([1, 0, 0, 1, 0, 0, 0, 1])] + [("b", 0, 1)]
    df = spark.createDataFrame(rows, "q string, page int, got int")
    kept = items.until_barren(df, ["q"], "page", F.col("got") > 0, 3).orderBy("q", "page").collect()
    assert [(r.q, r.page, r.streak) for r in kept] == [("a", 0, 0), ("a", 1, 1), ("a", 2, 2), ("a", 3, 0), ("a", 4, 1), ("a", 5, 2), ("a", 6, 3), ("b", 0, 0)]


def test_sync_and_sheets(spark):
    a = spark.createDataFrame([("x", 1), ("y", 1), ("z", 1)], "k string, v int")
    b = spark.createDataFrame([("y", 1), ("z", 2), ("w", 1)], "k string, v int")
    assert {r.k: r.action for r in sync.sync_plan(a, b, "k", "v").collect()} == {"x": "copy", "y": "keep", "z": "update", "w": "delete"}
    sheet = sync.contact_sheet(a.withColumn("by", F.lit("all")), "by", "k", "k", "v", page=2).orderBy("page").collect()
    assert [r.n for r in sheet] == [2, 1] and '<img src="x">' in sheet[0].html


def test_numbered_across_ranges(spark):
    rows = [("a", k) for k in range(500)] + [(None, k) for k in range(7)] + [("b", 3)]
    df = spark.createDataFrame(rows, "by string, k int").repartition(5)
    found = items.numbered(df, "by", "k", "n").collect()
    assert sorted((r.by or "", r.k, r.n) for r in found) == sorted((b or "", k, k if b != "b" else 0) for b, k in rows)
    assert items.numbered(df.limit(0), "by", "k", "n").count() == 0


def test_commonest_and_the_rest(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 5), (None, 2), ("c", 8)], "s string, n bigint")
    assert [(r.rank, r.s, r.n, r.percent) for r in stats.top_and_others(counts, "s", 2).orderBy("rank").collect()] == [(1, "c", 8, 40.0), (2, "a", 5, 25.0), (3, "(others)", 7, 35.0)]
    assert [(r.rank, r.s) for r in stats.top_and_others(counts, "s", 4).orderBy("rank").collect()] == [(1, "c"), (2, "a"), (3, "b"), (4, None)]
    assert stats.top_and_others(counts.limit(0), "s", 2).count() == 0
    assert stats.top_if_several(counts.limit(1), "s", 2).count() == 0 and stats.top_if_several(counts, "s", 3).count() == 3


# ---------------------------------------------------------------- sources


LISTED = {
    "civitai": ({"id": 1, "url": "uu", "name": "generator_import_1.png", "type": "image", "postTitle": "t"}, {"url": "https://image.civitai.com/xG1nkqKTMzGDvpLrqFT7WA/uu/original=true/generator_import_1.png", "flair": "onsite:tool:5"}, {"tag": "tool:5"}),
    "higgsfield": ({"id": "h", "results": None, "result": {"url": "r.png", "type": "image"}, "params": {"prompt": "p" * 300}}, {"url": "r.png", "post_title": "p" * 200, "source": "higgsfield_soul"}, {"model": "soul"}),
    "tensorart": ({"id": "t", "images": [{"url": "u", "width": 5, "height": 6, "generationData": {"type": "TENSOR_ART_V1", "tensorArtV1": {"baseModel": {"baseModel": "FLUX.1", "label": "dev"}, "models": [{"type": "LORA"}]}}}, {"url": "v", "generationData": {"type": "SD_WEB_V1"}}]}, {"url": "u", "flair": "tensorart:FLUX.1:dev", "has_lora": True}, {}),
    "yodayo": ({"uuid": "y", "photo_media": [{"uuid": "p1", "text_to_image": {"prompt": "x", "extra_networks": []}}, {"uuid": "p2", "text_to_image": {"extra_networks": ["l"]}}]}, {"url": "https://photos.yodayo.com/p1.jpg", "flair": "yodayo:dev"}, {"model": "dev"}),
    "openart": ({"id": "o", "prompt": "x", "ai_model": "Flux", "image": {"raw": "", "raw_width": 7}, "image_url": "i.jpg"}, {"url": "i.jpg", "width": 7, "height": 0}, {"model": "flux"}),
    "aigcarena": ({"EvalResourceId": "e", "ModelName": "Seedream 4.0", "ModelVersionId": "9", "PromptEn": "x", "ModelImages": [{"ImageUri": "", "CompressionImageUri": "c"}]}, {"url": "c", "source": "aigcarena_seedream_40"}, {"wanted": ["seedream"]}),
    "freepik": ({"id": 3, "title": "x", "image": {"type": "photo", "source": {"url": "f.jpg"}}}, {"url": "f.jpg", "flair": "freepik:photo:unknown", "post_id": "3"}, {}),
    "grok_imagine": ({"id": "g", "mediaType": "MEDIA_POST_TYPE_IMAGE", "mediaUrl": "m", "prompt": "x", "modelName": "aurora", "rRated": True}, {"url": "m", "flair": "grok_imagine:api:aurora:nsfw"}, {}),
    "recraft": ({"id": "r", "prompt": "x", "image_url": "u", "model": "recraftv3", "image_type": "realistic_image"}, {"post_id": "r", "flair": "recraft:recraftv3:realistic_image"}, {}),
    "instagram": ({"url": "s", "srcset": "b 1440w", "w": 320, "h": 320, "username": "n"}, {"url": "b", "source": "instagram:n", "flair": "instagram:n"}, {}),
    "twitter": ({"src": "https://pbs.twimg.com/media/a?format=jpg&name=small"}, {"url": "https://pbs.twimg.com/media/a?format=jpg&name=orig", "flair": "direct_search"}, {}),
    "midjourney": ({"id": "99", "content": "**a cat** Upscaled --v 7", "author": {"id": "b"}, "attachments": [{"url": "i.png", "filename": "i.png"}], "components": []}, {"url": "i.png", "flair": "midjourney_v7:v7", "is_upscaled": "true", "post_title": "a cat"}, {"channel": "c", "bot_id": "b", "versions": ["7"]}),
    "reddit": ({"data": {"id": "p", "title": "t", "is_gallery": True, "url": "https://x/y", "media_metadata": {"m": {"status": "valid", "e": "Image", "s": {"u": "a&amp;b"}}}, "created_utc": 5.0}}, {"url": "a&b", "post_id": "p", "source": "reddit"}, {}),
}


@pytest.mark.parametrize("source", sorted(LISTED))
def test_listings(spark, tmp_path, source):
    item, want, options = LISTED[source]
    (tmp_path / "page.json").write_text(json.dumps({"items": [item, {}]}))
    found = listings.CONNECTORS[source](listings.read_pages(spark, str(tmp_path), source, "items"), **options).collect()
    assert len(found) == 1 and {k: found[0][k] for k in want} == want
    none = spark.createDataFrame([], schemas.LISTINGS[source].replace("struct<", "struct<"))
    assert listings.CONNECTORS[source](none, **options).count() == 0


@pytest.mark.parametrize("source", sorted(set(LISTED) - {"twitter"}))
def test_odd_pages(spark, tmp_path, source):
    item, want, options = LISTED[source]
    pages = [{"items": [odd, item]} for odd in (None, 7, "text", [], True, {})] + [{"items": odd} for odd in (None, 7, "text", {}, [])] + [{}, 7, None]
    (tmp_path / "page.json").write_text("\n".join([*map(json.dumps, pages), '{"items": [', "error", ""]))
    texts = spark.read.text(str(tmp_path))
    for found in (listings.read_pages(spark, str(tmp_path), source, "items"), listings.parse_pages(texts, "value", source, "items")):
        rows = listings.CONNECTORS[source](found, **options).collect()
        assert len(rows) == 6 and all({k: r[k] for k in want} == want for r in rows)
    if source == "grok_imagine":  # a list where a URL belongs, and numbers for texts
        lines = [json.dumps(item | {"mediaUrl": ["u"]}), json.dumps(item | {"id": 12, "modelName": 7, "rRated": "yes"})]
        rows = listings.grok_imagine(listings.parse_pages(spark.createDataFrame([(x,) for x in lines], "b string"), "b", source)).collect()
        assert [(r.post_id, r.flair) for r in rows] == [("12", "grok_imagine:api:7")]
    if source == "civitai":
        line = json.dumps(item | {"url": {"u": "v"}})
        assert listings.civitai(listings.parse_pages(spark.createDataFrame([(line,)], "b string"), "b", source), "t").count() == 0


def test_simple_listing_and_tiers(spark, tmp_path):
    (tmp_path / "page.json").write_text(json.dumps(LISTED["civitai"][0]))
    row = listings.civitai_simple(listings.read_pages(spark, str(tmp_path), "civitai"), 7).first()
    assert row.flair == "onsite:model_version:7"
    tiers = spark.createDataFrame([(0, "top", ["a", "b"]), (1, "mid", ["b", "c"])], "ord int, tier string, accounts array<string>")
    assert {r.username: r.tier for r in listings.account_tiers(tiers).collect()} == {"a": "top", "b": "mid", "c": "mid"}


def test_queries_asked(spark):
    assert listings.recraft_queries(spark).count() == 19
    targets = lambda *names: spark.createDataFrame([(n,) for n in names], "target string")
    assert listings.reddit_queries(targets("a", "b"), targets("q")).groupBy("kind").count().orderBy("kind").collect() == [("list", 32), ("search", 9)]
    channels = spark.createDataFrame([("1", 0, "general-2"), ("2", 0, "general-1"), ("3", 2, "general-3"), ("4", 0, None), ("5", 0, "news")], "id string, type int, name string")
    assert [r.id for r in listings.target_channels(channels, r"general-\d").collect()] == ["2", "1"]
    assert [r.id for r in listings.target_channels(channels, "general", ["general-2"]).collect()] == ["1"]


def test_new_items(spark):
    schema = "i int, url string, content_hash string, width int, height int"
    manifest = spark.createDataFrame([(0, "u0", "h0", 9, 9)], schema)
    rows = [(1, "u0", "h1", 900, 900), (2, "u1", "h0", 900, 900), (3, "u2", "h2", 900, 900), (4, "u3", "h2", 900, 900), (5, "u4", "h4", 10, 10), (6, "u5", "h5", 0, 0)]
    got = items.new_items(spark.createDataFrame(rows, schema), manifest, ["i"])
    assert sorted(r.i for r in got.collect()) == [3, 6] and got.columns == manifest.columns or set(got.columns) == set(manifest.columns)


def test_files(spark, tmp_path):
    row = {c.split()[0]: "" for c in schemas.MANIFEST.split(", ")} | {"filename": "a.png", "post_title": 'he said "x",\nand left', "width": "10"}
    df = spark.createDataFrame([tuple(row.values())], schemas.MANIFEST)
    files.append_manifest(df, str(tmp_path / "m"))
    files.append_manifest(df, str(tmp_path / "m"))
    back = files.read_manifest(spark, str(tmp_path / "m")).collect()
    assert len(back) == 2 and back[0].asDict() == row
    assert files.read_manifest(spark, str(tmp_path / "none"), missing_ok=True).count() == 0
    assert files.read_scores(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "captions.json").write_text(json.dumps({"a.png": {"caption": "x"}, "b.png": {"error": "e"}}))
    captions = files.read_captions(spark, str(tmp_path / "captions.json"))
    assert {r.filename: (r.caption, r.error) for r in captions.collect()} == {"a.png": ("x", None), "b.png": (None, "e")}
    assert files.read_captions(spark, str(tmp_path / "no.json")).count() == 0
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "scores.csv").write_text("file,z_score,is_fake,raw_score\n/x/a.png,-2.5,True,0.1\nb.png,,False,\n")
    scores = {r.filename: (r.z_score, r.is_fake) for r in files.read_scores(spark, str(tmp_path / "s")).collect()}
    assert scores == {"a.png": (-2.5, True), "b.png": (None, False)}
    (tmp_path / "dir").mkdir()
    for name in ("a.PNG", "b.txt", "c.webp"):
        (tmp_path / "dir" / name).write_bytes(b"x")
    listing = files.read_listing(spark, str(tmp_path / "dir"))
    assert listing.count() == 3 and files.read_listing(spark, str(tmp_path / "dir"), files.IMAGES).count() == 1
    assert [r.filename for r in files.to_caption(listing, captions).orderBy("filename").collect()] == ["a.PNG", "c.webp"]
    written = spark.createDataFrame([("a", "old", 1), ("a", "new", 2)], "filename string, caption string, written int")
    assert files.latest_captions(written).first().caption == "new"


def png(w, h):
    head = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + head + struct.pack(">I", zlib.crc32(b"IHDR" + head)) + struct.pack(">I", 0) + b"IEND" + b"\0\0\0\0"


def tiff():
    text_at = 8 + 2 + 12 * 3 + 4
    signature = b"Signature: abc\0"
    entries = struct.pack("<HHI4s", 0x010F, 2, 2, b"X\0\0\0") + struct.pack("<HHII", 0x010E, 2, len(signature), text_at) + struct.pack("<HHI4s", 0x013B, 2, 2, b"A\0\0\0")
    return b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 3) + entries + struct.pack("<I", 0) + signature


def jpeg(w, h, q):
    exif = b"Exif\0\0" + tiff()
    part = lambda marker, body: b"\xff" + bytes([marker]) + struct.pack(">H", len(body) + 2) + body
    return b"\xff\xd8" + part(0xE1, exif) + part(0xDB, b"\0" + bytes([q]) * 64) + part(0xC2, struct.pack(">BHHB", 8, h, w, 3)) + b"\xff\xda"


def test_image_bytes(spark, tmp_path):
    webp = b"RIFF\0\0\0\0WEBPVP8X" + struct.pack("<I", 10) + b"\0\0\0\0" + (639).to_bytes(3, "little") + (479).to_bytes(3, "little")
    for name, data in {"a.png": png(30, 20), "b.jpg": jpeg(64, 48, 12), "c.webp": webp, "d.jpg": b"\xff\xd8\xff", "e.jpg": b"no image", "f.png": png(1, 1)[:18]}.items():
        (tmp_path / name).write_bytes(data)
    got = {r.filename: r for r in imagebytes.image_features(spark.read.format("binaryFile").load(str(tmp_path))).collect()}
    assert (got["a.png"].width, got["a.png"].height, got["a.png"].format) == (30, 20, "PNG")
    b = got["b.jpg"]
    assert (b.width, b.height, b.format, b.avg_quantization, b.camera_exif_tags, b.has_generator_exif) == (64, 48, "JPEG", 12.0, ["Make"], True)
    assert (got["c.webp"].width, got["c.webp"].height) == (640, 480)
    assert not any(got[n].opened for n in ("d.jpg", "e.jpg", "f.png"))


# ---------------------------------------------------------------- streaming


def test_resumes_where_it_stopped(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))

    def land(*rows):
        spark.createDataFrame(rows, "url string, n int").coalesce(1).write.mode("append").parquet(src)

    def run():
        incremental.append_to(incremental.new_only(incremental.arriving(spark, src, "url string, n int"), "url"), out, mark).awaitTermination()
        return sorted(r.url for r in spark.read.parquet(out).collect())

    land(("a", 1), ("b", 1), ("a", 2))
    assert run() == ["a", "b"]
    land(("b", 3), ("c", 1))
    assert run() == ["a", "b", "c"]


def test_streaks_between_batches(spark, tmp_path):
    src, out = str(tmp_path / "in"), []
    pages = lambda: incremental.barren_streaks(incremental.arriving(spark, src, "q string, page int, got boolean"), "q", "page", "got", 2)

    def run(*rows):
        spark.createDataFrame(rows, "q string, page int, got boolean").coalesce(1).write.mode("append").parquet(src)
        incremental.for_each_batch(pages(), lambda df, n: out.extend(map(tuple, df.collect())), str(tmp_path / "mark")).awaitTermination()

    run(("a", 0, True), ("a", 1, False))
    run(("a", 2, False), ("a", 3, True))
    assert out == [("a", 0, 0, False), ("a", 1, 1, False), ("a", 2, 2, True)]
