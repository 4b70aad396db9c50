"""Each operator as a query over the driver's tables, and its equivalent in DuckDB's SQL.

The tables have no images, so sizes, formats and flairs are derived from keys by arithmetic that both sides state.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry import config, session
from quarry.config import PostRules
from quarry.functions import shapes, text
from quarry.operators import grids, items, labels, posts, stats, sync, validate
from quarry.sources.versions import Table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- rules that occur in the corpus

REJECT = ["license", "token", "the", "licensed", "en", "la", "que"]
PAIRED = ["is", "of", "de", "un", "der"]
INDICATORS = ["license", "token", "version"]
RULES = PostRules(1_704_844_800, True, [], ["Signup"], ["7", '"k": 1', "25"])


def _sql_word(word: str, col: str = "t") -> str:
    return rf"regexp_matches({col}, '(^|[^\p{{L}}\p{{N}}_]){re.escape(word)}($|[^\p{{L}}\p{{N}}_])')"


def _sql_found(words: list[str]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {_sql_word(w)} THEN '{w}' END" for w in words) + "], lambda x: x IS NOT NULL)"


SQL_SIGNALS = f"list_concat({_sql_found(REJECT)}, CASE WHEN {' OR '.join(_sql_word(w) for w in INDICATORS)} THEN {_sql_found(PAIRED)} ELSE [] END)"


def _signals() -> Column:
    return text.reject_signals(F.col("text"), REJECT, PAIRED, INDICATORS)


@query(f"SELECT doc_id, array_to_string({_sql_found(REJECT)}, ',') AS signals FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents)")
def caption_reject_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.reject_signals(F.col("text"), REJECT), ",").alias("signals"))


@query(f"SELECT doc_id, array_to_string({SQL_SIGNALS}, ',') AS signals FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents)")
def caption_text_paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(_signals(), ",").alias("signals"))


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(t, 'worthless') THEN 'worthless' END, CASE WHEN contains(t, 'pathetic') THEN 'pathetic' END, CASE WHEN contains(t, '@') THEN '@' END], lambda x: x IS NOT NULL), ',') AS blocked FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents)")
def blocked_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.blocked_tags(F.col("text"), ["worthless", "pathetic", "@"]), ",").alias("blocked"))


# ---------------------------------------------------------------- which items are taken


@query("""SELECT doc_id, left(h, 16) || '.jpg' AS filename, CASE WHEN k = 1 THEN 'ok' WHEN source = first THEN 'dup_url' ELSE 'dup_hash' END AS outcome FROM (
    SELECT doc_id, h, source, row_number() OVER w AS k, first_value(source) OVER w AS first FROM (SELECT doc_id, source, sha256(text) AS h FROM documents) WINDOW w AS (PARTITION BY h ORDER BY doc_id))""")
def content_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.col("text").cast("binary")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(content, 256).alias("content_hash"), text.content_name(content, F.lit(".jpg")).alias("filename"))
    by_source = docs.withColumn("url", F.concat_ws("/", "source", "content_hash"))  # each URL has one content
    return items.first_arrivals(by_source, "url", "content_hash", ["doc_id"]).select("doc_id", "filename", "outcome")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def seen_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.unseen(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


SQL_LADDER = """SELECT event_id, CASE WHEN epoch(ts) < 1704844800 THEN 'too_old' WHEN event_type = 'error' THEN 'self_post' WHEN event_type = 'signup' THEN 'flair:signup'
    WHEN contains(t, '7') THEN 'title_keyword:7' WHEN contains(t, '"k": 1') THEN 'title_keyword:"k": 1' WHEN contains(t, '25') THEN 'title_keyword:25' END AS reason FROM (SELECT *, lower(coalesce(props, '')) AS t FROM events)"""


def _skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = F.unix_timestamp(F.col("ts").cast("timestamp"))
    reason = posts.skip_reason(RULES, created, F.col("event_type") == "error", F.col("event_type"), F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", reason.alias("reason"))


@query(SQL_LADDER)
def post_filter_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _skipped(spark, sf_dir)


@query(f"SELECT coalesce(split_part(reason, ':', 1), 'ok') AS kind, count(*) AS n FROM ({SQL_LADDER}) GROUP BY 1")
def post_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts.reason_counts(_skipped(spark, sf_dir))


HOSTS = ["spam-farm.example.org", "www.cheap-pills.example.com", "thther.example.org"]


@query(f"SELECT page_id, host, host IN ({', '.join(repr(h) for h in HOSTS)}) AS allowed, regexp_matches(lower(split_part(url, '?', 1)), '\\.(jpg|jpeg|png|webp)$') AS image FROM (SELECT page_id, url, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) AS host FROM pages)")
def domain_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", text.url_host(url).alias("host"), items.allowed_host(url, HOSTS).alias("allowed"), text.is_image_url(url).alias("image"))


@query("""SELECT page_id, CASE WHEN contains(ct, 'png') OR ends_with(bare, '.png') OR contains(u, 'format=png') THEN '.png' WHEN contains(ct, 'webp') OR ends_with(bare, '.webp') OR contains(u, 'format=webp') THEN '.webp' ELSE '.jpg' END AS ext
    FROM (SELECT page_id, lower(url) AS u, split_part(lower(url), '?', 1) AS bare, CASE page_id % 3 WHEN 0 THEN 'image/PNG' WHEN 1 THEN 'image/webp' ELSE '' END AS ct0, lower(ct0) AS ct FROM pages)""")
def ext_guess(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("page_id") % 3 == 0, "image/PNG").when(F.col("page_id") % 3 == 1, "image/webp").otherwise("")
    return table(spark, sf_dir, "pages").select("page_id", text.extension(F.col("url"), kind).alias("ext"))


# ---------------------------------------------------------------- labels

SOURCES = ["civitai", "tensorart", "openart", "yodayo_flux", "twitter", "grok_imagine", "higgsfield_nano_banana_2", "seedream_v45", "flux_2", "openai_hazel"]
FLAIRS = [
    "onsite:model_version:691639", "onsite:model_version:699279", "onsite:model_version:2439442", "tensorart:FLUX.1 Schnell:x", "tensorart:FLUX.1:DEV-fp16", "flux_kontext",
    "midjourney_v7:vunknown", "midjourney_v7:v8:grid", "V8", "text2image_soul_v2", "soul_cinematic", "SOUL", "nano_banana", "v5_lite", "seedream 4.5", "onsite:model_version:2512167",
    "text2image_gpt", "recraft:recraftv4_pro:any", "recraft:recraftv3:realistic_image",
]
SQL_VERSIONS = {
    "grok": "CASE WHEN contains(s, 'grok_imagine') THEN 'grok' WHEN s = 'civitai' THEN 'grok_civitai' WHEN s = 'twitter' THEN 'grok_twitter' ELSE 'grok' END",
    "flux1": """CASE WHEN s = 'civitai' AND f = 'onsite:model_version:691639' THEN 'dev' WHEN s = 'civitai' AND f = 'onsite:model_version:699279' THEN 'schnell'
        WHEN contains(s, 'flux_kontext') OR contains(f, 'flux_kontext') THEN 'kontext' WHEN s = 'openart' THEN 'unknown_openart'
        WHEN s = 'tensorart' THEN CASE WHEN contains(lower(f), 'schnell') THEN 'schnell' WHEN contains(lower(f), 'dev') THEN 'dev' ELSE 'unknown_tensorart' END
        WHEN contains(s, 'yodayo') OR contains(f, 'yodayo') THEN CASE WHEN contains(lower(f || ' ' || s), 'schnell') THEN 'schnell' ELSE 'dev' END ELSE 'unknown' END""",
    "flux2": "CASE WHEN s = 'civitai' AND f = 'onsite:model_version:2439442' THEN 'pro' WHEN contains(f, 'flux_2') OR contains(s, 'flux_2') THEN 'dev' ELSE 'unknown' END",
    "midjourney_v7": "CASE WHEN contains(lower(f), 'v8') THEN 'v8' ELSE CASE WHEN contains(lower(f), 'v7') THEN 'v7' WHEN contains(lower(f), 'vunknown') THEN 'v7_default' ELSE 'v7' END END",
    "soul2": "CASE WHEN contains(lower(f), 'soul_v2') THEN 'soul_v2' WHEN contains(lower(f), 'soul_cinematic') THEN 'soul_cinematic' WHEN contains(lower(f), 'ai_influencer') THEN 'ai_influencer' WHEN contains(lower(f), 'soul') THEN 'soul_v1' ELSE 'unknown' END",
    "nano_banana_1_2": "CASE WHEN contains(s || ' ' || f, 'nano_banana_2') THEN 'v2' WHEN contains(s || ' ' || f, 'nano_banana') THEN 'v1' ELSE 'unknown' END",
    "seedream4": "CASE WHEN regexp_matches(lower(f), '5\\.0_lite|5_lite|v5_lite') OR regexp_matches(lower(s), '50_lite|v5_lite') THEN 'seedream_5.0_lite' WHEN contains(lower(f), '4.5') OR regexp_matches(lower(s), 'v4_5|v45') OR contains(f, 'model_version:2470991') THEN 'seedream_4.5' ELSE 'seedream_4.0' END",
    "gpt_image_1": "CASE WHEN contains(f, 'model_version:2512167') OR contains(f || ' ' || s, 'openai_hazel') THEN 'gpt-image-1.5' WHEN contains(f, 'model_version:1733399') OR contains(f || ' ' || s, 'text2image_gpt') THEN 'gpt-image-1' ELSE 'unknown' END",
    "recraft_3_4": "CASE WHEN contains(lower(f), 'recraftv4_pro') THEN 'v4_pro' WHEN contains(lower(f), 'recraftv4') THEN 'v4' WHEN contains(lower(f), 'recraftv3') THEN 'v3' ELSE 'unknown' END",
    "instagram_ai_influencer": "'unknown'",
}
SQL_FLAIRED = f"SELECT p_partkey, [{', '.join(repr(x) for x in SOURCES)}][p_partkey % {len(SOURCES)} + 1] AS s, [{', '.join(repr(x) for x in FLAIRS)}][p_partkey % {len(FLAIRS)} + 1] AS f FROM part"


def _picked(values: list[str], key: str) -> Column:
    return F.get(F.array(*map(F.lit, values)), (F.col(key) % len(values)).cast("int"))


def _flaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", _picked(SOURCES, "p_partkey").alias("source"), _picked(FLAIRS, "p_partkey").alias("flair"))


@query(f"SELECT p_partkey, {', '.join(f'{sql} AS {name}' for name, sql in SQL_VERSIONS.items())} FROM ({SQL_FLAIRED})")
def version_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flaired(spark, sf_dir).select("p_partkey", *(labels.model_version(name, F.col("source"), F.col("flair")).alias(name) for name in SQL_VERSIONS))


@query(f"""SELECT CAST(p_partkey AS VARCHAR) AS filename, s AS source, {SQL_VERSIONS['flux1']} AS model_version, '1024' AS width, '768' AS height, 'PNG' AS format, '' AS file_size, p_name AS url, '' AS timestamp
    FROM ({SQL_FLAIRED}) JOIN (SELECT p_partkey, p_name FROM part) USING (p_partkey) WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""")
def metadata_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _flaired(spark, sf_dir).join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey")
    manifest = named.select(F.col("p_partkey").cast("string").alias("filename"), "source", "flair", F.lit("1024").alias("width"), F.lit("768").alias("height"), F.lit("PNG").alias("format"),
                            F.lit(None).cast("string").alias("file_size"), F.col("p_name").alias("url"), F.lit("").alias("timestamp"))
    listing = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("filename"))
    return labels.build_metadata(manifest, listing, "flux1")


@query(f"SELECT model_version, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS percent FROM (SELECT CASE p_partkey % 5 WHEN 0 THEN 'unknown' ELSE {SQL_VERSIONS['flux1']} END AS model_version FROM ({SQL_FLAIRED})) GROUP BY 1")
def version_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of versions; null and empty ones are unknown."""
    version = labels.model_version("flux1", F.col("source"), F.col("flair"))
    gone = F.when(F.col("p_partkey") % 10 == 0, "").when(F.col("p_partkey") % 10 == 5, None).otherwise(version)
    return stats.version_breakdown(_flaired(spark, sf_dir).select(gone.alias("model_version")))


# ---------------------------------------------------------------- reports


@query("SELECT source, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS percent FROM (SELECT split_part(coalesce(source, ''), ':', 1) AS source FROM documents) GROUP BY source")
def source_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.source_breakdown(table(spark, sf_dir, "documents"))


SQL_COUNTS = "SELECT source, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, source) AS k FROM documents GROUP BY source"


@query(f"SELECT CAST(least(k, 9) AS INTEGER) AS rank, CASE WHEN k <= 8 THEN source ELSE '(others)' END AS source, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n) * 100.0 / sum(sum(n)) OVER () AS DOUBLE) AS percent FROM ({SQL_COUNTS}) GROUP BY 1, 2")
def top8_plus_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return stats.top_and_others(counts, "source", 8)


@query("SELECT lang, n, CAST(k AS INTEGER) AS rank FROM (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, lang) AS k, count(*) OVER () AS keys FROM documents GROUP BY lang) WHERE k <= 6 AND keys > 1")
def top6_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.top_if_several(table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n")), "lang", 6)


@query(f"SELECT signal, count(*) AS n FROM (SELECT unnest({SQL_SIGNALS}) AS signal FROM (SELECT lower(coalesce(text, '')) AS t FROM documents)) GROUP BY signal ORDER BY n DESC, signal LIMIT 15")
def signal_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.signal_counts(table(spark, sf_dir, "documents").select(_signals().alias("signals")), "signals", 15)


SQL_Z = "SELECT CASE WHEN event_type = 'error' THEN 'x' WHEN event_type = 'signup' THEN '' ELSE CAST(CAST(value AS DECIMAL(18, 4)) AS VARCHAR) END AS z FROM events"


@query(f"SELECT count(*) AS total, count(*) FILTER (v < 40.0) AS detected, count(*) FILTER (v < 40.0) * 100.0::DOUBLE / count(*) AS rate, round(avg(v), 6) AS mean_z FROM (SELECT TRY_CAST(coalesce(nullif(z, ''), '0') AS DOUBLE) AS v FROM ({SQL_Z})) WHERE v IS NOT NULL")
def score_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = F.when(F.col("event_type") == "error", "x").when(F.col("event_type") == "signup", "").otherwise(F.col("value").cast("decimal(18,4)").cast("string"))
    return stats.score_stats(table(spark, sf_dir, "events").select(z.alias("z_score")), 40.0).withColumn("mean_z", F.round("mean_z", 6))


SQL_STATES = "SELECT lang AS dataset, CASE WHEN quality IS NULL THEN 'staging' WHEN quality = 1 AND toxic = 0 THEN 'images' ELSE 'rejected' END AS state FROM documents LEFT JOIN labels USING (doc_id)"


@query(f"""SELECT *, images + staging AS total, CASE WHEN images + rejected > 0 THEN images * 100.0::DOUBLE / (images + rejected) ELSE 0.0 END AS pass_rate FROM (
    SELECT dataset, grouping(dataset) = 1 AS overall, count(*) FILTER (state = 'images') AS images, count(*) FILTER (state = 'staging') AS staging, count(*) FILTER (state = 'rejected') AS rejected FROM ({SQL_STATES}) GROUP BY ROLLUP (dataset))""")
def state_pivot_passrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("quality").isNull(), "staging").when((F.col("quality") == 1) & (F.col("toxic") == 0), "images").otherwise("rejected")
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return stats.state_counts(joined.select(F.col("lang").alias("dataset"), state.alias("state")))


@query("SELECT host, scheme, count(*) AS n FROM (SELECT split_part(url, '://', 1) AS scheme, regexp_extract(url, '([a-z]+)/', 1) AS host, row_number() OVER (PARTITION BY regexp_extract(url, '([a-z]+)/', 1) ORDER BY page_id) AS k FROM pages) WHERE k <= 100 GROUP BY ALL")
def sample_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "([a-z]+)/", 1).alias("host"), F.split_part("url", F.lit("://"), F.lit(1)).alias("scheme"))
    return stats.sample_counts(pages, "host", "page_id", "scheme")


# ---------------------------------------------------------------- shapes, validation, decisions

W, H = "(512 + (l_partkey * 64) % 3584)", "(512 + (l_suppkey * 96 + l_linenumber * 64) % 3072)"
GROK = config.dataset("grok")
SQL_RATIO = "CASE " + " ".join(f"WHEN abs(w / h - {rw}::DOUBLE / {rh}::DOUBLE) / ({rw}::DOUBLE / {rh}::DOUBLE) <= 0.05 THEN '{config.ratio_label(rw, rh)}'" for rw, rh in GROK.ratios) + " END"


@query(f"SELECT l_orderkey, l_linenumber, {SQL_RATIO} AS ratio FROM (SELECT l_orderkey, l_linenumber, CAST({W} AS DOUBLE) AS w, CAST({H} AS DOUBLE) AS h FROM lineitem)")
def ratio_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(W).alias("w"), F.expr(H).alias("h"))
    return sized.select("l_orderkey", "l_linenumber", shapes.known_ratio(F.col("w"), F.col("h"), GROK.ratios, GROK.ratio_tolerance).alias("ratio"))


SQL_SIZED = f"SELECT l_orderkey, l_linenumber, CAST({W} AS BIGINT) AS w, CAST({H} AS BIGINT) AS h, CAST(floor(l_extendedprice) AS BIGINT) AS size, CASE l_linenumber % 4 WHEN 0 THEN 'PNG' WHEN 1 THEN 'GIF' ELSE 'JPEG' END AS format, l_quantity AS q FROM lineitem"
SQL_FLAGS = f"""list_filter([CASE WHEN format = 'GIF' THEN 'unexpected_format' END, CASE WHEN w * h < 800000 THEN 'too_few_pixels' END, CASE WHEN w * h > 5000000 THEN 'too_many_pixels' END,
    CASE WHEN {SQL_RATIO.replace('w / h', 'w::DOUBLE / h::DOUBLE')} IS NULL THEN 'non_native_aspect_ratio' END, CASE WHEN format = 'JPEG' AND q > 40.0 THEN 'high_compression' END], lambda x: x IS NOT NULL)"""


@query(f"SELECT l_orderkey, l_linenumber, array_to_string(flags, ',') AS flags, len(flags) = 0 AS structural_passed, size::DOUBLE * 8.0::DOUBLE / (w * h)::DOUBLE AS bpp FROM (SELECT *, {SQL_FLAGS} AS flags FROM ({SQL_SIZED}))")
def structural_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    fmt = F.when(F.col("l_linenumber") % 4 == 0, "PNG").when(F.col("l_linenumber") % 4 == 1, "GIF").otherwise("JPEG")
    sized = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(W).alias("width"), F.expr(H).alias("height"), F.floor("l_extendedprice").alias("file_size"), fmt.alias("format"),
                                                    F.col("l_quantity").alias("avg_quantization"), F.array().cast("array<string>").alias("camera_exif_tags"), F.lit(True).alias("opened"))
    flagged = validate.structural(sized, GROK)
    return flagged.select("l_orderkey", "l_linenumber", F.array_join("flags", ",").alias("flags"), "structural_passed", "bpp")


DOC_W, DOC_H = "(700 + (n_chars * 7) % 2500)", "(700 + (n_chars * 3 + doc_id * 16) % 2100)"
SUFFIX = {"es": ".webp", "de": ".PNG"}
RULE_DATASET = config.DatasetConfig("corpus", 800_000, 5_000_000, ["JPEG", "PNG"], 40.0, GROK.ratios, 0.05, [], ["license", "token"], PAIRED, INDICATORS)


def decided(spark: SparkSession, sf_dir: str, relaxed: bool = False, fsd_mode: str = "filter") -> DataFrame:
    """The documents as images: all but French ones captioned by their text, scores from labels."""
    docs = table(spark, sf_dir, "documents")
    suffix = F.when(F.col("lang") == "es", SUFFIX["es"]).when(F.col("lang") == "de", SUFFIX["de"]).otherwise(".jpg")
    named = docs.withColumn("filename", F.concat(F.col("doc_id").cast("string"), suffix))
    sized = named.select("doc_id", "filename", F.expr(DOC_W).alias("width"), F.expr(DOC_H).alias("height"), F.lit("JPEG").alias("format"), F.col("n_chars").alias("file_size"), (F.col("n_chars") % 50).cast("double").alias("avg_quantization"),
                         F.array().cast("array<string>").alias("camera_exif_tags"), (F.col("doc_id") % 97 != 5).alias("opened"))
    none = F.lit(None)
    captions = named.filter("lang <> 'fr'").select("filename", F.col("text").alias("caption"), none.cast("boolean").alias("should_reject"), none.cast("array<string>").alias("reject_signals"), F.when(F.col("doc_id") % 31 == 7, "timeout").alias("error"))
    known = named.select("doc_id", "filename").join(table(spark, sf_dir, "labels"), "doc_id")
    scores = known.select("filename", F.lit(-3.0).alias("z_score"), (F.col("quality") == 1).alias("is_fake"))
    return validate.decide(validate.structural(sized, RULE_DATASET), validate.reclassified(captions, RULE_DATASET), scores, relaxed, fsd_mode)


SQL_DECIDED = f"""
    WITH d AS (SELECT doc_id, lang, lower(coalesce(text, '')) AS t, CAST({DOC_W} AS DOUBLE) AS w, CAST({DOC_H} AS DOUBLE) AS h, n_chars % 50 > 40 AS heavy, doc_id % 97 <> 5 AS opened, lang <> 'fr' AS captioned, doc_id % 31 = 7 AS failed FROM documents),
    s AS (SELECT d.*, l.quality, l.doc_id IS NOT NULL AS scored, captioned AND (failed OR {_sql_word('license')} OR {_sql_word('token')}) AS rejects,
        {SQL_RATIO} IS NULL AS shape FROM d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    r AS (SELECT *, CASE WHEN rejects THEN 0 WHEN lang <> 'es' AND captioned THEN 1 END AS tier,
        list_filter([CASE WHEN opened AND w * h < 800000 THEN 'too_small' END, CASE WHEN opened AND w * h > 5000000 THEN 'too_large' END, CASE WHEN opened AND shape THEN 'bad_aspect_ratio' END,
            CASE WHEN opened AND heavy THEN 'high_compression' END, CASE WHEN scored AND quality <> 1 THEN 'fsd_real' END], lambda x: x IS NOT NULL) AS reasons FROM s)"""


@query(SQL_DECIDED + """ SELECT doc_id, CAST(tier AS INTEGER) AS tier, CASE WHEN tier = 0 THEN 'rejected' WHEN tier IS NULL THEN 'staging' WHEN len(reasons) = 0 THEN 'images' ELSE 'rejected' END AS state,
    CASE WHEN tier = 1 THEN array_to_string(reasons, ',') ELSE '' END AS reasons FROM r""")
def decide_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decided(spark, sf_dir).select("doc_id", "tier", "state", F.array_join("reasons", ",").alias("reasons"))


@query(SQL_DECIDED + " SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM r WHERE tier = 1) GROUP BY reason")
def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.reason_histogram(decided(spark, sf_dir))


@query(SQL_DECIDED + """ SELECT total, passed, rejected, reasons FROM (SELECT count(*) AS total, count(*) FILTER (len(reasons) = 0) AS passed, count(*) FILTER (len(reasons) > 0) AS rejected FROM r WHERE tier = 1),
    (SELECT string_agg(reason || '=' || n, ',' ORDER BY reason) AS reasons FROM (SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM r WHERE tier = 1) GROUP BY reason))""")
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = validate.report(decided(spark, sf_dir), relaxed=False).select(F.from_json("report", "total bigint, passed bigint, rejected bigint, rejection_reasons map<string,bigint>").alias("r"))
    entries = F.transform(F.array_sort(F.map_entries("r.rejection_reasons")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return parsed.select("r.total", "r.passed", "r.rejected", F.array_join(entries, ",").alias("reasons"))


@query(SQL_DECIDED + " SELECT doc_id || CASE lang WHEN 'de' THEN '.PNG' ELSE '.jpg' END AS filename, len(reasons) = 0 AS passed, CASE WHEN len(reasons) = 0 THEN 'images' ELSE 'rejected' END AS destination, array_to_string(reasons, ',') AS reasons FROM r WHERE tier = 1")
def validation_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = "filename string, passed boolean, destination string, reasons array<string>"
    rows = validate.report_images(decided(spark, sf_dir)).select(F.from_json("image", entry).alias("i")).select("i.*")
    return rows.withColumn("reasons", F.array_join("reasons", ","))


@query("""SELECT coalesce(CAST(d.doc_id AS VARCHAR), CAST(l.doc_id AS VARCHAR)) AS filename, CASE WHEN d.doc_id IS NULL THEN 'not_found' WHEN l.doc_id IS NULL THEN 'none' WHEN d.lang = 'en' THEN 'moved' ELSE 'not_found' END AS action,
    CASE WHEN d.doc_id IS NULL THEN NULL WHEN d.lang <> 'en' THEN 'images' WHEN l.doc_id IS NULL THEN 'staging' WHEN l.quality = 1 THEN 'images' ELSE 'rejected' END AS state FROM documents d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id""")
def review_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("filename"), F.when(F.col("lang") == "en", "staging").otherwise("images").alias("state"))
    classes = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("filename"), F.when(F.col("quality") == 1, "ai_art").otherwise("meme").alias("category"))
    return validate.reviewed(docs, classes).select("filename", "action", "state")


@query("""SELECT action, CASE WHEN action = 'moved' THEN state END AS state, count(*) AS n FROM (
    SELECT CASE WHEN d.doc_id IS NULL THEN 'not_found' WHEN l.doc_id IS NULL THEN 'none' WHEN d.lang = 'en' THEN 'moved' ELSE 'not_found' END AS action, CASE WHEN l.quality = 1 THEN 'images' ELSE 'rejected' END AS state
    FROM documents d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id) GROUP BY ALL""")
def review_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("filename"), F.when(F.col("lang") == "en", "staging").otherwise("images").alias("state"))
    classes = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("filename"), F.when(F.col("quality") == 1, "ai_art").otherwise("meme").alias("category"))
    return validate.review_counts(validate.reviewed(docs, classes))


SQL_RATIOS = "(VALUES " + ", ".join(f"('{n}', {w}, {h})" for n in config.dataset_names() for w, h in config.dataset(n).ratios) + ") r(dataset, rw, rh)"


@query(f"""SELECT dataset, count(DISTINCT i) AS n FROM (SELECT row_number() OVER () AS i, CAST({W} AS DOUBLE) AS w, CAST({H} AS DOUBLE) AS h FROM lineitem), {SQL_RATIOS}
    WHERE abs(w / h - rw::DOUBLE / rh::DOUBLE) / (rw::DOUBLE / rh::DOUBLE) <= 0.05 GROUP BY dataset""")
def dataset_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many items have a known ratio of each dataset: the dimension of ratios is met item by item, its tolerance with it."""
    ratios = config.dim_ratio(spark).select("dataset", F.struct("w", "h").alias("ratio")).groupBy("dataset").agg(F.collect_set("ratio").alias("ratios"))
    sized = table(spark, sf_dir, "lineitem").select(F.expr(W).cast("double").alias("w"), F.expr(H).cast("double").alias("h")).groupBy("w", "h").agg(F.count("*").alias("n"))
    ratio = F.col("w") / F.col("h")
    met = sized.crossJoin(F.broadcast(ratios)).filter(F.exists("ratios", lambda r: F.abs(ratio - r["w"] / r["h"]) / (r["w"] / r["h"]) <= 0.05))
    return met.groupBy("dataset").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- composite images

GRID_SIZES = ["1024x1024", "2048x2048", "1792x2624", "2912x1632", "1501x3001", "3000x2000", "1000x1000", "abcx10", "656x448", "2602x2600"]
SQL_GRID_ROWS = f"SELECT o_orderkey, o_orderkey || '.png' AS filename, split_part(s, 'x', 1) AS width, split_part(s, 'x', 2) AS height, CASE o_orderkey % 7 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE '' END AS is_upscaled, 'midjourney_v7:v7:grid' AS flair FROM (SELECT o_orderkey, [{', '.join(repr(x) for x in GRID_SIZES)}][o_custkey % {len(GRID_SIZES)} + 1] AS s FROM orders)"
SQL_TILES = "(VALUES " + ", ".join(f"({w}, {h})" for w, h in grids.TILES) + ") t(w, h)"
SQL_GRID = f"""SELECT *, CASE WHEN x IS NULL OR y IS NULL THEN 'unknown' WHEN is_upscaled = 'true' OR (x, y) IN (SELECT (w, h) FROM {SQL_TILES}) THEN 'single'
    WHEN (x, y) IN (SELECT (w * 2, h * 2) FROM {SQL_TILES}) OR (x % 2 = 0 AND y % 2 = 0 AND x * y > 3500000) THEN 'grid' ELSE 'unknown' END AS grid_class FROM (SELECT *, TRY_CAST(width AS INTEGER) AS x, TRY_CAST(height AS INTEGER) AS y FROM ({SQL_GRID_ROWS}))"""
SQL_TILE_ROWS = f"""SELECT o_orderkey, o_orderkey || '_' || i || '.png' AS filename, CAST(CASE WHEN i % 2 = 1 THEN x - x // 2 ELSE x // 2 END AS VARCHAR) AS width, CAST(CASE WHEN i >= 2 THEN y - y // 2 ELSE y // 2 END AS VARCHAR) AS height,
    replace(flair, ':grid', ':tile' || i) AS flair FROM ({SQL_GRID}), (SELECT unnest([0, 1, 2, 3]) AS i) WHERE grid_class = 'grid'"""


def _grid_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.get(F.array(*map(F.lit, GRID_SIZES)), (F.col("o_custkey") % len(GRID_SIZES)).cast("int"))
    up = F.when(F.col("o_orderkey") % 7 == 0, "true").when(F.col("o_orderkey") % 7 == 1, "false").otherwise("")
    part = lambda k: F.split_part(size, F.lit("x"), F.lit(k))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.col("o_orderkey").cast("string"), F.lit(".png")).alias("filename"), part(1).alias("width"), part(2).alias("height"), up.alias("is_upscaled"), F.lit("midjourney_v7:v7:grid").alias("flair"))


@query(f"SELECT o_orderkey, grid_class FROM ({SQL_GRID})")
def grid_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.classified(_grid_manifest(spark, sf_dir)).select("o_orderkey", "grid_class")


@query(SQL_TILE_ROWS)
def grid_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = grids.classified(_grid_manifest(spark, sf_dir)).filter("grid_class = 'grid'")
    tiles = grids.tile_rows(marked)
    return tiles.select("o_orderkey", "filename", F.col("width").cast("string").alias("width"), F.col("height").cast("string").alias("height"), "flair")


@query(f"SELECT o_orderkey, filename, width, height, flair FROM ({SQL_GRID}) WHERE grid_class <> 'grid' UNION ALL {SQL_TILE_ROWS}")
def manifest_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.split(_grid_manifest(spark, sf_dir)).select("o_orderkey", "filename", "width", "height", "flair")


@query(f"""WITH g AS (SELECT *, row_number() OVER (ORDER BY filename) AS k FROM ({SQL_GRID}) WHERE grid_class = 'grid'), t AS ({SQL_TILE_ROWS})
    SELECT o_orderkey, filename, width, height, flair FROM ({SQL_GRID}) WHERE filename NOT IN (SELECT filename FROM g WHERE k <= 25)
    UNION ALL SELECT t.* FROM t WHERE o_orderkey IN (SELECT o_orderkey FROM g WHERE k <= 25)""")
def grid_split_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 composites, by name, are split; the others stay."""
    return grids.split(_grid_manifest(spark, sf_dir), limit=25).select("o_orderkey", "filename", "width", "height", "flair")


@query(f"""WITH after AS (SELECT o_orderkey, filename, width, height, flair FROM ({SQL_GRID}) WHERE grid_class <> 'grid' UNION ALL {SQL_TILE_ROWS})
    SELECT 1 AS version, count(*) AS n, CAST(sum(TRY_CAST(width AS BIGINT)) AS BIGINT) AS width FROM ({SQL_GRID}) UNION ALL SELECT 2, count(*), CAST(sum(TRY_CAST(width AS BIGINT)) AS BIGINT) FROM after""")
def manifest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest rewritten as a new version: the first writer fails before it commits, the second one is read; the old version is the backup."""
    manifest = Table(spark, session.scratch(spark, "versions"))
    before = _grid_manifest(spark, sf_dir)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in before.schema.fields)
    manifest.append(before)
    split = grids.split(manifest.read(schema).drop("_part"))
    manifest.write(split)  # rows that no version names: the writer was lost here
    manifest.replace(split)
    counts = [manifest.read(schema, v).agg(F.count("*").alias("n"), F.sum(F.col("width").try_cast("bigint")).alias("width")).withColumn("version", F.lit(v)) for v in manifest.versions()]
    return counts[0].unionByName(counts[1]).select("version", "n", "width")


@query(f"SELECT CASE WHEN o_custkey IN (SELECT l_suppkey FROM lineitem) THEN grid_class ELSE 'missing' END AS grid_class, count(*) AS n FROM ({SQL_GRID}) JOIN (SELECT o_orderkey, o_custkey FROM orders) USING (o_orderkey) GROUP BY 1")
def grid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplied = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("o_custkey")).distinct()
    there = table(spark, sf_dir, "orders").join(supplied, "o_custkey", "left_semi").select(F.concat(F.col("o_orderkey").cast("string"), F.lit(".png")).alias("filename"))
    return grids.class_counts(_grid_manifest(spark, sf_dir), there)


# ---------------------------------------------------------------- caps, streaks, ids


@query("SELECT o_orderkey, o_orderpriority, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderkey) AS k FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority LIKE '1%') WHERE k <= 50")
def combo_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    priorities, states = orders.select("o_orderpriority").distinct(), orders.select("o_orderstatus").distinct()
    combos = items.combinations(priorities, states, (F.col("o_orderstatus") != "P") | F.col("o_orderpriority").startswith("1"))
    found = orders.join(F.broadcast(combos), ["o_orderpriority", "o_orderstatus"])
    return items.capped(found, ["o_orderpriority", "o_orderstatus"], ["o_orderkey"], 50).select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query("SELECT event_id, user_id FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) WHERE k <= 3")
def per_group_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.capped(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], 3).select("event_id", "user_id")


SQL_STREAK = "SELECT *, sum(CASE WHEN yielded THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, island ORDER BY event_id) AS streak FROM (SELECT event_id, user_id, event_type = 'purchase' AS yielded, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM events)"


@query(f"SELECT event_id, user_id, CAST(streak AS BIGINT) AS streak FROM (SELECT *, max(CASE WHEN streak >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stopped FROM ({SQL_STREAK})) WHERE coalesce(stopped, 0) = 0")
def zero_yield_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "events").select("event_id", "user_id", (F.col("event_type") == "purchase").alias("yielded"))
    return items.until_barren(pages, ["user_id"], "event_id", F.col("yielded"), 3).select("event_id", "user_id", "streak")


@query("SELECT event_id, (epoch_us(ts) // 1000 - 1420070400000) << 22 AS snowflake, epoch_us(ts) // 1000 AS ms FROM events")
def snowflake_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    ids = table(spark, sf_dir, "events").select("event_id", text.snowflake_of(ms).alias("snowflake"))
    return ids.withColumn("ms", text.snowflake_ms(F.col("snowflake")))


@query("SELECT CAST(d AS DATE) AS day, count(event_id) AS n FROM (SELECT unnest(range(1, 31)) AS k), LATERAL (SELECT DATE '2024-01-31' - CAST(k AS INTEGER) AS d) LEFT JOIN events ON CAST(ts AS DATE) = d GROUP BY 1")
def date_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = spark.range(1).select(F.explode(items.date_windows(F.lit("2024-01-31").cast("date"), 30)).alias("day"))
    events = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return days.join(events, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


# ---------------------------------------------------------------- nested text


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '(?is)<title>\\s*(.*?)\\s*</title>', 1)), ''), '') AS title FROM pages")
def tag_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(text.tagged(F.col("html"), "title", True), F.lit("")).alias("title"))


@query("""SELECT conv_id, turn, upper(role) AS category, role IN ('user', 'system') AS is_ai_art, left(trim(text), 200) AS reason FROM conversations""")
def answer_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    yes = F.when(F.col("role").isin("user", "system"), "Yes").otherwise("no")
    content = F.concat(F.lit("<Category> "), F.col("role"), F.lit("</category><is_ai_art>"), yes, F.lit("</IS_AI_ART><reason>"), F.col("text"), F.lit("</reason>"))
    parsed = table(spark, sf_dir, "conversations").select("conv_id", "turn", text.parsed_answer(content).alias("p"))
    return parsed.select("conv_id", "turn", "p.category", "p.is_ai_art", "p.reason")


@query("SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS INTEGER) AS place, role, length(text) AS n FROM conversations")
def turn_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns are numbered within their conversation by rank, so that no conversation has to fit in one array."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")) - 1
    return table(spark, sf_dir, "conversations").select("conv_id", place.alias("place"), "role", F.length("text").cast("bigint").alias("n"))


@query("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'copy' WHEN d.doc_id IS NULL THEN 'delete' WHEN d.v IS NOT DISTINCT FROM l.quality THEN 'keep' ELSE 'update' END AS action FROM (SELECT doc_id, CAST(n_chars % 2 AS INTEGER) AS v FROM documents) d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id")
def sync_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") % 2).cast("int").alias("v"))
    return sync.sync_plan(source, table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("v")), "doc_id", "v")


@query("""SELECT "by", page, count(*) AS n, sha256('<main>' || string_agg('<figure><img src="' || replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '"', '&quot;') || '"><figcaption>' || page_id || '</figcaption></figure>', chr(10) ORDER BY page_id) || '</main>') AS html FROM (
    SELECT page_id, coalesce(url, '') AS url, split_part(url, '://', 1) AS "by", CAST((row_number() OVER (PARTITION BY split_part(url, '://', 1) ORDER BY page_id) - 1) // 500 AS INTEGER) AS page FROM pages) GROUP BY ALL""")
def contact_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.split_part("url", F.lit("://"), F.lit(1)).alias("by"))
    return sync.contact_sheet(pages, "by", "page_id", "url", "page_id").select("by", "page", "n", F.sha2("html", 256).alias("html"))


@query("""SELECT coalesce(s.k, t.k) AS path, CASE WHEN t.k IS NULL THEN 'copy' WHEN s.k IS NULL THEN 'delete' WHEN s.v IS NOT DISTINCT FROM t.v THEN 'keep' ELSE 'update' END AS action
    FROM (SELECT source || '/' || doc_id AS k, n_chars AS v FROM documents WHERE doc_id % 211 <> 5 AND source IS NOT NULL) s
    FULL OUTER JOIN (SELECT source || '/' || doc_id AS k, CASE WHEN doc_id % 97 = 3 THEN n_chars + 1 ELSE n_chars END AS v FROM documents WHERE doc_id % 307 <> 11 AND source IS NOT NULL) t ON s.k = t.k""")
def sync_by_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror that is nearly up to date: only what differs by its digests is joined."""
    docs = table(spark, sf_dir, "documents").filter("source IS NOT NULL").withColumn("path", F.concat("source", F.lit("/"), "doc_id"))
    source = docs.filter("doc_id % 211 <> 5").select("path", F.col("n_chars").cast("bigint").alias("v"))
    target = docs.filter("doc_id % 307 <> 11").select("path", F.when(F.col("doc_id") % 97 == 3, F.col("n_chars") + 1).otherwise(F.col("n_chars")).cast("bigint").alias("v"))
    return sync.sync_plan_by_digests(source, target, "path", "v")


FULL_LIST = config.dataset("grok").reject


@query(f"SELECT doc_id, array_to_string({_sql_found(FULL_LIST + REJECT)}, ',') AS signals FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents)")
def caption_full_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reject words of a dataset, and some that occur here, in one pass over each text."""
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.reject_signals(F.col("text"), FULL_LIST + REJECT), ",").alias("signals"))


@query("SELECT CASE WHEN doc_id % 31 = 7 THEN 'error' WHEN quality = 0 THEN 'rejected' ELSE 'passed' END AS bucket, count(*) AS n FROM labels GROUP BY 1")
def caption_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    captions = table(spark, sf_dir, "labels").select(F.when(F.col("doc_id") % 31 == 7, "timeout").alias("error"), (F.col("quality") == 0).alias("should_reject"))
    return stats.caption_buckets(captions)


@query("SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source")
def manifest_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.one_of_each(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", ["doc_id"])
