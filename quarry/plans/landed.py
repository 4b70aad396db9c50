"""Queries over landed pages and files: each connector, the tables on disk, image headers, resumable runs.

The pages' JSON is made of the driver's tables by arithmetic on their keys, which the SQL states as what should come out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry import schemas
from quarry.config import DatasetConfig
from quarry.functions import shapes, text
from quarry.operators import items, validate
from quarry.plans.queries import query, table
from quarry.sources import files, imagebytes, listings
from quarry.sources.versions import Table
from quarry.streaming import incremental

K = "p_partkey"


def landed(spark: SparkSession, sf_dir: str, source: str, item: str) -> DataFrame:
    """Items of pages, of two items each, that a source's API could have given; read back by its schema."""
    rows = table(spark, sf_dir, "part").select(F.floor(F.col(K) / 2).alias("page"), F.expr(f"named_struct({item})").alias("v"))
    pages = rows.groupBy("page").agg(F.to_json(F.struct(F.collect_list("v").alias("items"))).alias("body"))
    return listings.parse_pages(pages, "body", source, "items")


CIVITAI = f"""'id', {K}, 'url', if({K} % 7 = 0, null, concat('u', {K})), 'name', CASE {K} % 4 WHEN 0 THEN null WHEN 1 THEN concat('generator_import_', {K}, '.png') ELSE concat({K}, '.jpeg') END,
    'type', if({K} % 5 = 0, 'video', 'image'), 'mimeType', if({K} % 6 = 0, 'video/mp4', 'image/png'), 'postTitle', if({K} % 9 = 0, null, p_name)"""
SQL_CIVITAI = f"""SELECT '{listings.CIVITAI_CDN}/u' || {K} || '/original=true/' || CASE {K} % 4 WHEN 0 THEN 'u' || {K} || '.jpg' WHEN 1 THEN 'generator_import_' || {K} || '.png' ELSE {K} || '.jpeg' END AS url,
    CAST({K} AS VARCHAR) AS post_id, CASE WHEN {K} % 9 = 0 THEN '' ELSE left(p_name, 200) END AS post_title, <flair> AS flair, 'civitai' AS source FROM part WHERE {K} % 7 <> 0 AND {K} % 5 <> 0 AND {K} % 6 <> 0"""


@query(SQL_CIVITAI.replace("<flair>", f"CASE WHEN {K} % 4 = 1 THEN 'onsite:tool' ELSE 'tool' END"))
def listing_civitai(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.civitai(landed(spark, sf_dir, "civitai", CIVITAI), "tool")


@query(SQL_CIVITAI.replace("<flair>", "'onsite:model_version:7'"))
def listing_civitai_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.civitai_simple(landed(spark, sf_dir, "civitai", CIVITAI), 7)


@query(f"""SELECT CASE WHEN {K} % 3 <> 0 AND {K} % 4 <> 0 THEN 'https://r/' || {K} ELSE 'https://s/' || {K} END AS url, CAST({K} AS VARCHAR) AS post_id, left(p_name, 200) AS post_title, 'soul' AS flair, 'higgsfield_soul' AS source
    FROM part WHERE CASE WHEN {K} % 3 <> 0 THEN {K} % 5 <> 0 ELSE {K} % 2 = 0 END""")
def listing_higgsfield(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = f"if({K} % 3 = 0, null, named_struct('raw', named_struct('url', if({K} % 4 = 0, '', concat('https://r/', {K})), 'type', if({K} % 5 = 0, 'video', 'image'))))"
    result = f"named_struct('url', concat('https://s/', {K}), 'type', if({K} % 2 = 0, 'image', 'video'))"
    return listings.higgsfield(landed(spark, sf_dir, "higgsfield", f"'id', string({K}), 'results', {raw}, 'result', {result}, 'params', named_struct('prompt', p_name)"), "soul")


@query(f"""SELECT CASE {K} % 5 WHEN 0 THEN 'https://i.redd.it/' || {K} || '.PNG?x=1' WHEN 1 THEN 'https://p.redd.it/' || {K} || '?a=1&b=2' ELSE 'https://v.redd.it/' || {K} || '&z' END AS url, 't' || {K} AS post_id, left(p_name, 200) AS post_title,
    CASE WHEN {K} % 3 = 0 THEN '' ELSE p_type END AS flair, 'reddit' AS source, p_brand AS subreddit, CAST({K} AS DOUBLE) AS created_utc, {K} % 11 = 0 AS is_self FROM part WHERE {K} % 5 < 3 AND {K} % 13 <> 0""")
def listing_reddit(spark: SparkSession, sf_dir: str) -> DataFrame:
    gallery = f"""map('a', named_struct('status', 'valid', 'e', 'Image', 's', named_struct('u', concat('https://p.redd.it/', {K}, '?a=1&amp;b=2'))), 'b', named_struct('status', 'failed', 'e', 'Image', 's', named_struct('u', 'x')))"""
    preview = f"named_struct('images', array(named_struct('source', named_struct('url', concat('https://v.redd.it/', {K}, '&amp;z')))))"
    post = f"""'id', concat('t', {K}), 'title', p_name, 'subreddit', p_brand, 'link_flair_text', if({K} % 3 = 0, null, p_type), 'url', if({K} % 5 = 0, concat('https://i.redd.it/', {K}, '.PNG?x=1'), concat('https://www.reddit.com/gallery/', {K})),
        'is_self', {K} % 11 = 0, 'is_video', {K} % 13 = 0, 'is_gallery', {K} % 5 = 1, 'created_utc', double({K}), 'media_metadata', if({K} % 5 = 1, {gallery}, null), 'preview', if({K} % 5 IN (1, 2), {preview}, null)"""
    return listings.reddit(landed(spark, sf_dir, "reddit", f"'data', named_struct({post})"))


SQL_MIDJOURNEY = f"""SELECT *, CASE WHEN {K} % 5 = 0 THEN '8' ELSE flag END AS v FROM (SELECT *, CASE {K} % 3 WHEN 0 THEN '7' WHEN 1 THEN '6.1' ELSE '8' END AS flag, CASE WHEN {K} % 4 = 0 THEN ' Upscaled' ELSE '' END AS up FROM part)"""


@query(f"""SELECT 'https://cdn/' || {K} || '.png' AS url, CAST({K} * 10 AS VARCHAR) AS post_id, left(p_name, 200) AS post_title, 'midjourney_v7:v' || v || CASE WHEN up = '' THEN ':grid' ELSE '' END AS flair, 'discord_midjourney_v7' AS source,
    'discord:general' AS subreddit, left('**' || p_name || '** --v ' || flag || up, 500) AS message_content, CASE WHEN up = '' THEN 'false' ELSE 'true' END AS is_upscaled FROM ({SQL_MIDJOURNEY}) WHERE {K} % 6 <> 0 AND {K} >= 50 AND v <> '6.1'""")
def listing_midjourney(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = f"""'id', string({K} * 10), 'content', concat('**', p_name, '** --v ', CASE {K} % 3 WHEN 0 THEN '7' WHEN 1 THEN '6.1' ELSE '8' END, if({K} % 4 = 0, ' Upscaled', '')), 'author', named_struct('id', if({K} % 6 = 0, '43', '42')),
        'attachments', array(named_struct('url', concat('https://cdn/', {K}, '.txt'), 'filename', 'a.txt', 'content_type', 'text/plain'), named_struct('url', concat('https://cdn/', {K}, '.png'), 'filename', if({K} % 2 = 0, 'a.PNG', 'b'), 'content_type', if({K} % 2 = 0, null, 'image/png'))),
        'components', if({K} % 5 = 0, array(named_struct('components', array(named_struct('custom_id', 'MJ::x_v8::1')))), null)"""
    return listings.midjourney(landed(spark, sf_dir, "midjourney", message), "general", "42", ["7", "8"], 500)


@query(f"""SELECT 'https://t/' || {K} AS url, CAST({K} AS VARCHAR) AS post_id, left(p_name, 200) AS post_title, 'tensorart:FLUX.1:' || CASE WHEN {K} % 5 = 0 THEN '' ELSE p_brand END AS flair, 'tensorart' AS source, p_size AS width, CAST({K} % 100 AS INTEGER) AS height, {K} % 2 = 0 AS has_lora
    FROM part WHERE {K} % 4 <> 0 AND {K} % 3 <> 0""")
def listing_tensorart(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = f"""named_struct('type', if({K} % 4 = 0, 'OTHER', 'TENSOR_ART_V1'), 'tensorArtV1', named_struct('baseModel', named_struct('baseModel', if({K} % 3 = 0, 'SDXL', 'FLUX.1'), 'label', if({K} % 5 = 0, null, p_brand)),
        'models', array(named_struct('type', if({K} % 2 = 0, 'LORA', 'CHECKPOINT')))))"""
    image = f"named_struct('url', concat('https://t/', {K}), 'width', p_size, 'height', {K} % 100, 'generationData', {made}), named_struct('url', '', 'width', 1, 'height', 1, 'generationData', {made})"
    return listings.tensorart(landed(spark, sf_dir, "tensorart", f"'id', string({K}), 'title', p_name, 'images', array({image})"))


@query(f"""SELECT '{listings.YODAYO_CDN}/' || m || {K} || '.jpg' AS url, 'p' || {K} AS post_id, left(p_name, 200) AS post_title, 'yodayo:flux' AS flair, 'yodayo_flux' AS source FROM part, (VALUES ('m'), ('n')) x(m) WHERE m = 'n' OR ({K} % 3 <> 0 AND {K} % 4 <> 0)""")
def listing_yodayo(spark: SparkSession, sf_dir: str) -> DataFrame:
    def photo(uuid: str, networks: str) -> str:
        return f"named_struct('uuid', {uuid}, 'text_to_image', named_struct('model', 'x', 'prompt', p_name, 'extra_networks', {networks}))"

    own = photo(f"if({K} % 3 = 0, null, concat('m', {K}))", f"if({K} % 4 = 0, array('lora'), cast(array() AS array<string>))")
    return listings.yodayo(landed(spark, sf_dir, "yodayo", f"'uuid', concat('p', {K}), 'photo_media', array({own}, {photo(f'concat(chr(110), {K})', 'cast(null AS array<string>)')})"), "flux")


@query(f"""SELECT CASE WHEN {K} % 3 = 0 THEN 'https://w/' || {K} ELSE 'https://o/' || {K} END AS url, CAST({K} AS VARCHAR) AS post_id, left(p_name, 200) AS post_title, 'openart:FLUX' AS flair, 'openart' AS source,
    CAST(CASE WHEN {K} % 5 = 0 THEN {K} ELSE p_size END AS INTEGER) AS width, CAST({K} + 1 AS INTEGER) AS height FROM part WHERE {K} % 2 = 0""")
def listing_openart(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = f"""'id', string({K}), 'prompt', p_name, 'ai_model', if({K} % 2 = 0, 'FLUX', 'sdxl'), 'image', named_struct('raw', if({K} % 3 = 0, '', concat('https://o/', {K})), 'raw_width', {K}, 'raw_height', {K} + 1), 'image_url', concat('https://w/', {K}),
        'image_width', if({K} % 5 = 0, 0, p_size)"""
    return listings.openart(landed(spark, sf_dir, "openart", item), "Flux")


@query(f"""SELECT CASE WHEN {K} % 4 = 0 THEN 'https://c/' || {K} ELSE 'https://a/' || {K} END AS url, CAST({K} AS VARCHAR) AS post_id, left(p_name, 200) AS post_title, 'aigcarena:' || p_brand || ':v' || p_size AS flair, 'aigcarena_' || replace(lower(p_brand), ' ', '_') AS source
    FROM part WHERE {K} % 10 <> 0 AND contains(lower(p_brand), 'brand#1')""")
def listing_aigcarena(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = f"""'EvalResourceId', string({K}), 'ModelName', if({K} % 10 = 0, null, p_brand), 'ModelVersionId', concat('v', p_size), 'PromptEn', p_name, 'ModelImages', array(named_struct('ImageUri', if({K} % 4 = 0, null, concat('https://a/', {K})), 'CompressionImageUri', concat('https://c/', {K})))"""
    return listings.aigcarena(landed(spark, sf_dir, "aigcarena", item), ["BRAND#1"])


@query(f"""SELECT CASE WHEN {K} % 2 = 0 THEN 'https://d/' || {K} ELSE 'https://f/' || {K} END AS url, CAST({K} AS VARCHAR) AS post_id, left(p_name, 200) AS post_title,
    'freepik:' || CASE WHEN {K} % 3 = 0 THEN 'unknown' ELSE 'photo' END || ':' || CASE WHEN {K} % 5 = 0 THEN 'unknown' ELSE 'square' END AS flair, 'freepik' AS source FROM part WHERE {K} % 8 <> 0""")
def listing_freepik(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = f"""'id', if({K} % 8 = 0, null, {K}), 'title', p_name, 'download_url', if({K} % 2 = 0, concat('https://d/', {K}), null),
        'image', named_struct('type', if({K} % 3 = 0, null, 'photo'), 'orientation', if({K} % 5 = 0, null, 'square'), 'source', named_struct('url', concat('https://f/', {K}), 'size', 'x'))"""
    return listings.freepik(landed(spark, sf_dir, "freepik", item))


@query(f"""SELECT 'https://g/' || {K} AS url, CAST({K} AS VARCHAR) AS post_id, left(p_name, 200) AS post_title, 'grok_imagine:api:' || CASE WHEN {K} % 4 = 0 THEN '' ELSE p_brand END || CASE WHEN {K} % 5 <> 0 AND {K} % 2 = 0 THEN ':nsfw' ELSE '' END AS flair, 'grok_imagine' AS source
    FROM part WHERE {K} % 3 <> 0""")
def listing_grok_imagine(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = f"""'id', string({K}), 'mediaType', if({K} % 3 = 0, 'MEDIA_POST_TYPE_VIDEO', 'MEDIA_POST_TYPE_IMAGE'), 'mediaUrl', concat('https://g/', {K}), 'prompt', p_name, 'modelName', if({K} % 4 = 0, null, p_brand), 'rRated', if({K} % 5 = 0, null, {K} % 2 = 0)"""
    return listings.grok_imagine(landed(spark, sf_dir, "grok_imagine", item))


@query(f"""SELECT 'https://g/' || {K} AS url, CAST({K} AS VARCHAR) AS post_id, left(p_name || ' "q" ' || chr(10) || 'é ' || chr(92), 200) AS post_title,
    'grok_imagine:api:' || CASE WHEN {K} % 5 = 0 THEN '7' ELSE 'm' END || CASE WHEN {K} % 4 = 0 THEN '' ELSE ':nsfw' END AS flair, 'grok_imagine' AS source FROM part WHERE {K} % 6 IN (0, 1, 4) AND {K} % 7 <> 0""")
def listing_strange_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with entries that aren't objects, fields of other types and escaped text; pages without a list, cut off, or no JSON."""
    known = f"""to_json(named_struct('id', {K}, 'mediaType', 'MEDIA_POST_TYPE_IMAGE', 'prompt', concat(p_name, ' "q" ', char(10), 'é ', char(92))))"""
    url = f"""if({K} % 7 = 0, '["x"]', concat('"https://g/', {K}, '"'))"""
    item = f"""concat('{{"mediaUrl": ', {url}, ', "modelName": ', if({K} % 5 = 0, '7', '"m"'), ', "rRated": ', if({K} % 4 = 0, '"yes"', 'true'), ', ', substr({known}, 2))"""
    body = f"""CASE {K} % 6 WHEN 0 THEN concat('{{"items": [7, "text", null, ', {item}, ', [], true, {{}}]}}') WHEN 1 THEN concat('{{"items": [', {item}, ']}}') WHEN 2 THEN '{{"items": "none"}}'
        WHEN 3 THEN concat('{{"items": [', {item}) WHEN 4 THEN concat('{{"other": [', {item}, '], "items": [', {item}, ']}}') ELSE 'error' END"""
    return listings.grok_imagine(listings.parse_pages(table(spark, sf_dir, "part").select(F.expr(body).alias("body")), "body", "grok_imagine", "items"))


@query(f"""SELECT 'https://x/' || {K} AS url, CASE WHEN {K} % 3 = 0 THEN 'j' || {K} ELSE 'i' || {K} END AS post_id, left(p_name, 200) AS post_title, 'recraft:' || CASE WHEN {K} % 4 = 0 THEN 'unknown' ELSE 'recraftv4' END || ':' || CASE WHEN {K} % 5 = 0 THEN 'unknown' ELSE 'any' END AS flair, 'recraft' AS source
    FROM part WHERE {K} % 3 <> 0 OR {K} % 2 <> 0""")
def listing_recraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = f"""'image_id', if({K} % 3 = 0, null, concat('i', {K})), 'id', if({K} % 2 = 0, null, concat('j', {K})), 'prompt', p_name, 'image_url', concat('https://x/', {K}), 'model', if({K} % 4 = 0, null, 'recraftv4'), 'image_type', if({K} % 5 = 0, null, 'any')"""
    return listings.recraft(landed(spark, sf_dir, "recraft", item))


SQL_INSTAGRAM = f"SELECT *, CASE WHEN {K} % 4 = 0 THEN 200 ELSE {K} * 10 % 1500 END AS w, CASE WHEN {K} % 2 = 0 THEN 250 ELSE 900 END AS h FROM part"


@query(f"""SELECT CASE WHEN {K} % 3 <> 0 AND w < 1080 THEN 'https://i/' || {K} || '/b' ELSE 'https://i/' || {K} END AS url, '' AS post_id, '' AS post_title, 'instagram:' || p_brand AS flair, 'instagram:' || p_brand AS source
    FROM ({SQL_INSTAGRAM}) WHERE NOT (w < 300 AND h < 300)""")
def listing_instagram(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = f"concat('https://i/', {K}, '/a 640w, https://i/', {K}, '/b 1080w, https://i/', {K}, '/c ', p_size, 'w')"
    item = f"'url', concat('https://i/', {K}), 'srcset', if({K} % 3 = 0, null, {sources}), 'w', if({K} % 4 = 0, 200, {K} * 10 % 1500), 'h', if({K} % 2 = 0, 250, 900), 'username', p_brand"
    return listings.instagram(landed(spark, sf_dir, "instagram", item))


@query(f"""SELECT DISTINCT CASE {K} % 3 WHEN 0 THEN 'https://pbs.twimg.com/media/' || p_size || '?format=png&name=orig' ELSE 'https://pbs.twimg.com/media/' || p_size || '?format=jpg&name=orig' END AS url, '' AS post_id, 'direct_search:from:someone' AS post_title, 'direct_search' AS flair, 'twitter' AS source
    FROM part WHERE {K} % 3 < 2""")
def listing_twitter_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = f"""'src', CASE {K} % 3 WHEN 0 THEN concat('https://pbs.twimg.com/media/', p_size, '?format=png&name=small') WHEN 1 THEN concat('https://pbs.twimg.com/media/', p_size) ELSE concat('https://pbs.twimg.com/profile/', {K}) END"""
    return listings.twitter(landed(spark, sf_dir, "twitter", item), account="someone")


@query(f"""SELECT CASE {K} % 4 WHEN 0 THEN 'https://x/' || {K} || '.jpg' ELSE 'https://x/' || {K} || '?name=orig' END AS url, '' AS post_id, '' AS post_title, 'media' AS flair, 'twitter' AS source FROM part WHERE {K} % 4 < 2""")
def listing_twitter_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = f"""'src', CASE {K} % 4 WHEN 0 THEN concat('https://x/', {K}, '.jpg') WHEN 1 THEN concat('https://x/', {K}, '?name=orig') WHEN 2 THEN concat('ftp://x/', {K}, '.jpg') ELSE concat('https://x/', {K}, '.gif') END"""
    return listings.twitter(landed(spark, sf_dir, "twitter", item), searched=False)


# ---------------------------------------------------------------- what is asked, and accounts


SQL_RECRAFT = "SELECT 'recraftv3' AS model, t AS image_type FROM (VALUES " + ", ".join(f"('{t}')" for t in listings.RECRAFT_TYPES) + ") v(t) UNION ALL SELECT m, 'any' FROM (VALUES ('recraftv4'), ('recraftv4_raster'), ('recraftv4_pro_raster')) v(m)"


@query(f"""SELECT model, image_type, count({K}) AS n FROM ({SQL_RECRAFT}) LEFT JOIN (SELECT {K}, CASE WHEN {K} % 4 = 0 THEN 'any' ELSE [{', '.join(repr(t) for t in listings.RECRAFT_TYPES)}][{K} % 16 + 1] END AS t,
    CASE {K} % 8 WHEN 0 THEN 'recraftv4' WHEN 4 THEN 'recraftv4_raster' ELSE 'recraftv3' END AS m FROM part) ON m = model AND t = image_type GROUP BY ALL""")
def recraft_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many items each query that is asked has brought."""
    kind = F.when(F.col(K) % 4 == 0, "any").otherwise(F.get(F.array(*map(F.lit, listings.RECRAFT_TYPES)), (F.col(K) % 16).cast("int")))
    model = F.when(F.col(K) % 8 == 0, "recraftv4").when(F.col(K) % 8 == 4, "recraftv4_raster").otherwise("recraftv3")
    brought = table(spark, sf_dir, "part").groupBy(model.alias("model"), kind.alias("image_type")).agg(F.count("*").alias("n"))
    return listings.recraft_queries(spark).join(brought, ["model", "image_type"], "left").select("model", "image_type", F.coalesce("n", F.lit(0)).alias("n"))


@query("""SELECT 'list' AS kind, n_name AS target, sort, win AS "window" FROM nation, (VALUES ('new'), ('hot'), ('top'), ('rising')) s(sort), (VALUES ('all'), ('year'), ('month'), ('week')) w(win)
    UNION ALL SELECT 'search', r_name, sort, win FROM region, (VALUES ('relevance'), ('new'), ('top')) s(sort), (VALUES ('all'), ('year'), ('month')) w(win)""")
def reddit_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.reddit_queries(table(spark, sf_dir, "nation").select(F.col("n_name").alias("target")), table(spark, sf_dir, "region").select(F.col("r_name").alias("target")))


@query(f"SELECT {K} AS id, p_name AS name FROM part WHERE {K} % 3 = 0 AND regexp_matches(p_name, 'ring$|^hot') AND p_name IN ('small ring', 'hot gear', 'hot ring')")
def target_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = table(spark, sf_dir, "part").select(F.col(K).alias("id"), (F.col(K) % 3).cast("int").alias("type"), F.col("p_name").alias("name"))
    return listings.target_channels(channels, "ring$|^hot", ["small ring", "hot gear", "hot ring"]).select("id", "name")


@query("SELECT p_brand AS username, 'tier' || max(p_size) AS tier FROM part GROUP BY 1")
def account_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_size = table(spark, sf_dir, "part").groupBy(F.col("p_size").alias("ord")).agg(F.collect_set("p_brand").alias("accounts"))
    return listings.account_tiers(by_size.withColumn("tier", F.concat(F.lit("tier"), "ord")))


# ---------------------------------------------------------------- tables on disk

MANIFEST = [c.split()[0] for c in schemas.MANIFEST.split(", ")]


@query("""SELECT 'f' || doc_id || '.png' AS filename, source, sha256(text) AS title, CAST(n_chars AS VARCHAR) AS width, '' AS flair FROM documents WHERE text IS NOT NULL AND doc_id % 2 = 0
    UNION ALL SELECT 'g' || doc_id || '.png', source, sha256('he said "x",' || chr(13) || chr(10) || 'and left'), '', 'a,b' FROM documents WHERE doc_id % 2 = 1""")
def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest appended to twice and read again in ranges: whole texts with quotes, commas and newlines inside, absent fields empty."""
    docs, to = table(spark, sf_dir, "documents"), files.scratch(spark, "manifest")
    first = {"filename": F.concat(F.lit("f"), "doc_id", F.lit(".png")), "source": F.col("source"), "post_title": F.col("text"), "width": F.col("n_chars").cast("string")}
    second = {"filename": F.concat(F.lit("g"), "doc_id", F.lit(".png")), "source": F.col("source"), "post_title": F.lit('he said "x",\r\nand left'), "flair": F.lit("a,b")}
    for rows, own in ((docs.filter("text IS NOT NULL AND doc_id % 2 = 0"), first), (docs.filter("doc_id % 2 = 1"), second)):
        files.append_manifest(rows.select(*(own.get(c, F.lit(None).cast("string")).alias(c) for c in MANIFEST)), to)
    return files.read_manifest(spark, to).select("filename", "source", F.sha2("post_title", 256).alias("title"), "width", "flair")


@query("""SELECT doc_id || '.jpg' AS filename, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE sha256(text) END AS caption, CASE WHEN doc_id % 4 = 0 THEN true END AS should_reject, CASE WHEN doc_id % 5 = 0 THEN 'a,b' ELSE '' END AS signals, CASE WHEN doc_id % 7 = 0 THEN 'late' END AS error FROM documents""")
def caption_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as captions in JSON objects by file name, each object read in ranges, absent fields null."""
    entry = F.struct(
        F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("caption"),
        F.when(F.col("doc_id") % 4 == 0, True).alias("should_reject"),
        F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("a"), F.lit("b"))).alias("reject_signals"),
        F.when(F.col("doc_id") % 7 == 0, "late").alias("error"),
    )
    to = files.scratch(spark, "captions")
    files.write_json_map(table(spark, sf_dir, "documents").select(F.concat("doc_id", F.lit(".jpg")).alias("key"), entry.alias("value")), "key", "value", to)
    return files.read_captions(spark, to).select("filename", F.sha2("caption", 256).alias("caption"), "should_reject", F.coalesce(F.array_join("reject_signals", ","), F.lit("")).alias("signals"), "error")


@query("SELECT event_id || '.png' AS filename, TRY_CAST(CASE WHEN event_type = 'error' THEN 'x' ELSE CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) END AS DOUBLE) AS z_score, event_id % 2 = 0 AS is_fake FROM events")
def score_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detector's scores from CSV: paths become names, only ``True`` is true, what is no number is null."""
    value = F.when(F.col("event_type") == "error", "x").otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    flag = F.when(F.col("event_id") % 2 == 0, "True").when(F.col("event_id") % 3 == 0, "true").otherwise("False")
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("out/staging/"), "event_id", F.lit(".png")).alias("file"), value.alias("z_score"), flag.alias("is_fake"), F.lit("").alias("raw_score"))
    to = files.scratch(spark, "scores")
    rows.write.options(**files.CSV).csv(to)
    return files.read_scores(spark, to).select("filename", "z_score", "is_fake")


@query("SELECT doc_id || '.png' AS filename, CASE WHEN quality = 1 THEN 'ai_art' ELSE 'meme' END AS category FROM labels")
def classification_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = files.scratch(spark, "classes")
    files.write_json_map(table(spark, sf_dir, "labels").select(F.concat("doc_id", F.lit(".png")).alias("key"), F.when(F.col("quality") == 1, "ai_art").otherwise("meme").alias("value")), "key", "value", to)
    return files.read_classifications(spark, to)


@query("SELECT doc_id || '.jpg' AS filename, 'run ' || list_max(list_filter(range(0, 6), lambda k: doc_id % (k + 1) = 0)) AS caption, n_chars > 2000 AS should_reject FROM documents")
def caption_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions added run by run; the last of a file counts.  Runs are merged as they come, and no superseded one is read."""
    log, docs = files.CaptionLog(spark, files.scratch(spark, "log"), fan=3), table(spark, sf_dir, "documents")
    for run in range(6):
        log.add(docs.filter(F.col("doc_id") % (run + 1) == 0).select(F.concat("doc_id", F.lit(".jpg")).alias("filename"), F.lit(f"run {run}").alias("caption"), (F.col("n_chars") > 2000).alias("should_reject"), F.array().cast("array<string>").alias("reject_signals"), F.lit(None).cast("string").alias("error")))
    return log.latest().select("filename", "caption", "should_reject")


@query(f"SELECT {K} || CASE {K} % 4 WHEN 0 THEN '.PNG' WHEN 1 THEN '.webp' WHEN 2 THEN '.txt' ELSE '.jpeg' END AS filename FROM part WHERE {K} % 4 <> 2 AND {K} % 5 <> 0")
def to_caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed images that have no caption yet."""
    ext = F.when(F.col(K) % 4 == 0, ".PNG").when(F.col(K) % 4 == 1, ".webp").when(F.col(K) % 4 == 2, ".txt").otherwise(".jpeg")
    listing = table(spark, sf_dir, "part").select(K, F.concat(K, ext).alias("filename"))
    return files.to_caption(listing, listing.filter(F.col(K) % 5 == 0)).select("filename")


# ---------------------------------------------------------------- images and names


@query(f"""SELECT {K} || '.png' AS filename, {K} % 6 <> 0 AS opened, CAST(CASE WHEN {K} % 6 = 0 THEN 0 ELSE 100 + {K} END AS INTEGER) AS width, CAST(CASE WHEN {K} % 6 = 0 THEN 0 ELSE 200 + p_size END AS INTEGER) AS height,
    CASE WHEN {K} % 6 = 0 THEN 'UNKNOWN' WHEN {K} % 2 = 0 THEN 'PNG' ELSE 'JPEG' END AS format, CASE WHEN {K} % 6 <> 0 AND {K} % 2 = 1 THEN CAST(p_size AS DOUBLE) END AS avg_quantization FROM part""")
def binary_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of PNG and JPEG files, built byte by byte; every sixth is cut short.  A JPEG is at most 65,535 wide: wider images are in
    strips side by side, each a file, whose widths are added up."""
    def number(c: str, digits: int) -> str:
        return f"lpad(hex({c}), {digits}, '0')"

    wide = f"CASE WHEN {K} % 6 <> 0 AND {K} % 2 = 1 THEN {imagebytes.WIDEST_JPEG} END"
    images = table(spark, sf_dir, "part").select(K, "p_size", F.monotonically_increasing_id().alias("image")).repartition("image")
    strips = images.select("*", F.expr(f"explode(sequence(0L, coalesce((99L + {K}) div {wide}, 0L)))").alias("strip"))
    png = f"concat('89504E470D0A1A0A0000000D49484452', {number(f'100 + {K}', 8)}, {number('200 + p_size', 8)}, '0802000000', '00000000', '0000000049454E44AE426082')"
    table_of = "concat('FFDB0043', '00', repeat(lpad(hex(p_size), 2, '0'), 64))"
    jpeg = f"concat('FFD8', {table_of}, 'FFC0000B08', {number('200 + p_size', 4)}, {number(f'least(100 + {K} - strip * {imagebytes.WIDEST_JPEG}, {imagebytes.WIDEST_JPEG})', 4)}, '01011100', 'FFD9')"
    content = F.expr(f"unhex(CASE WHEN {K} % 6 = 0 THEN '89504E470D0A1A0A00' WHEN {K} % 2 = 0 THEN {png} ELSE {jpeg} END)")
    read = imagebytes.image_features(strips.select("image", F.concat(F.lit("dir/"), K, F.lit(".png")).alias("path"), content.alias("content")).withColumn("length", F.length("content").cast("bigint")), "image bigint")
    whole = read.groupBy("image").agg(F.max("filename").alias("filename"), F.bool_and("opened").alias("opened"), F.sum("width").cast("int").alias("width"), F.max("height").alias("height"), F.max("format").alias("format"), F.max("avg_quantization").alias("avg_quantization"))
    return whole.drop("image")


@query(f"""SELECT {K}, CASE {K} % 6 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/png' WHEN 2 THEN 'image/webp' WHEN 3 THEN 'image/gif' ELSE 'image/jpeg' END AS mime,
    (abs(1000 + {K} % 40 - 1024) <= 2 AND abs(1024 + p_size - 1026) <= 2) AS native, 'data:' || CASE {K} % 6 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/png' WHEN 2 THEN 'image/webp' WHEN 3 THEN 'image/gif' ELSE 'image/jpeg' END || ';base64,' || to_base64(encode(p_name)) AS payload FROM part""")
def image_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("a/b."), F.get(F.array(*map(F.lit, ("JPG", "png", "webp", "gif", "bmp", ""))), (F.col(K) % 6).cast("int")))
    rows = table(spark, sf_dir, "part")
    return rows.select(K, text.mime_type(path).alias("mime"), shapes.near_resolution(F.expr(f"1000 + {K} % 40"), F.expr("1024 + p_size"), [(1024, 1026)]).alias("native"), text.data_url(path, F.col("p_name").cast("binary")).alias("payload"))


@query(f"SELECT {K} AS id, CAST(row_number() OVER (ORDER BY {K} % 3 <> 0, {K} || '.png') AS INTEGER) AS place FROM part ORDER BY place LIMIT 50")
def failures_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines of a report for people: what failed, then the rest, by name.  Only these are sorted together."""
    flagged = table(spark, sf_dir, "part").select(F.col(K).alias("id"), F.concat(K, F.lit(".png")).alias("filename"), (F.col(K) % 3 != 0).alias("structural_passed"))
    return validate.failures_first(flagged).limit(50).select("id", F.row_number().over(Window.orderBy("structural_passed", "filename")).alias("place"))


S = "s_suppkey"


@query(f"""SELECT {S} || CASE WHEN {S} % 3 = 0 THEN '.PNG' ELSE '.jpg' END AS filename, {S} % 5 <> 0 AS opened, CAST(CASE WHEN {S} % 5 = 0 THEN 0 ELSE 300 + {S} END AS INTEGER) AS width, CAST(CASE WHEN {S} % 5 = 0 THEN 0 ELSE 200 + s_nationkey END AS INTEGER) AS height,
    CASE WHEN {S} % 5 = 0 THEN 'UNKNOWN' WHEN {S} % 3 = 0 THEN 'PNG' ELSE 'JPEG' END AS format, CASE WHEN {S} % 5 <> 0 AND {S} % 3 <> 0 AND {S} % 2 = 0 THEN 'Make' ELSE '' END AS tags,
    CASE WHEN {S} % 5 = 0 THEN false ELSE {S} % 3 <> 0 AND {S} % 2 = 0 AND {S} % 4 = 0 END AS signed, true AS header_only FROM supplier WHERE {S} % 7 <> 0""")
def image_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of a folder, listed by suffix and read in ranges: headers, camera and generator tags.  Behind each header come 40,000 bytes
    that are never read; every fifth file is cut short, every seventh is no image by its name."""

    def number(c: str, digits: int) -> str:
        return f"lpad(hex({c}), {digits}, '0')"

    # one directory: Make, and on every fourth a description with a signature and an artist
    def tiff(more: str, n: int) -> str:
        text = "5369676E61747572653A206100"  # "Signature: a"
        described = f"'010E', '0002', '0000000D', '{8 + 2 + 12 * n + 4:08X}', '013B', '0002', '00000002', '41000000'," if more else ""
        return f"concat('4D4D002A00000008', '{n:04X}', {described} '010F', '0002', '00000002', '58000000', '00000000', '{text}')"

    exif = f"CASE WHEN {S} % 4 = 0 THEN {tiff('signed', 3)} WHEN {S} % 2 = 0 THEN {tiff('', 1)} ELSE '' END"
    segment = f"CASE WHEN {S} % 2 = 0 THEN concat('FFE1', {number(f'8 + length({exif}) div 2', 4)}, '457869660000', {exif}) ELSE '' END"
    rest = "repeat('00', 40000)"
    png = f"concat('89504E470D0A1A0A0000000D49484452', {number(f'300 + {S}', 8)}, {number('200 + s_nationkey', 8)}, '0802000000', '00000000', '00009C4049444154', {rest})"
    jpeg = f"concat('FFD8', {segment}, 'FFC0000B08', {number('200 + s_nationkey', 4)}, {number(f'300 + {S}', 4)}, '01011100', 'FFDA', {rest})"
    content = F.expr(f"unhex(CASE WHEN {S} % 5 = 0 THEN '89504E470D0A1A0A00' WHEN {S} % 3 = 0 THEN {png} ELSE {jpeg} END)")
    suffix = F.when(F.col(S) % 7 == 0, ".txt").when(F.col(S) % 3 == 0, ".PNG").otherwise(".jpg")
    to = files.scratch(spark, "images")
    made = imagebytes.write_files(table(spark, sf_dir, "supplier").select(F.concat(S, suffix).alias("filename"), content.alias("content")), to)
    made.write.format("noop").mode("overwrite").save()
    found = imagebytes.read_image_features(spark, to, files.IMAGES)
    return found.select("filename", "opened", "width", "height", "format", F.array_join("camera_exif_tags", ",").alias("tags"), F.col("has_generator_exif").alias("signed"), (F.col("bytes_read") < 9000).alias("header_only"))


# ---------------------------------------------------------------- arrivals and resumable runs


@query("SELECT o_custkey, count(*) AS n FROM (SELECT DISTINCT o_custkey FROM orders) GROUP BY 1")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over arrived files, stopped and taken up again with more: each key is taken once, and none twice."""
    orders, base = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), files.scratch(spark, "stream")
    for part in (0, 1):
        orders.filter(F.col("o_orderkey") % 2 == part).write.mode("append").parquet(f"{base}/in")
        stream = incremental.new_only(incremental.arriving(spark, f"{base}/in", "o_orderkey long, o_custkey long"), "o_custkey")
        incremental.append_to(stream.select("o_custkey"), f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("o_custkey").agg(F.count("*").alias("n"))


@query("""SELECT l_suppkey % 20 AS listing, l_orderkey AS page, streak, streak >= 3 AS stop FROM (SELECT *, row_number() OVER (PARTITION BY listing, run ORDER BY l_orderkey) - CASE WHEN run = 0 THEN 0 ELSE 1 END AS streak FROM (
    SELECT *, sum(CASE WHEN found THEN 1 ELSE 0 END) OVER (PARTITION BY listing ORDER BY l_orderkey) AS run FROM (SELECT DISTINCT ON (l_suppkey % 20, l_orderkey) l_suppkey, l_suppkey % 20 AS listing, l_orderkey, l_orderkey % 3 = 0 AS found FROM lineitem)))
    QUALIFY max(CASE WHEN streak >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY listing ORDER BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS DISTINCT FROM 1""")
def stream_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings' pages in batches; after three without anything new a listing is left."""
    pages = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 20).alias("listing"), F.col("l_orderkey").alias("page"), (F.col("l_orderkey") % 3 == 0).alias("found")).distinct()
    base = files.scratch(spark, "streaks")
    middle = pages.agg(F.max("page")).first()[0] // 2
    for part in (pages.filter(F.col("page") <= middle), pages.filter(F.col("page") > middle)):
        part.write.mode("append").parquet(f"{base}/in")
        stream = incremental.arriving(spark, f"{base}/in", "listing long, page long, found boolean", None)  # a half may be any number of files, in no order
        incremental.append_to(incremental.barren_streaks(stream, "listing", "page", "found", 3), f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("listing", "page", F.col("streak").cast("bigint").alias("streak"), "stop")


SQL_LATE = """SELECT *, row_number() OVER (PARTITION BY listing ORDER BY page) - 1 AS number FROM (SELECT DISTINCT l_suppkey % 20 AS listing, l_orderkey AS page, l_orderkey % 3 = 0 AS found FROM lineitem)"""


@query(f"""SELECT listing, page, streak, streak >= 3 AS stop FROM (SELECT *, row_number() OVER (PARTITION BY listing, run ORDER BY page) - CASE WHEN run = 0 THEN 0 ELSE 1 END AS streak FROM (
    SELECT *, sum(CASE WHEN found THEN 1 ELSE 0 END) OVER (PARTITION BY listing ORDER BY page) AS run FROM ({SQL_LATE})))
    QUALIFY max(CASE WHEN streak >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY listing ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS DISTINCT FROM 1""")
def stream_late_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings' pages in three batches, each page in any of them; held until those before it came, so that the streaks are the same."""
    pages = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 20).alias("listing"), F.col("l_orderkey").alias("page"), (F.col("l_orderkey") % 3 == 0).alias("found")).distinct()
    pages = pages.withColumn("number", (F.row_number().over(Window.partitionBy("listing").orderBy("page")) - 1).cast("bigint"))
    base = files.scratch(spark, "late")
    for part in (2, 0, 1):
        pages.filter(F.pmod(F.xxhash64("page"), F.lit(3)) == part).write.mode("append").parquet(f"{base}/in")
        stream = incremental.arriving(spark, f"{base}/in", "listing long, page long, found boolean, number long")
        incremental.append_to(incremental.late_streaks(stream, "listing", "number", "page", "found", 3), f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("listing", "page", F.col("streak").cast("bigint").alias("streak"), "stop")


@query("""SELECT DISTINCT o_custkey % 50 AS listing, o_orderkey // 100 AS page FROM orders WHERE floor(o_totalprice / 5) NOT IN (SELECT floor(o_totalprice / 5) FROM orders WHERE o_orderkey % 7 = 0)""")
def unseen_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that a connector goes through: those with an item it hasn't seen."""
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("listing"), F.floor(F.col("o_orderkey") / 100).alias("page"), F.floor(F.col("o_totalprice") / 5).alias("item"), "o_orderkey")
    pages = rows.select("listing", "page").distinct()
    return incremental.unseen_pages(pages, rows, rows.filter("o_orderkey % 7 = 0"), ["listing", "page"], "item")


def sql_arrivals(candidates: str, urls: str = "[]::BIGINT[]", contents: str = "[]::BIGINT[]") -> str:
    """Items (k: place from 1, doc_id, u, c) one after another, with lists of what was taken."""
    return f"""WITH RECURSIVE d AS ({candidates}), r(k, doc_id, outcome, urls, contents) AS (
        SELECT 0::BIGINT, NULL::BIGINT, NULL::VARCHAR, {urls}, {contents}
        UNION ALL SELECT d.k, d.doc_id, CASE WHEN list_contains(urls, u) THEN 'dup_url' WHEN list_contains(contents, c) THEN 'dup_hash' ELSE 'ok' END,
            CASE WHEN list_contains(urls, u) OR list_contains(contents, c) THEN urls ELSE list_append(urls, u) END,
            CASE WHEN list_contains(urls, u) OR list_contains(contents, c) THEN contents ELSE list_append(contents, c) END
        FROM r JOIN d ON d.k = r.k + 1) SELECT doc_id, outcome FROM r WHERE k > 0"""


SQL_URL, SQL_CONTENT, SQL_LARGE = "doc_id % 400 AS u", "n_chars % 300 AS c", "n_chars >= 200 OR n_chars = 0"


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as items whose URLs change their content; 1,000 pixels for each character."""
    return table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 400).alias("url"), (F.col("n_chars") % 300).cast("bigint").alias("content_hash"), F.col("n_chars").cast("int").alias("width"), F.lit(1000).alias("height"))


@query(sql_arrivals(f"SELECT doc_id, {SQL_URL}, {SQL_CONTENT}, row_number() OVER (ORDER BY doc_id) AS k FROM documents"))
def arrivals_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as items one after another, where a URL may change its content."""
    return items.first_arrivals(_items(spark, sf_dir), "url", "content_hash", ["doc_id"]).select("doc_id", "outcome")


@query("SELECT doc_id FROM (" + sql_arrivals(f"SELECT doc_id, {SQL_URL}, {SQL_CONTENT}, row_number() OVER (ORDER BY doc_id) AS k FROM documents WHERE doc_id % 10 <> 0 AND ({SQL_LARGE})",
    "(SELECT list(DISTINCT doc_id % 400) FROM documents WHERE doc_id % 10 = 0)", "(SELECT list(DISTINCT n_chars % 300) FROM documents WHERE doc_id % 10 = 0 AND n_chars % 2 = 0)") + ") WHERE outcome = 'ok'")
def new_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is taken beside a manifest: what was too small before may be taken later."""
    found = _items(spark, sf_dir)
    manifest = found.filter("doc_id % 10 = 0").withColumn("content_hash", F.when(F.col("width") % 2 == 0, F.col("content_hash")))
    return items.new_items(found.filter("doc_id % 10 <> 0"), manifest, ["doc_id"]).select("doc_id")


@query("SELECT doc_id FROM (" + sql_arrivals(f"SELECT doc_id, {SQL_URL}, {SQL_CONTENT}, row_number() OVER (ORDER BY doc_id) AS k FROM documents WHERE {SQL_LARGE}") + ") WHERE outcome = 'ok'")
def stream_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same items arriving in three runs: only what was taken is remembered, by URL and by content."""
    found, base = _items(spark, sf_dir), files.scratch(spark, "arriving")
    taken, schema = Table(spark, f"{base}/taken"), "doc_id bigint, url bigint, content_hash bigint, width int, height int"
    bounds = found.agg(F.min("doc_id"), F.max("doc_id")).first()
    edges = [bounds[0] + (bounds[1] + 1 - bounds[0]) * k // 3 for k in range(4)] if bounds[0] is not None else []
    large = items.large_enough(F.col("width").cast("bigint") * F.col("height"), 200_000)
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        found.filter(F.col("doc_id").between(low, high - 1)).write.mode("append").parquet(f"{base}/in")
        incremental.take_new(incremental.arriving(spark, f"{base}/in", schema), taken, f"{base}/state", ["doc_id"], lambda rows: rows.filter(large)).awaitTermination()
    return taken.read(schema).select("doc_id")


@query("SELECT doc_id, source, n >= 40 AS reached FROM (SELECT doc_id, source, count(*) OVER (PARTITION BY source) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) WHERE k <= 40")
def target_reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of several producers that are taken until each source has its target."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    producers = [docs.filter(F.col("doc_id") % 3 == k) for k in range(3)]
    return items.until_target(items.produced(*producers), "source", ["doc_id"], 40)


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT (SELECT count(*) * 3 // 5 FROM orders)")
def stream_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arriving file by file until three fifths of them are taken; the stream stops by itself, within a file."""
    orders, base = table(spark, sf_dir, "orders").select("o_orderkey"), files.scratch(spark, "drain")
    held = orders.agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last")).first()
    for k in range(4):
        part = orders.filter(F.col("o_orderkey").between((held["last"] + 1) * k // 4, (held["last"] + 1) * (k + 1) // 4 - 1))
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    taken = Table(spark, f"{base}/taken")
    incremental.take_until(incremental.arriving(spark, f"{base}/in", "o_orderkey bigint", files_per_batch=1), taken, f"{base}/state", ["o_orderkey"], held.n * 3 // 5)
    return taken.read("o_orderkey bigint").select("o_orderkey")


@query("SELECT batch, bucket, n FROM (SELECT CASE WHEN doc_id % 2 = 0 THEN 0::BIGINT ELSE 1 END AS batch, CASE WHEN n_chars < 200 THEN 'too_few_pixels' WHEN n_chars > 5000 THEN 'too_many_pixels' ELSE 'ok' END AS bucket, count(*) AS n FROM documents GROUP BY ALL)")
def stream_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arriving items are validated batch by batch; a batch is a version of the report, so that one run again changes nothing."""
    found, base = _items(spark, sf_dir), files.scratch(spark, "validated")
    seen = Table(spark, f"{base}/report")
    rules = DatasetConfig("arriving", 200_000, 5_000_000)

    def work(batch: DataFrame, n: int) -> None:
        if n >= (seen.versions() or [0])[-1]:
            sized = batch.select("width", "height", F.lit("PNG").alias("format"), F.lit(0).alias("file_size"), F.lit(None).cast("double").alias("avg_quantization"), F.array().cast("array<string>").alias("camera_exif_tags"), F.lit(True).alias("opened"))
            counts = validate.structural(sized, rules).groupBy(F.coalesce(F.get("flags", F.lit(0)), F.lit("ok")).alias("bucket")).agg(F.count("*").alias("n"))
            seen.commit([*seen.parts(n), seen.write(counts.withColumn("batch", F.lit(n).cast("bigint")))], n)

    for k in (0, 1):
        found.filter(F.col("doc_id") % 2 == k).write.mode("append").parquet(f"{base}/in")
        incremental.for_each_batch(incremental.arriving(spark, f"{base}/in", "doc_id bigint, url bigint, content_hash bigint, width int, height int"), work, f"{base}/state").awaitTermination()
    return seen.read("bucket string, n bigint, batch bigint").select("batch", "bucket", "n")


@query("""SELECT listing, page, count(*) AS found, count(*) - count(*) FILTER (k = 1) AS duplicates, count(*) FILTER (k = 1) = 0 AS seen FROM (
    SELECT o_custkey % 5 AS listing, o_orderkey // 100 AS page, row_number() OVER (PARTITION BY o_custkey % 5, floor(o_totalprice / 20000) ORDER BY o_orderkey) AS k FROM orders) GROUP BY ALL""")
def page_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many items of each page earlier pages had, and whether they had all."""
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 5).alias("listing"), F.floor(F.col("o_orderkey") / 100).alias("page"), F.floor(F.col("o_totalprice") / 20000).alias("item"), "o_orderkey")
    return items.page_counts(rows, "listing", "page", "item", ["o_orderkey"])
