"""Items from the landed listing pages of each source.

Each function takes rows with the fields of ``schemas.LISTINGS`` (``read_pages`` makes them of JSON) and returns ``url,
post_id, post_title, flair, source`` and, where the source has them, further columns of the manifest.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas
from quarry.functions import text
from quarry.functions.text import filled, first_filled
from quarry.operators.items import combinations

CIVITAI_CDN = "https://image.civitai.com/xG1nkqKTMzGDvpLrqFT7WA"
YODAYO_CDN = "https://photos.yodayo.com"
# The images that count as generated on the site, and the base models that are taken.
TENSORART_GENERATED = "TENSOR_ART_V1"
TENSORART_BASE_MODELS = ("FLUX.1", "FLUX.1 Schnell")
GROK_IMAGE = "MEDIA_POST_TYPE_IMAGE"


def read_pages(spark: SparkSession, path: str, source: str, items: str | None = None) -> DataFrame:
    """Items of JSON pages, one page a line; ``items`` is the field that lists them (null: a page is an item)."""
    return parse_pages(spark.read.text(path), "value", source, items)


def parse_pages(pages: DataFrame, body: str, source: str, items: str | None = None) -> DataFrame:
    """Items of JSON pages that were landed as a column of text.

    Entries that aren't objects go and leave the others of their page; a field of another type than the source's counts as absent, but
    for a number or a truth value where a text belongs, which is taken as it is written.  A page that isn't an object, is cut off or has
    no list gives no items.
    """
    schema = schemas.LISTINGS[source]
    if items is None:
        return pages.select(F.from_json(body, schema).alias("i")).select("i.*")
    listed = F.from_json(body, f"{items} array<struct<{_as_struct(schema)}>>")[items]
    # one entry of another type makes the whole list null: then each entry is read by itself
    apart = F.transform(F.from_json(body, f"{items} array<string>")[items], lambda entry: F.from_json(F.when(entry.startswith("{"), entry), schema))
    found = pages.select(listed.alias("listed"), body).select(F.explode(F.coalesce("listed", apart)).alias("i"))
    return found.filter("i IS NOT NULL").select("i.*")


def _as_struct(schema: str) -> str:
    depth, out = 0, []
    for word in schema.split(" "):  # "name type, ..." to "name: type, ..." at the outer level
        out.append(word + ":" if depth == 0 and not word.endswith(",") and (not out or out[-1].endswith(",")) else word)
        depth += word.count("<") - word.count(">")
    return " ".join(out)


def _plain(value: Column) -> Column:
    """Text; null where a list or an object, which is text by now, stood in its place."""
    return F.when(~value.rlike(r"^[\[{]"), value)


def _item(df: DataFrame, url: Column, post_id: Column, title: Column, flair: Column, source: Column | str, **more: Column) -> DataFrame:
    src = F.lit(source) if isinstance(source, str) else source
    columns = {"url": url, "post_id": filled(post_id.cast("string")), "post_title": F.left(filled(title), F.lit(200)), "flair": flair, "source": src}
    return df.select(*(c.alias(k) for k, c in (columns | more).items())).filter(filled(_plain(F.col("url"))) != "")


def civitai(items: DataFrame, tag: str, onsite: bool = False) -> DataFrame:
    """Images, not videos; ``tag`` names the model version or tool they were listed by."""
    still = items.filter((filled(F.col("type")) != "video") & ~filled(F.col("mimeType")).startswith("video/"))
    name = F.coalesce("name", F.concat("url", F.lit(".jpg")))
    made_here = F.lit(onsite) | filled(F.col("name")).startswith("generator_import_")
    url = F.concat(F.lit(f"{CIVITAI_CDN}/"), _plain(F.col("url")), F.lit("/original=true/"), name)
    return _item(still, url, F.col("id"), F.col("postTitle"), F.when(made_here, f"onsite:{tag}").otherwise(tag), "civitai")


def civitai_simple(items: DataFrame, model_version: int) -> DataFrame:
    return civitai(items, f"model_version:{model_version}", onsite=True)


def higgsfield(items: DataFrame, model: str) -> DataFrame:
    url = first_filled(F.col("results.raw.url"), F.col("result.url"))
    kind = first_filled(F.col("results.raw.type"), F.col("result.type"))
    return _item(items.filter(kind == "image"), url, F.col("id"), F.col("params.prompt"), F.lit(model), f"higgsfield_{model}")


def reddit(posts: DataFrame) -> DataFrame:
    """All image URLs of each post: its own, its gallery's, or else its previews'.  Keeps what ``posts.skip_reason`` asks for."""
    d = F.col("data")
    unescape = lambda u: F.replace(u, F.lit("&amp;"), F.lit("&"))
    none = F.array().cast("array<string>")
    own = F.when(text.is_image_url(d["url"]), F.array(d["url"])).otherwise(none)
    media = F.coalesce(F.map_values(d["media_metadata"]), F.array().cast("array<struct<status:string,e:string,s:struct<u:string>>>"))
    gallery = F.transform(F.filter(media, lambda m: (m["status"] == "valid") & (m["e"] == "Image") & (filled(m["s"]["u"]) != "")), lambda m: unescape(m["s"]["u"]))
    direct = F.concat(own, F.when(F.coalesce(d["is_gallery"], F.lit(False)), gallery).otherwise(none))
    previews = F.transform(F.filter(F.coalesce(d["preview"]["images"], F.array().cast("array<struct<source:struct<url:string>>>")), lambda i: filled(i["source"]["url"]) != ""), lambda i: unescape(i["source"]["url"]))
    urls = F.when(F.size(direct) > 0, direct).otherwise(previews)
    each = posts.filter(~F.coalesce(d["is_video"], F.lit(False))).select("data", F.explode(urls).alias("u"))
    return _item(each, F.col("u"), d["id"], d["title"], filled(d["link_flair_text"]), "reddit", subreddit=filled(d["subreddit"]), created_utc=d["created_utc"], is_self=F.coalesce(d["is_self"], F.lit(False)))


def midjourney(messages: DataFrame, channel: str, bot_id: str, versions: Sequence[str], first_id: int | None = None) -> DataFrame:
    """The bot's messages with an image, of a wanted or unknown version, from ``first_id`` on."""
    own = messages.filter(F.col("author.id") == bot_id)
    if first_id is not None:
        own = own.filter(F.col("id").cast("bigint") >= first_id)
    attachments = F.coalesce(F.col("attachments"), F.array().cast("array<struct<url:string,filename:string,content_type:string>>"))
    is_image = lambda a: filled(a["content_type"]).startswith("image/") | F.lower(filled(a["filename"])).rlike(r"\.(png|jpg|jpeg|webp)$")
    image = F.get(F.filter(attachments, is_image), F.lit(0))["url"]
    ids = F.flatten(F.transform(F.coalesce("components", F.array().cast("array<struct<components:array<struct<custom_id:string>>>>")), lambda r: F.transform(F.coalesce(r["components"], F.array().cast("array<struct<custom_id:string>>")), lambda c: filled(c["custom_id"]))))
    sized = own.withColumns({"__v": text.message_version(ids, F.col("content")), "__up": text.is_upscaled(F.col("content"))}).filter(F.col("__v").isin(*versions, "unknown"))
    flair = F.concat(F.lit("midjourney_v7:v"), F.col("__v"), F.when(F.col("__up"), "").otherwise(":grid"))
    return _item(sized, image, F.col("id"), text.message_prompt(F.col("content")), flair, "discord_midjourney_v7", subreddit=F.lit(f"discord:{channel}"),
                 message_content=F.left(filled(F.col("content")), F.lit(500)), is_upscaled=F.col("__up").cast("string"))


def tensorart(posts: DataFrame, base_models: Sequence[str] = TENSORART_BASE_MODELS, reject_lora: bool = False) -> DataFrame:
    each = posts.select("id", "title", F.explode("images").alias("i"))
    made = F.col("i.generationData.tensorArtV1")
    lora = F.coalesce(F.exists(made["models"], lambda m: m["type"] == "LORA"), F.lit(False))
    kept = each.filter((F.col("i.generationData.type") == TENSORART_GENERATED) & made["baseModel"]["baseModel"].isin(*base_models))
    if reject_lora:
        kept = kept.filter(~lora)
    flair = F.concat(F.lit("tensorart:"), made["baseModel"]["baseModel"], F.lit(":"), filled(made["baseModel"]["label"]))
    return _item(kept, F.col("i.url"), F.col("id"), F.col("title"), flair, "tensorart", width=F.col("i.width"), height=F.col("i.height"), has_lora=lora)


def yodayo(posts: DataFrame, model: str, reject_lora: bool = True) -> DataFrame:
    each = posts.select(F.col("uuid").alias("post"), F.explode("photo_media").alias("p"))
    if reject_lora:
        each = each.filter(F.coalesce(F.size("p.text_to_image.extra_networks"), F.lit(0)) <= 0)
    url = F.when(filled(F.col("p.uuid")) != "", F.concat(F.lit(f"{YODAYO_CDN}/"), _plain(F.col("p.uuid")), F.lit(".jpg")))
    return _item(each, url, F.col("post"), F.col("p.text_to_image.prompt"), F.lit(f"yodayo:{model}"), f"yodayo_{model}")


def openart(items: DataFrame, model: str) -> DataFrame:
    own = items.filter(F.lower("ai_model") == model.lower())
    filled_size = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit(0)), F.col(b), F.lit(0))
    return _item(own, first_filled(F.col("image.raw"), F.col("image_url")), F.col("id"), F.col("prompt"), F.concat(F.lit("openart:"), F.col("ai_model")), "openart",
                 width=filled_size("image_width", "image.raw_width"), height=filled_size("image_height", "image.raw_height"))


def aigcarena(resources: DataFrame, wanted: Sequence[str] = ()) -> DataFrame:
    """Resources of a model whose name contains one of ``wanted`` (any case); their first image."""
    name = F.coalesce("ModelName", F.lit("unknown"))
    kept = resources.filter(F.exists(F.array(*map(F.lit, wanted)), lambda w: F.lower(name).contains(F.lower(w)))) if wanted else resources
    image = F.get(F.col("ModelImages"), F.lit(0))
    flair = F.concat(F.lit("aigcarena:"), name, F.lit(":"), filled(F.col("ModelVersionId")))
    return _item(kept, first_filled(image["ImageUri"], image["CompressionImageUri"]), F.col("EvalResourceId"), F.col("PromptEn"), flair, F.concat(F.lit("aigcarena_"), text.slug(name)))


def freepik(resources: DataFrame) -> DataFrame:
    """The download URL where it was landed, else the preview."""
    flair = F.concat(F.lit("freepik:"), F.coalesce("image.type", F.lit("unknown")), F.lit(":"), F.coalesce("image.orientation", F.lit("unknown")))
    return _item(resources.filter("id IS NOT NULL"), first_filled(F.col("download_url"), F.col("image.source.url")), F.col("id"), F.col("title"), flair, "freepik")


def grok_imagine(posts: DataFrame) -> DataFrame:
    images = posts.filter(filled(F.col("mediaType")) == GROK_IMAGE)
    flair = F.concat(F.lit("grok_imagine:api:"), filled(F.col("modelName")), F.when(F.coalesce("rRated", F.lit(False)), ":nsfw").otherwise(""))
    return _item(images, F.col("mediaUrl"), F.col("id"), F.col("prompt"), flair, "grok_imagine")


def recraft(items: DataFrame) -> DataFrame:
    """Landed with the URL they were fetched by; the model and type of the query make the flair."""
    flair = F.concat(F.lit("recraft:"), F.coalesce("model", F.lit("unknown")), F.lit(":"), F.coalesce("image_type", F.lit("unknown")))
    key = first_filled(F.col("image_id"), F.col("id"))
    return _item(items.filter(key.isNotNull()), F.col("image_url"), key, F.col("prompt"), flair, "recraft")


def instagram(images: DataFrame, tier: Column | None = None) -> DataFrame:
    """The largest source of each image, without small ones; ``tier`` of the account, where it has one."""
    large = images.filter(~((F.col("w") < 300) & (F.col("h") < 300)))
    flair = F.concat_ws(":", F.lit("instagram"), F.col("username"), *([tier] if tier is not None else []))
    return _item(large, text.largest_source(F.col("url"), F.col("srcset"), F.col("w")), F.lit(""), F.lit(""), flair, F.concat(F.lit("instagram:"), F.col("username")))


def account_tiers(tiers: DataFrame) -> DataFrame:
    """``username, tier``: accounts of several tiers (``ord, tier, accounts``) have the last one."""
    return tiers.select(F.explode("accounts").alias("username"), "ord", "tier").groupBy("username").agg(F.max_by("tier", "ord").alias("tier"))


def twitter(images: DataFrame, searched: bool = True, account: str = "") -> DataFrame:
    """Image sources found by search, at their original size; or a media timeline's URLs that are images."""
    src = F.col("src")
    if searched:
        found = images.filter(src.contains("pbs.twimg.com/media"))
        return _item(found, text.original_size(src), F.lit(""), F.lit(f"direct_search:from:{account}"), F.lit("direct_search"), "twitter").dropDuplicates(["url"])
    kept = images.filter(src.contains("name=orig") | (src.startswith("http") & src.rlike(r"\.(jpg|jpeg|png|webp)$")))
    return _item(kept, src, F.lit(""), F.lit(""), F.lit("media"), "twitter")


CONNECTORS: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (civitai, civitai_simple, higgsfield, reddit, midjourney, tensorart, yodayo, openart, aigcarena, freepik, grok_imagine, recraft, instagram, twitter)}

# ---------------------------------------------------------------- what is asked of a source

# Models, their image types, sort orders and time windows.
RECRAFT_MODELS = ["recraftv3", "recraftv4", "recraftv4_raster", "recraftv4_pro_raster"]
RECRAFT_TYPES = [
    "realistic_image", "realistic_image_b_and_w", "realistic_image_enterprise", "realistic_image_evening_light", "realistic_image_faded_nostalgia",
    "realistic_image_forest_life", "realistic_image_hard_flash", "realistic_image_hdr", "realistic_image_motion_blur", "realistic_image_mystic_naturalism",
    "realistic_image_natural_light", "realistic_image_natural_tones", "realistic_image_organic_calm", "realistic_image_real_life_glow",
    "realistic_image_retro_realism", "realistic_image_retro_snapshot",
]
REDDIT_LISTS = (["new", "hot", "top", "rising"], ["all", "year", "month", "week"])
REDDIT_SEARCHES = (["relevance", "new", "top"], ["all", "year", "month"])


def _values(spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def recraft_queries(spark: SparkSession) -> DataFrame:
    """``model, image_type``: all realistic types of the third version, any type of the later ones."""
    granular = F.col("model") == RECRAFT_MODELS[0]
    return combinations(_values(spark, "model", RECRAFT_MODELS), _values(spark, "image_type", [*RECRAFT_TYPES, "any"]), granular != (F.col("image_type") == "any"))


def reddit_queries(subreddits: DataFrame, searches: DataFrame) -> DataFrame:
    """``kind, target, sort, window`` of all listings and searches; both tables have a column ``target``."""

    def every(kind: str, targets: DataFrame, sorts: Sequence[str], windows: Sequence[str]) -> DataFrame:
        orders = F.explode(F.array(*map(F.lit, sorts)))
        return targets.select(F.lit(kind).alias("kind"), "target", orders.alias("sort")).withColumn("window", F.explode(F.array(*map(F.lit, windows))))

    return every("list", subreddits, *REDDIT_LISTS).unionByName(every("search", searches, *REDDIT_SEARCHES))


def target_channels(channels: DataFrame, pattern: str, names: Sequence[str] = ()) -> DataFrame:
    """Text channels (``id, type, name``) whose name has the pattern and is among ``names``, if given; by name."""
    found = channels.filter((F.col("type") == 0) & filled(F.col("name")).rlike(pattern))
    return (found.filter(F.col("name").isin(*names)) if names else found).orderBy("name", "id")
