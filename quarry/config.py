"""Dataset configurations: limits and rules by dataset, and what a user adds with ``register_dataset``."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------- fixed values: rule words, in the order in which they are reported

REJECT_KEYWORDS = [
    "penis", "vagina", "vulva", "genitals", "testicle", "labia", "clitoris", "phallus", "cum", "ejaculation", "cumshot", "penetration", "intercourse", "sex act",
    "illustration", "cartoon", "anime", "cgi", "comic", "line drawing", "sketch", "digital painting", "digital drawing", "3d render", "pixel art", "vector art",
    "watercolor", "oil painting", "oil on canvas", "pencil drawing", "manga", "screenshot", "user interface", "app interface", "chat interface", "settings page",
    "settings menu", "status bar", "navigation bar", "toolbar", "menu bar", "dialog box", "browser window", "browser tab", "address bar", "url bar", "home screen",
    "lock screen", "search bar", "file manager", "task manager", "control panel", "google maps", "google earth", "map pin", "satellite view", "map interface", "tweet",
    "retweet", "like button", "follow button", "comment section", "social media post", "verified badge", "instagram post", "tiktok", "facebook post", "reddit post",
    "meme", "impact font", "text overlay", "top text", "bottom text", "demotivational", "reaction image", "rage comic", "speech bubble", "speech bubbles",
    "thought bubble", "word balloon", "dialogue bubble", "error message", "error screen", "loading screen", "code snippet", "terminal", "command line", "source code",
    "stack trace", "api response", "json output", "xml output", "spreadsheet", "powerpoint", "presentation slide", "leaderboard", "ranking", "scoreboard", "clipart",
    "clip art", "graphic design", "minimalistic art",
]
#: Without drawings that are digital.
PLAIN_REJECT = [
    "penis", "vagina", "vulva", "genitals", "testicle", "labia", "clitoris", "phallus", "cum", "ejaculation", "cumshot", "penetration", "intercourse", "sex act",
    "illustration", "cartoon", "anime", "cgi", "comic", "line drawing", "sketch", "digital painting", "3d render", "pixel art", "vector art", "watercolor",
    "oil painting", "oil on canvas", "pencil drawing", "manga", "screenshot", "user interface", "app interface", "chat interface", "settings page", "settings menu",
    "status bar", "navigation bar", "toolbar", "menu bar", "dialog box", "browser window", "browser tab", "address bar", "url bar", "home screen", "lock screen",
    "search bar", "file manager", "task manager", "control panel", "google maps", "google earth", "map pin", "satellite view", "map interface", "tweet", "retweet",
    "like button", "follow button", "comment section", "social media post", "verified badge", "instagram post", "tiktok", "facebook post", "reddit post", "meme",
    "impact font", "text overlay", "top text", "bottom text", "demotivational", "reaction image", "rage comic", "speech bubble", "speech bubbles", "thought bubble",
    "word balloon", "dialogue bubble", "error message", "error screen", "loading screen", "code snippet", "terminal", "command line", "source code", "stack trace",
    "api response", "json output", "xml output", "spreadsheet", "powerpoint", "presentation slide", "leaderboard", "ranking", "scoreboard", "clipart", "clip art",
    "graphic design", "minimalistic art",
]
NANO_REJECT = [
    "illustration", "cartoon", "anime", "cgi", "comic", "line drawing", "sketch", "digital painting", "3d render", "pixel art", "vector art", "watercolor",
    "oil painting", "pencil drawing", "manga", "screenshot", "user interface", "app interface", "chat interface", "settings page", "settings menu", "status bar",
    "navigation bar", "toolbar", "menu bar", "dialog box", "browser window", "browser tab", "address bar", "url bar", "home screen", "lock screen", "search bar",
    "file manager", "task manager", "control panel", "google maps", "google earth", "street view", "map pin", "satellite view", "map interface", "tweet", "retweet",
    "like button", "follow button", "comment section", "social media post", "verified badge", "instagram post", "tiktok", "facebook post", "reddit post", "meme",
    "impact font", "text overlay", "top text", "bottom text", "demotivational", "reaction image", "rage comic", "error message", "error screen", "loading screen",
    "code snippet", "terminal", "command line", "source code", "stack trace", "api response", "json output", "xml output", "spreadsheet", "powerpoint",
    "presentation slide", "leaderboard", "ranking", "scoreboard",
]
GPT_REJECT = [
    "illustration", "cartoon", "anime", "cgi", "comic", "line drawing", "sketch", "digital painting", "3d render", "pixel art", "vector art", "watercolor",
    "oil painting", "oil on canvas", "pencil drawing", "manga", "screenshot", "user interface", "app interface", "chat interface", "settings page", "settings menu",
    "status bar", "navigation bar", "toolbar", "menu bar", "dialog box", "browser window", "browser tab", "address bar", "url bar", "home screen", "lock screen",
    "search bar", "file manager", "task manager", "control panel", "google maps", "google earth", "map pin", "satellite view", "map interface", "tweet", "retweet",
    "like button", "follow button", "comment section", "social media post", "verified badge", "instagram post", "tiktok", "facebook post", "reddit post", "meme",
    "impact font", "text overlay", "top text", "bottom text", "demotivational", "reaction image", "rage comic", "speech bubble", "speech bubbles", "thought bubble",
    "word balloon", "dialogue bubble", "error message", "error screen", "loading screen", "code snippet", "terminal", "command line", "source code", "stack trace",
    "api response", "json output", "xml output", "spreadsheet", "powerpoint", "presentation slide", "leaderboard", "ranking", "scoreboard", "clipart", "clip art",
    "graphic design", "minimalistic art",
]
TEXT_PAIRED_KEYWORDS = [
    "table", "chart", "bar chart", "pie chart", "histogram", "scatter plot", "flow chart", "org chart", "gantt chart", "conversation", "chat bubble", "chat message",
    "text message", "notification", "login", "sign in", "sign up", "before and after", "side by side", "comparison", "collage", "grid of images", "photo grid",
    "infographic", "diagram", "schematic", "document", "receipt", "invoice", "certificate", "floor plan", "blueprint",
]
TEXT_INDICATORS = [
    "text", "font", "typed", "written", "caption", "heading", "title", "label", "header", "paragraph", "sentence", "words", "data", "numbers", "rows", "columns", "cells",
    "grid", "spreadsheet", "screenshot", "user interface", "browser",
]
INFLUENCER_REJECT = [
    "illustration", "cartoon", "anime", "cgi", "comic", "screenshot", "3d_render", "pixel_art", "watercolor",
]
INFLUENCER_PAIRED = [
    "table", "chart", "conversation", "notification", "infographic",
]
INFLUENCER_INDICATORS = [
    "text", "font", "typed", "data", "numbers", "screenshot",
]
BLOCKED = [
    "penis", "vagina", "vulva", "genitals", "testicle", "labia", "clitoris", "phallus",
]
BLOCKED_GORE = [
    "penis", "vagina", "vulva", "genitals", "testicle", "labia", "clitoris", "phallus", "gore", "blood", "severed", "dismembered",
]
BLOCKED_NUDE = [
    "penis", "vagina", "vulva", "genitals", "testicle", "labia", "clitoris", "phallus", "gore", "blood", "severed", "dismembered", "nude", "naked", "topless", "nipple",
]
INFLUENCER_BLOCKED = [
    "penis", "vagina", "vulva", "genitals", "testicle", "labia", "clitoris",
]
CAMERA_EXIF_TAGS = [
    "Make", "Model", "ExposureTime", "FNumber", "ISOSpeedRatings", "FocalLength",
]
INFLUENCER_EXIF_TAGS = [
    "Make", "Model", "ExposureTime", "FNumber", "ISOSpeedRatings",
]
IMAGE_HOSTS = [
    "i.redd.it", "preview.redd.it", "i.imgur.com",
]
GROK_FLAIRS = [
    "Discussion", "Question", "Help", "Meta", "Feedback", "Sub Meta", "Announcement", "Poll", "Rant", "Debate", "Bug", "Feature Request", "Meme", "Humor", "Funny",
    "Shitpost", "Sloppost/Fard", "Defending AI", "Luddite Logic", "News", "Comparison", "Video", "AI TEXT", "AI Developments",
]
GROK_TITLES = [
    " vs ", " vs.", "versus", "comparison", "compared to", "better than", "benchmark", "ranking", "tier list", "side by side", "side-by-side", "before/after",
    "before and after", "censored", "moderated", "content moderation", "censorship", "ban ", "banned", "jailbreak", "jailbroken", "loosen censorship", "bring back",
    "old grok", "uncensored", "pov:", "when you", "me when", "mfw", "mrw", "tfw", "unpopular opinion", "hot take", "am i the only", "change my mind", "petition",
    "protest", "boycott", "goodbye", "rip ", " rip,", "update", "changelog", "release notes", "midjourney", "dall-e", "dalle", "stable diffusion", "seedream", "imagen",
    "ideogram", "flux", "chatgpt", "gemini image",
]
GPT_WANTED = [
    "image - chatgpt :a2:", "image - chatgpt", "gpt-4o",
]
GPT_FLAIRS = [
    "Discussion", "Question", "Help", "News", "News Article", "ANNOUNCEMENT", "Mod Post", "Research", "Tutorial", "Guide", "Video", "Music", "Text", "Politics", "Sora",
    "GPTs", "Project", "Miscellaneous", "Unverified", "Prompt", "Programming", "Writing", "Commercial", "Stable Diffusion", "Nightcafe", "FLUX", "Midjourney",
    "Image - Google Gemini", "Image - Stable Diffusion", "Image - Midjourney", "Image - FLUX", "Image - SoraAI", "Image - Nightcafe", "Image - Bing Image Creator",
    "Image - Microsoft Copilot", "DALL·E 3", "DALL-E 3", "dalle-3", "DALL·E 2",
]
GPT_TITLES = [
    " vs ", " vs.", "versus", "comparison", "compared to", "benchmark", "ranking", "showdown", "side by side", "side-by-side", "midjourney", "stable diffusion", "flux",
    "gemini", "grok", "ideogram", "seedream", "nano banana", "dall-e", "dalle", "screenshot", "bug", "error", "issue", "help", "why does", "why is", "how to", "glitch",
    "censored", "jailbreak", "banned", "guardrails", "rate limit", "too many requests", "pov:", "when you", "me when", "mfw", "tfw", "meme", "change my mind", "petition",
    "boycott", "update", "changelog", "subscription", "pricing", "limit", "cap", "api", "review",
]
ALL_FORMATS = [
    "JPEG", "PNG", "WEBP",
]

# ---------------------------------------------------------------- fixed values: known ratios, in the order in which they are tried

MIDJOURNEY_RATIOS = [(1, 1), (16, 9), (9, 16), (3, 2), (2, 3), (4, 3), (3, 4), (4, 5), (5, 4), (7, 4), (4, 7), (21, 9), (9, 21), (2, 1), (1, 2), (3, 1), (1, 3)]
SOUL_RATIOS = [(1, 1), (16, 9), (9, 16), (3, 2), (2, 3), (4, 3), (3, 4), (21, 9), (9, 21), (5, 4), (4, 5), (7, 4), (4, 7)]
FLUX_RATIOS = [(1, 1), (16, 9), (9, 16), (3, 2), (2, 3), (4, 3), (3, 4), (21, 9), (9, 21), (5, 4), (4, 5), (7, 4), (4, 7), (2, 1), (1, 2)]
NANO_RATIOS = [(1, 1), (2, 3), (3, 2), (3, 4), (4, 3), (4, 5), (5, 4), (9, 16), (16, 9), (21, 9), (1, 4), (4, 1), (1, 8), (8, 1)]
INFLUENCER_RATIOS = [(1, 1), (4, 5), (5, 4), (16, 9), (9, 16), (3, 4), (4, 3)]
RECRAFT_RATIOS = [(1, 1), (4, 3), (3, 4), (3, 2), (2, 3), (16, 9), (9, 16), (2, 1), (1, 2), (5, 4), (4, 5), (7, 5), (5, 7), (5, 3), (3, 5)]
GPT_RATIOS = [(1, 1), (3, 2), (2, 3)]
GROK_RATIOS = [(1, 1), (16, 9), (9, 16), (4, 3), (3, 4), (3, 2), (2, 3), (2, 1), (1, 2), (11, 6), (6, 11), (19.5, 9), (9, 19.5), (20, 9), (9, 20)]
SEEDREAM_RATIOS = [(1, 1), (16, 9), (9, 16), (3, 2), (2, 3), (4, 3), (3, 4), (21, 9), (9, 21), (3, 1), (1, 3), (4, 1), (1, 4), (5, 4), (4, 5), (7, 4), (4, 7)]
INSTAGRAM_RATIOS = [(1, 1), (4, 5), (5, 4), (16, 9), (9, 16), (3, 4), (4, 3), (3, 2), (2, 3)]


# ---------------------------------------------------------------- configurations


@dataclass(frozen=True)
class PostRules:
    """What the posts of a dataset must be like; a limit of 0, and empty lists, ask for nothing."""

    min_created: int = 0
    skip_self: bool = False
    require_flairs: list[str] = field(default_factory=list)
    reject_flairs: list[str] = field(default_factory=list)
    reject_titles: list[str] = field(default_factory=list)
    hosts: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class DatasetConfig:
    """A dataset's limits and rules; what isn't given has the validation's own defaults."""

    name: str
    min_pixels: int = 200_000
    max_pixels: int = 5_000_000
    formats: list[str] = field(default_factory=lambda: ["JPEG", "PNG"])
    max_avg_quantization: float = 15.0
    ratios: list[tuple[float, float]] = field(default_factory=list)
    ratio_tolerance: float = 0.05
    exif_tags: list[str] = field(default_factory=list)
    reject: list[str] = field(default_factory=list)
    paired: list[str] = field(default_factory=list)
    indicators: list[str] = field(default_factory=list)
    blocked: list[str] = field(default_factory=list)
    posts: PostRules = field(default_factory=PostRules)


def _generator(name: str, low: int, high: int, tolerance: float, ratios: list[tuple[float, float]], reject: list[str], blocked: list[str], formats: list[str] = ALL_FORMATS, posts: PostRules | None = None) -> DatasetConfig:
    return DatasetConfig(name, low, high, formats, 40.0, ratios, tolerance, CAMERA_EXIF_TAGS, reject, TEXT_PAIRED_KEYWORDS, TEXT_INDICATORS, blocked, posts or PostRules())


# Each dataset's limits and rules.
DATASETS = [
    _generator("midjourney_v7", 500_000, 20_000_000, 0.08, MIDJOURNEY_RATIOS, REJECT_KEYWORDS, BLOCKED_GORE),
    _generator("soul2", 500_000, 25_000_000, 0.08, SOUL_RATIOS, PLAIN_REJECT, BLOCKED_GORE),
    _generator("flux1", 200_000, 5_000_000, 0.06, FLUX_RATIOS, REJECT_KEYWORDS, BLOCKED),
    _generator("nano_banana_1_2", 650_000, 18_000_000, 0.05, NANO_RATIOS, NANO_REJECT, BLOCKED_GORE),
    DatasetConfig("instagram_ai_influencer", 200_000, 10_000_000, ALL_FORMATS, 15.0, INFLUENCER_RATIOS, 0.10, INFLUENCER_EXIF_TAGS, INFLUENCER_REJECT, INFLUENCER_PAIRED, INFLUENCER_INDICATORS, INFLUENCER_BLOCKED),
    _generator("recraft_3_4", 500_000, 5_000_000, 0.05, RECRAFT_RATIOS, PLAIN_REJECT, BLOCKED_NUDE),
    _generator("gpt_image_1", 800_000, 30_000_000, 0.05, GPT_RATIOS, GPT_REJECT, BLOCKED_GORE, posts=PostRules(1_743_465_600, True, GPT_WANTED, GPT_FLAIRS, GPT_TITLES, IMAGE_HOSTS)),
    _generator("grok", 800_000, 5_000_000, 0.05, GROK_RATIOS, REJECT_KEYWORDS, BLOCKED, ["JPEG", "PNG"], PostRules(0, True, [], GROK_FLAIRS, GROK_TITLES, IMAGE_HOSTS)),
    _generator("flux2", 200_000, 5_000_000, 0.06, FLUX_RATIOS, REJECT_KEYWORDS, BLOCKED),
    _generator("seedream4", 500_000, 20_000_000, 0.08, SEEDREAM_RATIOS, PLAIN_REJECT, BLOCKED_GORE),
    DatasetConfig("instagram_real", 200_000, 50_000_000, ALL_FORMATS, 15.0, INSTAGRAM_RATIOS, 0.15),
]

_registry = {c.name: c for c in DATASETS}


def register_dataset(config: DatasetConfig) -> None:
    """Adds a dataset, or replaces the one of that name."""
    _registry[config.name] = config


def dataset(name: str) -> DatasetConfig:
    return _registry[name]


def dataset_names() -> list[str]:
    return list(_registry)


def ratio_label(w: float, h: float) -> str:
    return f"{w:g}:{h:g}"


def dim_dataset(spark: SparkSession) -> DataFrame:
    rows = [(c.name, c.min_pixels, c.max_pixels, c.max_avg_quantization, c.ratio_tolerance, c.formats, c.exif_tags) for c in _registry.values()]
    return spark.createDataFrame(rows, "dataset string, min_pixels long, max_pixels long, max_avg_quantization double, ratio_tolerance double, formats array<string>, exif_tags array<string>")


def dim_keyword(spark: SparkSession) -> DataFrame:
    """``dataset, kind, ord, keyword`` of all rule words."""
    kinds = {"reject": "reject", "paired": "paired", "indicator": "indicators", "blocked": "blocked"}
    rows = [(c.name, kind, i, w) for c in _registry.values() for kind, name in kinds.items() for i, w in enumerate(getattr(c, name))]
    rows += [(c.name, "title", i, w) for c in _registry.values() for i, w in enumerate(c.posts.reject_titles)]
    return spark.createDataFrame(rows, "dataset string, kind string, ord int, keyword string")


def dim_ratio(spark: SparkSession) -> DataFrame:
    rows = [(c.name, i, float(w), float(h)) for c in _registry.values() for i, (w, h) in enumerate(c.ratios)]
    return spark.createDataFrame(rows, "dataset string, ord int, w double, h double")
