"""Rules over captions, titles, URLs and messages, as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What may stand beside a whole word: anything but letters, digits and the underscore, in all scripts.
BEFORE, AFTER = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"

#: Words of a list that are looked for one by one.
FEW = 16


def whole_word(word: str) -> str:
    """A pattern for ``word`` as a whole word, the same in Java and in RE2."""
    return BEFORE + re.sub(r"([^\w\s])", r"\\\1", word) + AFTER


def has_word(text: Column, word: str) -> Column:
    """Whether ``word`` stands in ``text`` as a whole word; the pattern is only tried where the plain search finds it."""
    return text.contains(word) & text.rlike(whole_word(word))


def named(checks: Sequence[tuple[str, Column]]) -> Column:
    """The names of the checks that hold, in order.  (A concatenation of arrays is compiled; taking nulls out of one is not.)"""
    none = F.array().cast("array<string>")
    each = [F.when(F.coalesce(c, F.lit(False)), F.array(F.lit(name))).otherwise(none) for name, c in checks]
    return F.concat(*each) if each else none


def word_tokens(text: Column) -> Column:
    """The whole words of a text: runs of letters, digits and underscores."""
    return F.split(text, r"[^\p{L}\p{N}_]+")


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _by_tokens(words: Sequence[str]) -> tuple[list[str], list[str], list[str], list[str]]:
    """Those of ``words`` that are one token, those of several, the first tokens of these, and those without any."""
    single = [w for w in words if re.fullmatch(r"\w+", w)]
    several = [w for w in words if w not in single and re.search(r"\w", w)]
    heads = list(dict.fromkeys(re.search(r"\w+", w).group() for w in several))  # type: ignore[union-attr]
    return single, several, heads, [w for w in words if not re.search(r"\w", w)]


def words_found(text: Column, words: Sequence[str]) -> Column:
    """Those of ``words`` that stand in ``text`` as whole words, in their own order, each once.  ``text`` is lower-cased already.

    A long list is met with the text's words by hash, which are cut once, however long it is; what has several words is only looked
    for where its first word was found.  Up to ``FEW`` words are looked for one by one, which takes less than cutting the text.
    """
    words = list(dict.fromkeys(words))
    if len(words) <= FEW:
        return named([(w, has_word(text, w)) for w in words])
    single, several, heads, signs = _by_tokens(words)
    tokens = word_tokens(text)
    found = [F.array_intersect(_strings(single), tokens)] if single else []
    if several:
        found.append(F.when(F.arrays_overlap(_strings(heads), tokens), named([(w, has_word(text, w)) for w in several])).otherwise(F.array().cast("array<string>")))
    if signs:
        found.append(named([(w, has_word(text, w)) for w in signs]))
    return found[0] if len(found) == 1 and not signs else F.array_intersect(_strings(words), F.concat(*found))


def any_word(text: Column, words: Sequence[str]) -> Column:
    """Whether any of ``words`` stands in ``text`` as a whole word."""
    if len(words) > FEW:
        return F.size(words_found(text, words)) > 0
    out = F.lit(False)
    for w in words:
        out = out | has_word(text, w)
    return out


def reject_signals(caption: Column, reject: Sequence[str], paired: Sequence[str] = (), indicators: Sequence[str] = ()) -> Column:
    """Reject words of a caption; words of ``paired`` count only beside an indicator."""
    text = F.lower(F.coalesce(caption, F.lit("")))
    strong = words_found(text, reject)
    weak = F.when(any_word(text, indicators), words_found(text, paired)).otherwise(F.array().cast("array<string>")) if paired and indicators else F.array().cast("array<string>")
    return F.concat(strong, weak)


def substrings_found(text: Column, words: Sequence[str]) -> Column:
    """Those of ``words`` that ``text`` contains anywhere, in their own order."""
    return named([(w, text.contains(w)) for w in words])


def blocked_tags(tags: Column, blocked: Sequence[str]) -> Column:
    """Blocked words within booru tags; ``tags`` may be an array, which is joined by commas."""
    return substrings_found(F.lower(F.coalesce(tags, F.lit(""))), blocked)


def joined_tags(tags: Column) -> Column:
    return F.array_join(tags, ", ")


def first_filled(*cols: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.when(c != "", c) for c in cols))


def filled(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# ---------------------------------------------------------------- URLs and files


def extension(url: Column, content_type: Column) -> Column:
    """The file extension for a download: by type, path or query, PNG before WEBP, else .jpg."""
    low = F.lower(filled(url))
    bare, kind = F.split_part(low, F.lit("?"), F.lit(1)), F.lower(filled(content_type))

    def is_kind(name: str) -> Column:
        return kind.contains(name) | bare.endswith(f".{name}") | low.contains(f"format={name}")

    return F.when(is_kind("png"), ".png").when(is_kind("webp"), ".webp").otherwise(".jpg")


def content_name(content: Column, ext: Column) -> Column:
    """Content-addressed file name: 16 digits of the SHA-256 and the extension."""
    return F.concat(F.left(F.sha2(content, 256), F.lit(16)), ext)


def is_image_url(url: Column) -> Column:
    return F.lower(F.split_part(filled(url), F.lit("?"), F.lit(1))).rlike(r"\.(jpg|jpeg|png|webp)$")


def url_host(url: Column) -> Column:
    """The lower-cased host; null where the URL can't be parsed."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def original_size(src: Column) -> Column:
    """A media URL at its original size."""
    return F.when(src.contains("name="), F.regexp_replace(src, r"name=\w+", "name=orig")).otherwise(F.concat(src, F.lit("?format=jpg&name=orig")))


def largest_source(url: Column, srcset: Column, width: Column) -> Column:
    """The widest candidate of a srcset; the shown URL unless one is wider than it; of equals the first."""
    parts = F.transform(F.filter(F.split(filled(srcset), ","), lambda p: F.trim(p) != ""), lambda p: F.split(F.trim(p), r"\s+"))
    sized = F.transform(parts, lambda t: F.struct(F.get(t, F.lit(0)).alias("url"), F.coalesce(F.try_element_at(t, F.lit(2)).substr(F.lit(1), F.lit(12)).try_cast("string"), F.lit("")).alias("w")))
    start = F.struct(url.alias("url"), F.coalesce(width, F.lit(0)).cast("int").alias("w"))

    def wider(best: Column, c: Column) -> Column:
        w = F.coalesce(F.regexp_extract(c["w"], r"^(\d+)", 1).try_cast("int"), F.lit(0))
        return F.when(w > best["w"], F.struct(c["url"].alias("url"), w.alias("w"))).otherwise(best)

    return F.aggregate(sized, start, wider)["url"]


def slug(name: Column) -> Column:
    return F.replace(F.replace(F.lower(name), F.lit(" "), F.lit("_")), F.lit("."), F.lit(""))


def mime_type(path: Column) -> Column:
    kinds = F.create_map(*(F.lit(x) for x in (".jpg", "image/jpeg", ".jpeg", "image/jpeg", ".png", "image/png", ".webp", "image/webp", ".gif", "image/gif")))
    return F.coalesce(kinds[F.lower(F.regexp_extract(path, r"\.[^.]+$", 0))], F.lit("image/jpeg"))


def data_url(path: Column, content: Column) -> Column:
    """A file as it is sent to a model: its type and its bytes in base 64."""
    return F.concat(F.lit("data:"), mime_type(path), F.lit(";base64,"), F.base64(content))


def platform(source: Column) -> Column:
    return F.split_part(filled(source), F.lit(":"), F.lit(1))


def iso_time(at: Column) -> Column:
    """A moment in UTC as ISO 8601 writes it, to the microsecond."""
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


# ---------------------------------------------------------------- chat messages

EPOCH_MS = 1_420_070_400_000


def snowflake_of(ms: Column) -> Column:
    """The smallest message id of a moment in epoch milliseconds."""
    return F.shiftleft((ms - EPOCH_MS).cast("bigint"), 22)


def snowflake_ms(snowflake: Column) -> Column:
    return F.shiftright(snowflake.cast("bigint"), 22) + EPOCH_MS


def message_prompt(content: Column) -> Column:
    """What stands between double asterisks, else the first 200 characters."""
    return F.coalesce(F.nullif(F.regexp_extract(filled(content), r"\*\*(.+?)\*\*", 1), F.lit("")), F.left(filled(content), F.lit(200)))


def _component_version(cid: Column) -> Column:
    has = lambda *parts: F.greatest(*(cid.contains(p) for p in parts)) if len(parts) > 1 else cid.contains(parts[0])
    return F.when(has("_v8", "v8_"), "8").when(has("_v7", "v7_"), "7").when(has("v6r1", "_v6.1"), "6.1").when(has("_v6", "v6_"), "6").when(has("_v5", "v5_"), "5")


def message_version(custom_ids: Column, content: Column) -> Column:
    """The version that the first telling component names, else the ``--v`` flag, else unknown."""
    named = F.get(F.filter(F.transform(F.coalesce(custom_ids, F.array().cast("array<string>")), lambda c: _component_version(filled(c))), lambda v: v.isNotNull()), F.lit(0))
    flag = F.regexp_extract(filled(content), r"--v\s+(\d+(?:\.\d+)?)", 1)
    return F.coalesce(named, F.nullif(flag, F.lit("")), F.lit("unknown"))


def is_upscaled(content: Column) -> Column:
    return filled(content).contains("Upscaled")


# ---------------------------------------------------------------- tagged answers


def tagged(content: Column, tag: str, over_lines: bool = False) -> Column:
    """The trimmed text within an XML-like tag of any case; null if there is none."""
    flags = "(?is)" if over_lines else "(?i)"
    found = F.regexp_extract_all(filled(content), F.lit(rf"{flags}<{tag}>\s*(.*?)\s*</{tag}>"), F.lit(1))
    return F.trim(F.get(found, F.lit(0)))


def parsed_answer(content: Column) -> Column:
    """``category, is_ai_art, reason, raw`` of a vision model's answer, with its defaults."""
    empty = filled(content) == ""
    yes = F.lower(tagged(content, "is_ai_art")).isin("true", "yes", "1")
    return F.struct(
        F.coalesce(F.upper(tagged(content, "category")), F.lit("UNKNOWN")).alias("category"),
        F.coalesce(yes, F.lit(True)).alias("is_ai_art"),
        F.when(empty, "Empty response").otherwise(F.left(F.coalesce(tagged(content, "reason", True), F.lit("")), F.lit(200))).alias("reason"),
        F.left(filled(content), F.lit(500)).alias("raw"),
    )
