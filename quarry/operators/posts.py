"""Why a post isn't taken: the first reason of a ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.config import PostRules
from quarry.functions.text import filled, substrings_found


def skip_reason(rules: PostRules, created: Column, is_self: Column, flair: Column, title: Column) -> Column:
    """too_old, self_post, flair_not_required:x, flair:x, title_keyword:k; null for a post that is taken."""
    flair, title = F.trim(F.lower(filled(flair))), F.lower(filled(title))
    required = [x.strip().lower() for x in rules.require_flairs]
    rejected = [x.strip().lower() for x in rules.reject_flairs]
    steps = []
    if rules.min_created:
        steps.append(F.when(F.coalesce(created, F.lit(0)) < rules.min_created, "too_old"))
    if rules.skip_self:
        steps.append(F.when(F.coalesce(is_self, F.lit(False)), "self_post"))
    if required:
        steps.append(F.when(~flair.isin(required), F.concat(F.lit("flair_not_required:"), F.when(flair == "", "none").otherwise(flair))))
    if rejected:
        steps.append(F.when((flair != "") & flair.isin(rejected), F.concat(F.lit("flair:"), flair)))
    if rules.reject_titles:
        steps.append(F.concat(F.lit("title_keyword:"), F.trim(F.get(substrings_found(title, rules.reject_titles), F.lit(0)))))
    return F.coalesce(*steps) if steps else F.lit(None).cast("string")


def reason_counts(posts: DataFrame, reason: str = "reason") -> DataFrame:
    """How many posts each kind of reason held back (``ok``: none)."""
    kind = F.coalesce(F.split_part(F.col(reason), F.lit(":"), F.lit(1)), F.lit("ok"))
    return posts.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
