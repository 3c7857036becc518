"""Topic string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repolens.schemas import NA, RE_TOPICS_CUT, RE_TOPICS_SPLIT, TOPICS_MAX_LENGTH


def join_topics_capped(topics: Column, max_length: int = TOPICS_MAX_LENGTH) -> Column:
    """Pipe-join a topic array; above ``max_length`` characters cut there and
    drop the last (cut or not) piece. NULL array -> ''."""
    joined = F.array_join(F.coalesce(topics, F.array().cast("array<string>")), "|")
    cut = F.regexp_replace(F.substring(joined, 1, max_length), RE_TOPICS_CUT, "")
    return F.when(F.length(joined) > max_length, cut).otherwise(joined)


def has_topic(topics_joined: Column) -> Column:
    return (topics_joined != F.lit("")).cast("int")


def split_topics(topics_joined: Column) -> Column:
    """Joined topics back to an array; '' becomes [NA]."""
    return F.split(F.when(topics_joined == "", F.lit(NA)).otherwise(topics_joined), RE_TOPICS_SPLIT)
