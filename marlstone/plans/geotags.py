"""Tags used in each country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import has_tags, tag_list
from marlstone.operators.aggregates import count_by_value
from marlstone.operators.geo import box_of


def located_pictures(photos: DataFrame, boxes: DataFrame, strict: bool = True) -> DataFrame:
    """``photo_id, country, tags`` of the pictures that have tags and lie in a box.

    A tag list that cannot be decoded stops the query; unless ``strict``, its picture counts as one
    without tags.

    Tags are tested before the location, so that pictures without any are never located.
    """
    tagged = photos.select(
        "photo_id", "longitude", "latitude", tag_list(F.col("user_tags"), strict).alias("tags")
    ).where(has_tags(F.col("tags")))
    located = box_of(tagged, boxes, "longitude", "latitude")
    return located.where(F.col("country").isNotNull()).select("photo_id", "country", "tags")


def tags_by_country(pictures: DataFrame) -> DataFrame:
    """One row per use of a tag: the flattened tag list of each country, kept in long form."""
    return pictures.select("photo_id", "country", F.explode("tags").alias("tag"))


def tag_counts_by_country(pictures: DataFrame) -> DataFrame:
    """``country, tag, n``; see ``operators.aggregates.count_maps`` for the map form."""
    return count_by_value(tags_by_country(pictures), "country", "tag")
