"""Recommendations from the users whose genre profile is nearest to a given one."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators.aggregates import dense_counts
from marlstone.operators.relational import at_least_group_mean, lookup

# The genres a profile counts.
GENRES = [
    "Action", "Adventure", "Animation", "Children's", "Comedy", "Crime", "Documentary", "Drama",
    "Fantasy", "Film-Noir", "Horror", "Musical", "Mystery", "Romance", "Sci-Fi", "Thriller", "War",
    "Western",
]
# The sample profile recommendations are made for.
SAMPLE_PROFILE = {
    "Action": 6, "Adventure": 4, "Animation": 34, "Children's": 1, "Comedy": 23, "Crime": 1,
    "Documentary": 1, "Drama": 2, "Fantasy": 1, "Film-Noir": 1, "Horror": 1, "Musical": 1,
    "Mystery": 1, "Romance": 1, "Sci-Fi": 32, "Thriller": 1, "War": 4, "Western": 1,
}
# Neighbours asked and titles given.
NEIGHBOURS, TITLES = 10, 25


def liked(ratings: DataFrame) -> DataFrame:
    """Ratings that are at least their user's mean."""
    return at_least_group_mean(ratings, ["user"], "rating")


def genre_profiles(
    liked_ratings: DataFrame,
    movies: DataFrame,
    genres: Sequence[str] = GENRES,
    keys: Sequence[str] = ("user",),
) -> DataFrame:
    """``keys`` and one count per genre over the items the user likes, zero where there is none.

    Genres outside the list do not count; a user without a listed genre keeps an all-zero profile.
    """
    tagged = liked_ratings.join(movies.select("item", "genres"), "item", "left")
    exploded = tagged.select(*keys, F.explode_outer("genres").alias("genre"))
    return dense_counts(exploded, keys, F.col("genre"), genres)


def similarity(profile: Mapping[str, int]) -> Column:
    """Cosine of a row of genre counts with a fixed profile; null for an all-zero row."""
    counts = {genre: F.col(f"`{genre}`").cast("double") for genre in profile}
    dot = sum((F.lit(float(w)) * counts[g] for g, w in profile.items()), F.lit(0.0))
    squares = sum((n * n for n in counts.values()), F.lit(0.0))
    length = math.sqrt(sum(w * w for w in profile.values()))
    return F.try_divide(dot, F.lit(length) * F.sqrt(squares))


def similar_users(
    profiles: DataFrame, profile: Mapping[str, int], k: int = NEIGHBOURS, keep: Sequence[str] = ()
) -> DataFrame:
    """The ``k`` users with the greatest similarity, as ``user, sim`` and the columns in ``keep``.

    The lower user comes first on ties.
    """
    return (
        profiles.select("user", *keep, similarity(profile).alias("sim"))
        .orderBy(F.desc_nulls_last("sim"), "user")
        .limit(k)
    )


def best_titles(rated: DataFrame, movies: DataFrame, n: int = TITLES) -> DataFrame:
    """``title, rating`` of the ``n`` best distinct titles in ``user, item, rating, sim`` rows.

    Titles go by rating, then by the nearness of the user who gave it, then by item; a title keeps
    its best place only. The placing is the least sort key per title, so titles that many users share
    are reduced before the shuffle.
    """
    place = F.struct(
        (-F.col("rating")).alias("down"),
        (-F.coalesce(F.col("sim"), F.lit(-2.0))).alias("far"),
        F.col("user"),
        F.col("item"),
    )
    return (
        lookup(rated, movies, ["item"], "title")
        .groupBy("title")
        .agg(F.min(place).alias("place"))
        .orderBy("place")
        .limit(n)
        .select("title", (-F.col("place.down")).alias("rating"))
    )


def merge_titles(
    neighbours: DataFrame, liked_ratings: DataFrame, movies: DataFrame, n: int = TITLES
) -> DataFrame:
    """The best titles among the ratings of ``neighbours``, which holds one row for each of a few."""
    return best_titles(liked_ratings.join(neighbours, "user"), movies, n)


def recommend(
    ratings: DataFrame,
    movies: DataFrame,
    profile: Mapping[str, int],
    k: int = NEIGHBOURS,
    n: int = TITLES,
) -> DataFrame:
    """``title, rating`` of the ``n`` titles the ``k`` users nearest to ``profile`` like best.

    Each profile carries its user's mean, so the neighbours' liked ratings come from one pass over
    the ratings beside a broadcast of ``k`` rows.
    """
    # Both passes drop unusable ratings first: with equal filters they can read one shuffle.
    ratings = ratings.where("user is not null and item is not null and rating is not null")
    rated = at_least_group_mean(ratings, ["user"], "rating", mean="user_mean")
    profiles = genre_profiles(rated, movies, list(profile), ["user", "user_mean"])
    neighbours = similar_users(profiles, profile, k, keep=["user_mean"])
    theirs = ratings.join(F.broadcast(neighbours), "user").where("rating >= user_mean")
    return best_titles(theirs, movies, n)
