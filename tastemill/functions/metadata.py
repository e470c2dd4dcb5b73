"""Flatten nested metadata records with one declared JSON schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..config import IMAGE_BASE, IMAGE_SIZE, TOP_CAST


def _names(arr: Column) -> Column:
    return F.coalesce(F.transform(arr, lambda x: x["name"]), F.array().cast("array<string>"))


def cast_names(credits: Column, top_cast: int = TOP_CAST) -> Column:
    return _names(F.slice(credits["cast"], 1, top_cast))


def director_name(credits: Column) -> Column:
    return F.get(F.filter(credits["crew"], lambda c: c["job"] == "Director"), F.lit(0))["name"]


def genre_names(genres: Column) -> Column:
    return _names(genres)


def poster_url(path: Column, image_size: str = IMAGE_SIZE, image_base: str = IMAGE_BASE) -> Column:
    return F.when(F.length(path) > 0, F.concat(F.lit(f"{image_base}{image_size}"), path))


def flatten(
    raw: DataFrame,
    top_cast: int = TOP_CAST,
    image_size: str = IMAGE_SIZE,
    image_base: str = IMAGE_BASE,
) -> DataFrame:
    """(tmdbId, raw) to twelve flat columns; failed fetches (null raw) are skipped."""
    m = F.col("m")
    return (
        raw.filter(F.col("raw").isNotNull())
        .select("tmdbId", F.from_json("raw", schemas.METADATA_JSON).alias("m"))
        .select(
            "tmdbId",
            m["overview"].alias("overview"),
            poster_url(m["poster_path"], image_size, image_base).alias("poster_url"),
            m["release_date"].alias("release_date"),
            m["runtime"].alias("runtime_min"),
            m["vote_average"].alias("vote_average"),
            m["vote_count"].alias("vote_count"),
            m["popularity"].alias("popularity"),
            m["original_language"].alias("original_language"),
            genre_names(m["genres"]).alias("tmdb_genres"),
            cast_names(m["credits"], top_cast).alias("cast"),
            director_name(m["credits"]).alias("director"),
        )
    )
