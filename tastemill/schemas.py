"""Explicit schemas of all tables, as DDL text; nothing is ever inferred."""

from __future__ import annotations

RATINGS = "userId BIGINT, movieId BIGINT, rating DOUBLE, timestamp BIGINT"
MOVIES = "movieId BIGINT, title STRING, genres STRING"
TAGS = "userId BIGINT, movieId BIGINT, tag STRING, timestamp BIGINT"
# tmdbId is read as text and coerced, so that a malformed id becomes null.
LINKS = "movieId BIGINT, imdbId STRING, tmdbId STRING"
GENOME_SCORES = "movieId BIGINT, tagId INT, relevance DOUBLE"
GENOME_TAGS = "tagId INT, tag STRING"
METADATA_RAW = "tmdbId BIGINT, raw STRING"
METADATA_JSON = (
    "overview STRING, poster_path STRING, release_date STRING, runtime INT, "
    "vote_average DOUBLE, vote_count BIGINT, popularity DOUBLE, original_language STRING, "
    "genres ARRAY<STRUCT<name: STRING>>, "
    "credits STRUCT<`cast`: ARRAY<STRUCT<name: STRING>>, crew: ARRAY<STRUCT<job: STRING, name: STRING>>>"
)

