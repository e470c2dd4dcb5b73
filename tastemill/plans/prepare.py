"""Full preparation: filter, align, encode, split, enrich, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import (
    MIN_MOVIE_RATINGS,
    MIN_RATINGS_PER_USER_SPLIT,
    MIN_USER_RATINGS,
    TEST_RATIO,
    VAL_RATIO,
)
from ..functions import metadata
from ..operators import filtering, indexing, matrices, splitting, tag_text
from ..sources import tables


def enrich_items(
    movies: DataFrame,
    movie_index: DataFrame,
    links: DataFrame,
    flat_metadata: DataFrame,
    tags: DataFrame | None = None,
) -> DataFrame:
    """One row per indexed item with links, flat metadata and, given tags, the
    tag text. Feature groups take tag rows and need no text column."""
    items = (
        movies.join(movie_index.hint("merge"), "movieId")
        .join(links.hint("merge"), "movieId", "left")
        .join(flat_metadata.hint("merge"), "tmdbId", "left")
    )
    return items if tags is None else items.join(tag_text.concat_tags(tags), "movieId", "left")


def prepare(
    spark: SparkSession,
    ratings: DataFrame,
    movies: DataFrame,
    tags: DataFrame,
    links: DataFrame,
    genome_scores: DataFrame,
    metadata_raw: DataFrame,
    out: str,
    min_user_ratings: int = MIN_USER_RATINGS,
    min_movie_ratings: int = MIN_MOVIE_RATINGS,
    min_ratings_per_user: int = MIN_RATINGS_PER_USER_SPLIT,
    val_ratio: float = VAL_RATIO,
    test_ratio: float = TEST_RATIO,
    genome_tags: DataFrame | None = None,
) -> dict[str, str]:
    """Write all prepared tables under ``out`` and return their paths.

    Each stage reads the written output of the stage before, so the activity
    filter and the split are computed once and a lost executor costs one stage.
    Tag text is a table of numbered chunks, next to the items. ``genome_tags``
    (tagId, tag) names the columns of the genome vectors.
    """
    paths = {
        name: f"{out}/{name}"
        for name in ("filtered", "user_index", "movie_index", "ratings", "genome", "items", "tags", "tag_text")
    }
    filtered = filtering.filter_ratings(ratings, min_user_ratings, min_movie_ratings)
    tables.write_parquet(filtered, paths["filtered"])
    filtered = spark.read.parquet(paths["filtered"])

    for key, idx, name in (("userId", "user_idx", "user_index"), ("movieId", "movie_idx", "movie_index")):
        tables.write_parquet(indexing.build_index(filtered, key, idx), paths[name])
    users, index = (spark.read.parquet(paths[n]) for n in ("user_index", "movie_index"))

    encoded = indexing.attach_index(indexing.attach_index(filtered, index, "movieId"), users, "userId")
    split = splitting.temporal_split(encoded, val_ratio, test_ratio, min_ratings_per_user)
    tables.write_parquet(split, paths["ratings"], partition_by=["split"])

    kept_tags = filtering.align_to_ratings(tables.clean_tags(tags), index)
    tables.write_parquet(kept_tags, paths["tags"])
    kept_scores = filtering.align_to_ratings(genome_scores, index)
    tables.write_parquet(matrices.genome_vectors(kept_scores, index), paths["genome"])
    tables.write_parquet(tag_text.tag_chunks(spark.read.parquet(paths["tags"])), paths["tag_text"])
    if genome_tags is not None:
        paths["genome_tags"] = f"{out}/genome_tags"
        tables.write_parquet(genome_tags.select("tagId", "tag"), paths["genome_tags"])
    items = enrich_items(tables.preprocess_movies(movies), index, tables.type_links(links), metadata.flatten(metadata_raw))
    tables.write_parquet(items, paths["items"])
    return paths
