"""Model recipes: which feature groups, with which weights."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (
    CAST_COMPONENTS,
    CAST_TOP_N,
    DIRECTOR_COMPONENTS,
    GENRES,
    OVERVIEW_COMPONENTS,
    TAGS_COMPONENTS,
    TOP_K,
    TfidfParams,
)
from ..functions import text
from ..operators import features, similarity, svd, tfidf
from ..session import cut_lineage


@dataclass(frozen=True)
class ModelSpec:
    name: str
    groups: tuple[tuple[str, float], ...]
    metric: str = "cosine"
    strategy: str = "mean_centering"
    top_k: int = TOP_K

    def __post_init__(self):
        similarity.check_metric(self.metric)
        similarity.check_strategy(self.strategy)


def _spec(name: str, **weights: float) -> ModelSpec:
    return ModelSpec(name, tuple(weights.items()))


# Groups and weights of the nine content-based recipes.
SPECS: dict[str, ModelSpec] = {
    s.name: s
    for s in (
        _spec("cb1", genome=1.0),
        _spec("cb2", genres=1.0, year=1.0),
        _spec("cb3", genome=1.0, genres=0.5, year=0.2),
        _spec("cb4", genome=1.0, tags=0.5),
        _spec("cb5", overview=1.0),
        _spec("cb6", embedding=1.0),
        _spec("cb7", cast=0.8, director=1.0, numerical=0.3),
        _spec("cb8", genome=1.0, genres=0.5, year=0.2, tags=0.5, overview=1.0, cast=0.5, director=0.8, numerical=0.3),
        _spec("cb9", genome=1.0, embedding=1.0, cast=0.5, director=0.8),
    )
}


@dataclass
class FeatureGroups:
    """Feature groups of one item table, each built once and shared by all specs.

    ``items`` needs movie_idx and the columns of the groups used; ``tags`` are
    (movieId, tag) rows; ``extra`` adds groups by name, each a function from the
    items to (movie_idx, features).
    """

    items: DataFrame
    genome: DataFrame | None = None
    embeddings: DataFrame | None = None
    tags: DataFrame | None = None
    genre_vocabulary: tuple[str, ...] = GENRES
    tag_params: TfidfParams = TfidfParams()
    overview_params: TfidfParams | None = None
    components: dict[str, int] = field(default_factory=dict)
    extra: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    def __post_init__(self):
        self._built: dict[str, DataFrame] = {}

    @cached_property
    def index(self) -> DataFrame:
        return self.items.select("movie_idx", *(["movieId"] if "movieId" in self.items.columns else []))

    def get(self, name: str) -> DataFrame:
        """(movie_idx, features) of a group; its written rows serve every spec."""
        if name not in self._built:
            build = self.extra.get(name) or getattr(self, f"_{name}", None)
            if build is None:
                raise ValueError(f"unknown feature group '{name}'")
            frame = build(self.items) if name in self.extra else build()
            self._built[name] = cut_lineage(frame)
        return self._built[name]

    def combined(self, spec: ModelSpec) -> DataFrame:
        return features.combine([(self.get(g), w) for g, w in spec.groups], self.index)

    def _components(self, name: str, default: int) -> int:
        return self.components.get(name, default)

    def _genome(self):
        return self.genome if self.genome is not None else features.empty(self.items)

    def _genres(self):
        return features.genres(self.items, self.genre_vocabulary)

    def _year(self):
        return features.year(self.items)

    def _numerical(self):
        return features.numerical(self.items)

    def _embedding(self):
        return self.embeddings if self.embeddings is not None else features.empty(self.items)

    def _tags(self):
        k = self._components("tags", TAGS_COMPONENTS)
        if self.tags is not None:
            return self._text_svd(tfidf.tag_term_counts(self.tags, self.index), self.tag_params, k)
        return self._text_column("user_tags_text", self.tag_params, k)

    def _overview(self):
        params = self.overview_params or TfidfParams(stop_words=tfidf.english_stop_words())
        return self._text_column("overview", params, self._components("overview", OVERVIEW_COMPONENTS))

    def _text_column(self, column: str, params: TfidfParams, k: int):
        if column not in self.items.columns:
            return features.empty(self.items)
        return self._text_svd(tfidf.term_counts(self.items, "movie_idx", column), params, k)

    def _text_svd(self, counts: DataFrame, params: TfidfParams, k: int):
        rows, vocab = tfidf.fit_tfidf(counts, self.items, params)
        return self._project(rows, vocab.count(), k)

    def _director(self):
        if "director" not in self.items.columns:
            return features.empty(self.items)
        labels = self.items.select(F.col("movie_idx").alias("doc"), text.token("dir_", F.col("director")).alias("label"))
        return self._label_svd(labels, self._components("director", DIRECTOR_COMPONENTS))

    def _cast(self):
        if "cast" not in self.items.columns:
            return features.empty(self.items)
        name = F.explode(text.first_n(text.as_list(self.items, "cast"), CAST_TOP_N))
        labels = self.items.select(F.col("movie_idx").alias("doc"), name.alias("name")).select(
            "doc", text.token("cast_", F.col("name")).alias("label")
        )
        return self._label_svd(labels, self._components("cast", CAST_COMPONENTS))

    def _label_svd(self, labels: DataFrame, k: int):
        rows, vocab = tfidf.binary_labels(labels)
        n = vocab.count()
        return self._project(rows, n, svd.component_cap(k, n))

    def _project(self, rows: DataFrame, n_columns: int, k: int):
        out = svd.truncated_svd(rows, n_columns, k).projected
        return features.align(
            out.select(F.col("doc").alias("movie_idx"), "features"), self.index
        ) if n_columns else features.empty(self.items)
