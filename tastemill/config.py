"""Default parameters. Every operator takes them as plain arguments."""

from __future__ import annotations

from dataclasses import dataclass, field

# Thresholds of the activity filter and of the temporal split.
MIN_USER_RATINGS = 100
MIN_MOVIE_RATINGS = 200
MIN_RATINGS_PER_USER_SPLIT = 5
VAL_RATIO = 0.1
TEST_RATIO = 0.1

# Genre vocabulary of the multi-hot genre group.
GENRES = (
    "Action", "Adventure", "Animation", "Children", "Comedy", "Crime",
    "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror", "IMAX",
    "Musical", "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western",
)
NO_GENRES = "(no genres listed)"

# Metadata image location and list sizes.
IMAGE_BASE = "https://image.tmdb.org/t/p/"
IMAGE_SIZE = "w500"
TOP_CAST = 5
CAST_TOP_N = 3

# Rating scale, relevance threshold and evaluation cut-offs.
RATING_MIN = 0.5
RATING_MAX = 5.0
RELEVANCE_THRESHOLD = 4.0
KS = (5, 10, 20)

METRICS = ("cosine", "euclidean")
STRATEGIES = ("weighted", "mean_centering")
TOP_K = 100
N_RECOMMENDATIONS = 10
SEED = 42

NUMERICAL_FEATURES = ("runtime_min", "vote_average", "popularity")
TAGS_COMPONENTS = 100
OVERVIEW_COMPONENTS = 100
DIRECTOR_COMPONENTS = 50
CAST_COMPONENTS = 50


@dataclass(frozen=True)
class TfidfParams:
    max_features: int = 5000
    min_df: int = 2
    max_df: float = 0.95
    sublinear_tf: bool = True
    stop_words: tuple[str, ...] = field(default=())


# Size guards. A side is shipped to every task only below these sizes; beyond
# them the same operator switches to its blocked plan.
ITEM_BLOCK_BYTES = 64 * 1024 * 1024
# Scores that a task holds at once.
SLAB_BYTES = 16 * 1024 * 1024
SVD_BASIS_BYTES = 64 * 1024 * 1024

# A group with more rows than this is ranked by radix levels, not in one task.
HOT_GROUP_ROWS = 2_000_000
# Users with more ratings than this are spread over several tasks, whose partial profiles are added.
HOT_USER_ROWS = 500_000
HOT_USER_SALT = 16
