"""Labelled dataset as reviews."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.constants import SEED
from silverloom.operators.messages import reviews_from_raw
from silverloom.operators.sampling import first_rows, with_position


def resolve_cap(limit: int | None, configured: int | None = None) -> int | None:
    """The number of rows to read: the argument, else the configured cap, else all. Zero counts as not given."""
    return limit or configured or None


def load_reviews(
    df: DataFrame,
    split: str,
    key: str,
    limit: int | None = None,
    shuffle: bool = True,
    seed: int = SEED,
    configured_cap: int | None = None,
) -> DataFrame:
    """Rows of ``df`` (``text``, ``label``) as reviews whose id is the position after the optional seeded shuffle.

    ``key`` identifies a row; without shuffle it must be numeric and gives the dataset order.
    """
    seed_or_none = seed if shuffle else None
    cap = resolve_cap(limit, configured_cap)
    rows = df.select(F.col(key), "text", "label")
    if cap is not None:
        rows = first_rows(rows, cap, key, seed_or_none)
    return reviews_from_raw(with_position(rows, key, seed_or_none, "position"), split, index="position")
