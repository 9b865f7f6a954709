"""Bronze to silver."""

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from silverloom.operators.dedup import dedup_counts, dedup_keep_first, with_key
from silverloom.operators.messages import FIELDS, silver_from_bronze, silver_from_messages
from silverloom.operators.seen import SeenKeys
from silverloom.sources.jsonl import ORDER


class SilverResult(NamedTuple):
    """Silver records, rejected bronze records, and one row of counts; each is evaluated only when used."""

    silver: DataFrame
    quarantine: DataFrame
    counts: DataFrame


def silver_job(
    bronze: DataFrame,
    order: str | Sequence[str] = ORDER,
    dedup: bool = True,
    existing: DataFrame | SeenKeys | None = None,
    settle: Callable[[DataFrame], DataFrame] | None = None,
) -> SilverResult:
    """Validate, clean and deduplicate.

    ``bronze`` holds bronze columns, or JSON lines in ``value``. ``existing`` is the silver written so far, or the
    index of its keys, of which only the buckets that the new rows fall into are read: its keys are not written again. Without ``dedup`` every valid record is kept.
    ``settle`` writes a table and reads it back: lines are then parsed and cleaned once for all that the result is used for.
    """
    checked = silver_from_messages(bronze, settle=settle) if "value" in bronze.columns else silver_from_bronze(bronze)
    if isinstance(existing, SeenKeys):
        existing = existing.near(with_key(checked.good))
    counts = dedup_counts(checked.good, existing)
    if dedup:
        silver = dedup_keep_first(checked.good, order, existing, keep=FIELDS)
    else:
        silver = checked.good.select(*FIELDS)
    return SilverResult(silver, checked.quarantine, counts)
