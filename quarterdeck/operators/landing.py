"""A landing zone against the listing of its source, as jobs on tables of names."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import columns_of, last_segment
from quarterdeck.operators.gaps import with_previous

# How a listing page writes a link, and the statuses of a landed name.
LINK_PATTERN = r'(?i)href="([^"]+)"'
NEW, PRESENT, UNPUBLISHED = "new", "present", "unpublished"


class EmptyListing(RuntimeError):
    """The source listing has no files, which means that fetching or parsing it broke."""


class FailedItems(RuntimeError):
    """Some items failed. ``failures`` is the frame of all of them."""

    def __init__(self, message: str, failures: DataFrame) -> None:
        super().__init__(message)
        self.failures = failures


def listing_links(
    pages: DataFrame, html: str = "html", keys: str | Sequence[str] = "page_id"
) -> DataFrame:
    """The file links of listing pages: (keys, position, filename, link).

    Links to folders (trailing slash) and to sort orders (leading question mark) are
    skipped. Repeated links stay; ``position`` is the link's place among all links of its
    page, starting at 0.
    """
    names = columns_of(keys)
    found = F.regexp_extract_all(F.col(html), F.lit(LINK_PATTERN), F.lit(1))
    return (
        pages.select(*names, F.posexplode(found).alias("position", "link"))
        .where(~F.col("link").endswith("/") & ~F.col("link").startswith("?"))
        .select(*names, "position", last_segment("link").alias("filename"), "link")
        .where(F.col("filename") != "")
    )


def require_listing(listing: DataFrame) -> DataFrame:
    """Pass the listing on, or raise when it is empty: reconciling against it would report
    every landed file as retired."""
    if listing.isEmpty():
        raise EmptyListing("no file links in the source listing; nothing was reconciled")
    return listing


def reconcile(
    listing: DataFrame, landed: DataFrame, retain: bool = True, name: str = "filename"
) -> DataFrame:
    """One row per name known to either side, with its status and the action to take.

    Everything that is listed is fetched again, new or not. What is no longer listed is
    kept, or marked for deletion under ``retain=False``; nothing is deleted here. The two
    sides meet in one aggregation, so repeated names collapse before the shuffle.
    """
    sides = listing.select(
        name, F.lit(True).alias("listed"), F.lit(False).alias("held")
    ).unionAll(landed.select(name, F.lit(False).alias("listed"), F.lit(True).alias("held")))
    return reconcile_sides(sides, retain, name)


def reconcile_sides(sides: DataFrame, retain: bool = True, name: str = "filename") -> DataFrame:
    """As `reconcile`, for one frame of names with the flags ``listed`` and ``held``, so that names
    found in one pass need not be found again for each side. Null names are no names."""
    status = (
        F.when(~F.col("held"), F.lit(NEW))
        .when(F.col("listed"), F.lit(PRESENT))
        .otherwise(F.lit(UNPUBLISHED))
    )
    action = F.when(F.col("listed"), F.lit("fetch")).otherwise(
        F.lit("retain" if retain else "delete")
    )
    return (
        sides.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.bool_or("listed").alias("listed"), F.bool_or("held").alias("held"))
        .select(name, status.alias("status"), action.alias("action"))
    )


def unpublished(
    listing: DataFrame, landed: DataFrame, name: str = "filename", ordered: bool = False
) -> DataFrame:
    """Names that are landed but no longer listed, each once; ``ordered`` sorts them."""
    listed = listing.select(name).distinct()
    gone = landed.where(F.col(name).isNotNull()).select(name).distinct().join(listed, name, "left_anti")
    return gone.orderBy(name) if ordered else gone


def landing_summary(reconciled: DataFrame) -> DataFrame:
    """Number of names per status and action."""
    return reconciled.groupBy("status", "action").agg(F.count(F.lit(1)).alias("files"))


def run_summary(outcomes: DataFrame, reconciled: DataFrame, failed: str = "failed") -> DataFrame:
    """One row for a whole run: files fetched, failed, no longer published and marked for
    deletion. ``outcomes`` has one row per attempted file; an unknown outcome is a failure."""
    tried = outcomes.select(
        F.coalesce(F.col(failed), F.lit(True)).alias("bad"), F.lit(None).cast("string").alias("status"), F.lit("").alias("action")
    )
    known = reconciled.select(F.lit(None).cast("boolean").alias("bad"), "status", "action")
    return tried.unionAll(known).agg(
        F.count_if(~F.col("bad")).alias("downloaded"),
        F.count_if("bad").alias("failed"),
        F.count_if(F.col("status") == UNPUBLISHED).alias("unpublished"),
        F.count_if(F.col("action") == "delete").alias("deleted"),
    )


def raise_on_failures(
    outcomes: DataFrame,
    name: str = "filename",
    failed: str = "failed",
    publish: Callable[[DataFrame], str] | None = None,
) -> None:
    """Raise if any attempted item failed or has no known outcome. Call it after every item was
    tried. ``publish`` stores the frame of all failures and says where; the message has the count
    and that place, the error the frame."""
    failures = outcomes.where(F.coalesce(F.col(failed), F.lit(True))).select(name)
    count = failures.count()
    if count:
        where = f"; all are listed in {publish(failures)}" if publish else ""
        raise FailedItems(f"{count} item(s) failed{where}", failures)


def manifest(
    sightings: DataFrame, names: str | Sequence[str] = "filename", day: str = "seen_on"
) -> DataFrame:
    """When each name was first and last seen, and the day it counts as retired: the first
    run after the last sighting, null while the name is still there.

    ``day`` is a date. The calendar of runs is the distinct days over all sightings; the date
    type has fewer than four million values, so it is broadcast whatever the sightings hold.
    Most names share one last day, and would otherwise meet in the same task.
    """
    if not isinstance(sightings.schema[day].dataType, T.DateType):
        raise TypeError(f"{day} has to be a date")
    keys = columns_of(names)
    seen = sightings.groupBy(*keys).agg(
        F.min(day).alias("first_seen"), F.max(day).alias("last_seen")
    )
    runs = with_previous(sightings.select(day).distinct(), day).select(
        F.col(f"previous.{day}").alias("last_seen"), F.col(day).alias("retired_on")
    )
    followed = F.broadcast(runs.where(F.col("last_seen").isNotNull()))
    return seen.join(followed, "last_seen", "left").select(
        *keys, "first_seen", "last_seen", "retired_on"
    )


def merge_manifest(
    stored: DataFrame, listing: DataFrame, day: date, runs: DataFrame, names: str | Sequence[str] = "filename"
) -> DataFrame:
    """The manifest after one more day's listing, out of the stored one (as `manifest` gives it) and
    that listing alone: earlier sightings are not read again.

    Days may come in any order, and a name that was retired may reappear. ``runs`` has the days that
    were merged so far in a date column ``day``; a name last seen on ``day`` counts as retired from the
    first of them after it. Names meet in one aggregation, repeats collapse before the shuffle.
    """
    keys = columns_of(names)
    today = F.lit(day)
    after = runs.where(F.col("day") > today).agg(F.min("day")).scalar()
    seen = listing.select(
        *keys, today.alias("first_seen"), today.alias("last_seen"), F.lit(None).cast("date").alias("retired_on"), F.lit(True).alias("__today")
    )
    both = stored.select(*keys, "first_seen", "last_seen", "retired_on", F.lit(False).alias("__today")).unionAll(seen)
    old_last = F.max(F.when(~F.col("__today"), F.col("last_seen")))
    merged = both.groupBy(*keys).agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.max("retired_on").alias("__retired"),
        old_last.alias("__old_last"),
        F.bool_or("__today").alias("__seen"),
    )
    new_last = F.col("__old_last").isNull() | (F.col("__old_last") < today)
    missing_now = (F.col("last_seen") < today) & ~F.col("__seen")
    retired = (
        F.when(F.col("__seen") & new_last, after)
        .when(missing_now, F.least("__retired", today))  # least passes over a null
        .otherwise(F.col("__retired"))
    )
    return merged.select(*keys, "first_seen", "last_seen", retired.alias("retired_on"))


def latest_snapshot(df: DataFrame, snapshot: str = "ingest_date") -> DataFrame:
    """The rows of the newest snapshot. The maximum is a scalar subquery: on a layout
    partitioned by ``snapshot`` it prunes the partitions before any of them is read."""
    return df.where(F.col(snapshot) == df.agg(F.max(snapshot)).scalar())
