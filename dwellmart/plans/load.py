"""From the curated zone to the star schema."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmart.fixed_values import FACT_TIMES, UNIQUE_KEYS
from dwellmart.operators import dimensions as dims
from dwellmart.operators.contract import fact_rules, member_rules
from dwellmart.operators.facts import (
    SUMMED_KEYS,
    Dimension,
    fact_sums,
    listing_facts,
    macro_facts,
    met,
    unseen,
    unseen_or_later,
    with_dense_key,
    with_surrogate_key,
)
from dwellmart.operators.integrity import require_sound, require_unique
from dwellmart.operators.kinds import listings_of, macro_of, with_kind
from dwellmart.operators.rules import enforce, keep_valid, rejects
from dwellmart.plans.together import together
from dwellmart.session import drop_written, shuffle_files_dropped, written
from dwellmart.sources.landing import QUARANTINE, STRICT
from dwellmart.sources.warehouse import Warehouse


# Tables whose reports ask for a range of the first order column: it is to be found in few files.
CLUSTERED = {"fact_listings"}


@dataclass(frozen=True)
class LoadCounts:
    """Rows of the star and of the folder of rejects after a load, read back from what was written."""

    listings: int
    macro: int
    rejected: int
    rejected_folder: str


def refresh(
    warehouse: Warehouse,
    curated: DataFrame,
    mode: str = QUARANTINE,
    rejected: str | None = None,
    known_unique: bool = False,
    verify: bool = False,
    dense_ids: bool = False,
) -> LoadCounts:
    """Rebuild the star from the whole curated zone and publish it if every constraint holds.

    In quarantine mode, rows that cannot become facts are stored with their reasons, in ``rejected``
    or else beside the tables of the new star, once the facts are written and before they are
    published.

    Required values and foreign keys are enforced while the facts are written, so they cost no
    pass of their own. That a listing_id occurs once needs a shuffle of all ids; a caller who has
    just removed duplicates says so with ``known_unique``. ``verify`` checks what was written once
    more, constraint by constraint. ``dense_ids`` numbers the facts 1 to n, for which they are written
    and read once more; without it fact ids are unique but leave gaps.
    """
    with shuffle_files_dropped(warehouse.spark):
        if not known_unique:
            require_unique(curated, ["listing_id"])
        staged = warehouse.stage()
        try:
            counts = _load(staged, curated, mode, rejected, fresh=True, dense_ids=dense_ids)
            if verify:
                require_sound(staged)
        except Exception:
            staged.discard()
            raise
        warehouse.publish(staged)
    return counts


def append(
    warehouse: Warehouse,
    curated: DataFrame,
    mode: str = QUARANTINE,
    rejected: str | None = None,
    known_unique: bool = False,
    latest: bool = False,
    dense_ids: bool = False,
) -> LoadCounts:
    """Add what is not stored yet: new members first, then new facts, then new rejects.

    Tables that are absent are created. A stored listing keeps its row, unless ``latest`` asks for
    the later record: a record of a later time takes the place (and the surrogate key) of the stored
    one, and one that cannot become a fact removes it, as a full load of all records would. At equal
    times the stored one stays. Running the same batch again changes nothing, so a run that was
    cut off between two tables is completed by repeating it. ``dense_ids`` numbers the new facts without
    gaps behind the largest id in use.
    """
    with shuffle_files_dropped(warehouse.spark):
        if not known_unique:
            require_unique(curated, ["listing_id"])
        warehouse.prepare()
        return _load(warehouse, curated, mode, rejected, fresh=False, latest=latest, dense_ids=dense_ids)


def fact_rejects(curated: DataFrame) -> DataFrame:
    """Curated rows that cannot become facts, with the reasons."""
    return rejects(with_kind(curated), fact_rules())


def _load(
    target: Warehouse,
    curated: DataFrame,
    mode: str,
    rejected: str | None,
    fresh: bool,
    latest: bool = False,
    dense_ids: bool = False,
) -> LoadCounts:
    if mode not in (STRICT, QUARANTINE):
        raise ValueError(f"unknown mode {mode!r}")
    curated = with_kind(curated)
    if mode == STRICT:
        members = facts = enforce(curated, fact_rules(), "listing_id")
    else:
        members = keep_valid(curated, member_rules())
        facts = keep_valid(curated, fact_rules())
    members_of = {
        "dim_date": (None, dims.date_members(members)),
        "dim_location": ("location_id", dims.location_members(members)),
        "dim_property": ("property_id", dims.property_members(listings_of(members))),
        "dim_source": ("source_id", dims.source_members(members)),
    }
    steps = [
        partial(_add_members, target, table, found, id_column, fresh)
        for table, (id_column, found) in members_of.items()
    ]
    together(target.spark, *steps)

    together(
        target.spark,
        partial(_add_facts, target, "fact_listings", listings_of(facts), listing_facts,
                "listing_sk", ["location_id", "price"], fresh,
                listings_of(curated) if latest else None, dense_ids),
        partial(_add_facts, target, "fact_macro_indicators", macro_of(facts), macro_facts,
                "macro_sk", ["date_id", "location_id"], fresh,
                macro_of(curated) if latest else None, dense_ids),
    )
    folder = rejected or target.rejects_folder()
    if mode == QUARANTINE:
        _store_rejects(fact_rejects(curated), folder, fresh)
    return counts_of(target, folder)


def counts_of(target: Warehouse, rejected: str | None = None) -> LoadCounts:
    """The rows of the facts and of the rejects, as they are stored."""
    folder = rejected or target.rejects_folder()
    listings, macro = (target.table(t).count() for t in ("fact_listings", "fact_macro_indicators"))
    stored = _stored(target.spark, folder)
    return LoadCounts(listings, macro, 0 if stored is None else stored.count(), folder)


def _stored(spark: SparkSession, folder: str) -> DataFrame | None:
    """Rejects of earlier loads, None where there are none."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _store_rejects(refused: DataFrame, folder: str, fresh: bool) -> None:
    """Write the rejects; an append leaves out those stored with the same id, date and reasons."""
    earlier = None if fresh else _stored(refused.sparkSession, folder)
    if earlier is not None:
        keys = ["listing_id", "date_scraped", "reasons"]
        same = [refused[key].eqNullSafe(earlier[key]) for key in keys]
        refused = refused.join(earlier.select(keys), same, "left_anti")
    refused.write.mode("overwrite" if fresh else "append").parquet(folder)


def _add_members(
    target: Warehouse, table: str, found: DataFrame, id_column: str | None, fresh: bool
) -> None:
    keys = UNIQUE_KEYS[table]
    if not fresh:
        found = dims.new_members(found, target.table(table), keys)
    if id_column:
        last = 0 if fresh else target.largest(table, id_column)
        found = dims.number_members(found, keys, id_column, last)
    target.append(table, found)


def _add_facts(
    target: Warehouse,
    table: str,
    rows: DataFrame,
    facts_of: Callable[[DataFrame, Dimension], DataFrame],
    id_column: str,
    order: list[str],
    fresh: bool,
    batch: DataFrame | None = None,
    dense_ids: bool = False,
) -> None:
    """Append facts, laid out so that file statistics can rule out what a report doesn't need.

    What an append finds to be new is stored first, because the lookups may start from it more
    than once and should not repeat the comparison with the stored facts. A ``batch``, all records
    of the load whether they can become facts or not, outdates the stored facts of earlier times. What is
    stored on the way goes once the facts are written.
    """
    last, files, known, new = 0, [], None, None
    if not fresh:
        last = target.largest(table, id_column)
        natural_key, stored = UNIQUE_KEYS[table][0], target.table(table)
        if batch is None:
            rows = new = written(unseen(rows, stored, natural_key), "unseen")
        else:
            known = written(met(batch, stored, natural_key, FACT_TIMES[table], id_column), "met")
            replaced = known.where("_later")
            files = [row[0] for row in replaced.select("_file").distinct().collect()]
            new = written(unseen_or_later(rows, known, id_column), "unseen-or-later")
            rows, later = (new.where(F.col(id_column).isNull()).drop(id_column), new.where(F.col(id_column).isNotNull()))
    clustered = table in CLUSTERED
    numbered = with_dense_key if dense_ids else with_surrogate_key
    added = facts_of(rows, target.table)
    if dense_ids or not files:  # else they are laid out below, together with the others
        added = _laid_out(added, order, clustered)
    added = numbered(added, id_column, last)
    if files:
        # Copy on write: the files that hold an outdated fact are written anew, with the later records
        # and what is new; no other file is touched.
        kept = target.stored_files(table, files).join(
            replaced.select(F.col("listing_id").alias(natural_key)), natural_key, "left_anti"
        )
        updated = facts_of(later, target.table, kept=[id_column])
        everything = kept.unionByName(added).unionByName(updated)
        target.replace_files(table, files, _laid_out(everything, order, clustered))
    else:
        target.append(table, added)
    drop_written(known, new)
    if clustered:
        target.note_files(table, SUMMED_KEYS, fact_sums())


def _laid_out(facts: DataFrame, order: list[str], clustered: bool) -> DataFrame:
    """Facts ordered inside their files. Clustered ones are dealt over the files by ranges of all order
    columns, so that a value of the first one that many facts share is spread over several files."""
    dealt = facts.repartitionByRange(*order) if clustered else facts
    return dealt.sortWithinPartitions(*order)
