"""Loading and unloading catalogue packs.

``load`` and the others work on tables in memory; ``load_stored`` and ``store``
keep a catalogue under a root, where one ledger entry makes all its tables
current together: items, users, id counter, vocabularies and load log.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas
from marquee.operators import catalog, changes
from marquee.sources import tables
from marquee.sources.files import ORDER, require_no_rejects
from marquee.sources.normalise import enrich_titles


@dataclass(frozen=True)
class Catalogue:
    """The catalogue tables. Loading returns a new one and changes nothing in place."""

    items: DataFrame
    users: DataFrame
    counter: DataFrame
    log: DataFrame
    genres: DataFrame
    countries: DataFrame
    languages: DataFrame


@dataclass(frozen=True)
class Loaded:
    """What a load brought."""

    items: int = 0
    skipped: int = 0
    users: int = 0
    genres: int = 0


def _number(catalogue: Catalogue, table: DataFrame, rows: DataFrame, column: str, prefix: str, at: datetime):
    """``(added rows as the table has them, counter, how many)``; ids continue from the counter."""
    start = catalog.counter_start(catalogue.counter, table, column, prefix)
    stamped = catalog.assign_ids(rows, column, prefix, start, [ORDER]).drop(ORDER).withColumns(
        {"created_at": F.lit(at), "updated_at": F.lit(at)}
    )
    added = stamped.count()
    counter = catalog.advance_counter(catalogue.counter, prefix, start + added)
    return table.limit(0).unionByName(stamped, allowMissingColumns=True), counter, added


def _additions(
    catalogue: Catalogue, source: str, at: datetime, items: DataFrame | None, users: DataFrame | None, lookup: DataFrame | None,
    mode: str, force: bool,
) -> tuple[dict[str, DataFrame], Loaded]:
    """The rows that a load adds to each table, and the new counter."""
    key = catalog.load_key(source, mode)
    if not force and catalog.already_loaded(catalogue.log, key):
        raise catalog.AlreadyLoaded(f"{key} was loaded before")

    added: dict[str, DataFrame] = {}
    counter, added_items, skipped, added_users = catalogue.counter, 0, 0, 0
    if items is not None and mode != "users":
        fresh = catalog.new_items(items, catalogue.items)
        if lookup is not None:
            fresh = enrich_titles(fresh, lookup)
        added["items"], counter, added_items = _number(catalogue, catalogue.items, fresh, "item_id", "i", at)
        skipped = items.count() - added_items
    if users is not None and mode != "items":
        numbered = replace(catalogue, counter=counter)
        added["users"], counter, added_users = _number(numbered, catalogue.users, users, "user_id", "u", at)

    def used(table: str, *columns: str) -> list[DataFrame]:
        whole = getattr(catalogue, table)
        rows = whole.unionByName(added[table], allowMissingColumns=True) if table in added else whole
        return [rows.select(column) for column in columns]

    vocabularies = {
        "genres": used("items", "genre_primary", "genre_secondary"),
        "countries": [*used("items", "country"), *used("users", "country")],
        "languages": [*used("items", "original_language"), *used("users", "preferred_language")],
    }
    for name, values in vocabularies.items():
        known = getattr(catalogue, name)
        added[name] = known.limit(0).unionByName(catalog.sync_vocab(known, known.columns[0], *values), allowMissingColumns=True)
    added["log"] = catalog.record_load(catalogue.log.limit(0), key, added_items, added_users, at, force=True)
    added["counter"] = counter
    return added, Loaded(added_items, skipped, added_users, added["genres"].count())


def load(
    catalogue: Catalogue,
    source: str,
    at: datetime,
    items: DataFrame | None = None,
    users: DataFrame | None = None,
    lookup: DataFrame | None = None,
    mode: str = "full",
    force: bool = False,
) -> tuple[Catalogue, Loaded]:
    """Load normalised rows of one source and log it.

    ``mode`` is full, items or users. Items already in the catalogue are
    skipped, users are not compared. A source that was loaded before in the
    same mode raises ``AlreadyLoaded`` unless forced.
    """
    added, brought = _additions(catalogue, source, at, items, users, lookup, mode, force)
    after = {
        name: getattr(catalogue, name).unionByName(rows, allowMissingColumns=True) for name, rows in added.items() if name != "counter"}
    return replace(catalogue, counter=added["counter"], **after), brought


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


STORED = {
    "items": _nullable(schemas.ITEMS), "users": _nullable(schemas.USERS), "counter": schemas.struct("prefix string, next_n long"),
    "log": schemas.LOAD_LOG, "genres": schemas.struct("name string"), "countries": schemas.struct("code string"),
    "languages": schemas.struct("code string"),
}


def read_catalogue(spark: SparkSession, root: str, known: dict | None = None) -> Catalogue:
    """The stored catalogue, all tables of one version; empty tables before the first load."""
    known = known or tables.ledger(spark, root)
    found = {name: tables.latest(spark, root, name=name, known=known) for name in STORED}
    return Catalogue(**{name: spark.createDataFrame([], STORED[name]) if df is None else df for name, df in found.items()})


def _commit(spark: SparkSession, root: str, known: dict, changed: dict[str, DataFrame | tables.Added]) -> None:
    """Publish on top of ``known``; a ``Conflict`` if another load was faster."""
    if tables.ledger(spark, root)["version"] != known["version"]:
        raise tables.Conflict(f"{root} has changed")
    tables.publish_all(spark, changed, root, known["version"] + 1)


def store(root: str, catalogue: Catalogue) -> None:
    """Replace the stored catalogue, such as after ``unload`` or a vocabulary's delete."""
    spark = catalogue.items.sparkSession
    whole = {f.name: getattr(catalogue, f.name) for f in fields(Catalogue)}
    _commit(spark, root, tables.ledger(spark, root), whole)


def load_stored(
    spark: SparkSession,
    root: str,
    source: str,
    at: datetime,
    items: DataFrame | None = None,
    users: DataFrame | None = None,
    lookup: DataFrame | None = None,
    rejects: DataFrame | None = None,
    mode: str = "full",
    force: bool = False,
) -> Loaded:
    """``load`` into the stored catalogue: all of it becomes current at once, or nothing.

    ``rejects`` of a strict file, if there are any, raise an error that names them
    before anything is written. Only added rows are written. A load that another
    one has overtaken raises ``Conflict``; run again, it skips what the other
    brought and takes the next ids.
    """
    if rejects is not None:
        require_no_rejects(rejects)
    known = tables.ledger(spark, root)
    added, brought = _additions(read_catalogue(spark, root, known), source, at, items, users, lookup, mode, force)
    changed = {name: rows if name == "counter" else tables.Added(rows) for name, rows in added.items()}
    _commit(spark, root, known, changed)
    return brought


def unload(catalogue: Catalogue, source: str) -> Catalogue:
    """Remove the rows of one source and forget its loads."""
    return replace(
        catalogue,
        items=changes.unload_source(catalogue.items, source),
        users=changes.unload_source(catalogue.users, source),
        log=changes.forget_source(catalogue.log, source),
    )


def delete_genres(catalogue: Catalogue, names: Sequence[str]) -> Catalogue:
    """Delete genres and clear them from the items that use them."""
    return replace(
        catalogue,
        items=changes.clear_values(catalogue.items, ["genre_primary", "genre_secondary"], names),
        genres=changes.delete_vocabulary(catalogue.genres, catalogue.genres.columns[0], names),
    )


def delete_countries(catalogue: Catalogue, codes: Sequence[str]) -> Catalogue:
    return replace(
        catalogue,
        items=changes.clear_values(catalogue.items, ["country"], codes),
        users=changes.clear_values(catalogue.users, ["country"], codes),
        countries=changes.delete_vocabulary(catalogue.countries, catalogue.countries.columns[0], codes),
    )


def delete_languages(catalogue: Catalogue, codes: Sequence[str]) -> Catalogue:
    return replace(
        catalogue,
        items=changes.clear_values(catalogue.items, ["original_language"], codes),
        users=changes.clear_values(catalogue.users, ["preferred_language"], codes),
        languages=changes.delete_vocabulary(catalogue.languages, catalogue.languages.columns[0], codes),
    )
