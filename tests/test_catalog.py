from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marquee import schemas
from marquee.operators import catalog
from marquee.plans import loading
from marquee.schemas import struct
from marquee.sources import files, normalise, tables

TITLES = '''id,title,type,description,release_year,age_certification,runtime,genres,production_countries,seasons,imdb_id,imdb_score,imdb_votes,tmdb_popularity,tmdb_score
t1,Long Road,MOVIE,"Dust, heat
and ""hope"".",2016,PG,95.7,"['drama', 'crime', 'noir']","['FR', 'US']",,x1,7.84,1,1,1
t2, The Reef ,SHOW,,2019.0,,44,"['family']",['XX'],3.0,x2,inf,1,1,1
t3,LONG road,MOVIE,Again,2016,R,99,[],[],,x3,,1,1,1
,No Id,MOVIE,,2016,,90,[],[],,x4,,1,1,1
t5,Untold,MOVIE,,,,0,,,,x5,5,1,1,1
t6,untold ,SHOW,,,,0,,,,x6,5,1,1,1
'''
LOOKUP = '''show_id,type,title,director,cast,country,date_added,release_year,rating,duration,listed_in,description
s1,Movie,LONG ROAD,,,,"July 15, 2022",2016,TV-14,1,x,x
s2,Movie,Long Road ,,,,"August 1, 2022",2016,TV-MA,1,x,x
s3,Movie,The Reef,,,,someday,2019,,1,x,x
s4,Movie,Untold,,,,"May 5, 2020",,TV-G,1,x,x
'''


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "titles.csv").write_text(TITLES)
    (tmp_path / "lookup.csv").write_text(LOOKUP)
    return tmp_path


def load(spark, folder):
    rows, rejects = files.read_titles(spark, f"{folder}/titles.csv")
    files.require_no_rejects(rejects)
    lookup = normalise.title_lookup(files.read_pack(spark, f"{folder}/lookup.csv", schemas.TITLE_LOOKUP_FILE))
    return normalise.normalise_titles(rows, "road"), lookup


def test_titles_are_normalised(spark, folder):
    items, lookup = load(spark, folder)
    got = {r.title: r for r in normalise.enrich_titles(items, lookup).collect()}
    assert "No Id" not in got
    road, reef = got["Long Road"], got["The Reef"]
    assert (road.type, road.release_year, road.runtime_minutes, road.season_count) == ("movie", 2016, 95, None)
    assert road.description == 'Dust, heat\nand "hope".'
    assert (road.genre_primary, road.genre_secondary) == ("drama", "crime")
    assert (road.country, road.original_language, road.imdb_score) == ("FR", "fr", Decimal("7.8"))
    assert (road.date_added, road.content_rating) == (date(2022, 8, 1), "TV-MA")  # the later lookup row
    assert (reef.type, reef.runtime_minutes, reef.season_count, reef.release_year) == ("series", None, 3, 2019)
    assert (reef.country, reef.original_language, reef.imdb_score) == ("XX", None, None)
    assert (reef.date_added, reef.content_rating, reef.genre_secondary) == (None, None, None)
    assert got["Untold"].content_rating == "TV-G"  # no year on either side


def test_duplicates_keep_the_first_in_file_order(spark, folder):
    items, _ = load(spark, folder)
    none = spark.createDataFrame([], "title string, release_year int")
    fresh = catalog.new_items(items, none)
    assert {(r.title, r.release_year) for r in fresh.collect()} == {("Long Road", 2016), ("The Reef", 2019), ("Untold", None)}
    assert fresh.filter("title = 'Untold'").first().type == "movie"
    known = spark.createDataFrame([(" the reef", 2019), ("UNTOLD", None), ("Long Road", 2017)], none.schema)
    assert [r.title for r in catalog.new_items(items, known).collect()] == ["Long Road"]
    assert tuple(catalog.load_counts(items, catalog.new_items(items, known)).first()) == (1, 4)


def test_wrong_field_counts_are_rejected_by_name(spark, tmp_path):
    lines = TITLES.splitlines(keepends=True)
    (tmp_path / "titles.csv").write_text(lines[0] + "t7,Short,MOVIE\n" + "t8," + "x," * 20 + "\n" + lines[-1])
    rows, rejects = files.read_titles(spark, f"{tmp_path}/titles.csv")
    assert [r.id for r in rows.collect()] == ["t6"]
    assert sorted(r.id for r in rejects.collect()) == ["t7", "t8"]
    with pytest.raises(ValueError, match="Short"):
        files.require_no_rejects(rejects)


def test_native_movies(spark):
    names = schemas.MOVIES_FILE.names
    def row(**cells):
        return tuple(cells.get(name) for name in names) + (cells["movie_id"],)
    df = spark.createDataFrame([
        row(movie_id="1", title=" A ", content_type="Stand-up Comedy", duration_minutes="47.0", language="Japanese",
            country_of_origin="South Korea", added_to_platform="2023-08-07", is_netflix_original="True", rating=" "),
        row(movie_id="2", title="B", content_type="Movie", number_of_episodes="8.0", duration_minutes="47.0",
            language="Latin", country_of_origin="Peru", added_to_platform="07.08.2023"),
        row(movie_id="3", title="  "),
    ], schemas.struct(", ".join(f"{name} string" for name in [*names, files.ORDER])))
    got = {r.title: r for r in normalise.normalise_movies(df, "native").collect()}
    assert set(got) == {"A", "B"}
    a, b = got["A"], got["B"]
    assert (a.type, a.runtime_minutes, a.country, a.original_language) == ("movie", 47, "KR", "ja")
    assert (a.is_netflix_original, a.content_warning, a.content_rating, a.date_added) == (True, False, None, date(2023, 8, 7))
    assert (b.type, b.runtime_minutes, b.episode_count, b.season_count) == ("series", None, 8, None)
    assert (b.country, b.original_language, b.date_added) == (None, None, None)


def test_users_dat(spark, tmp_path):
    (tmp_path / "users.dat").write_text("1::F::1::10::48067\n\n702::M::56::99::70072\nbad::M::x\nx::?::abc::0::1\n")
    users = files.read_users_dat(spark, f"{tmp_path}/users.dat")
    got = {r.signup_date: r for r in normalise.normalise_ml_users(users, "ml").collect()}
    assert len(got) == 3
    first, wrapped, odd = got[date(2023, 1, 2)], got[date(2023, 1, 3)], got[date(2023, 1, 1)]
    assert (first.gender, first.age, first.occupation, first.subscription_plan) == ("female", 1, "K-12 student", "standard")
    assert (wrapped.gender, wrapped.occupation, wrapped.subscription_plan) == ("male", "other", "basic")
    assert (odd.gender, odd.age, odd.occupation, odd.country) == ("unknown", None, "other", "US")


def test_native_users(spark, tmp_path):
    (tmp_path / "users.csv").write_text(
        ",".join(schemas.USERS_FILE.names) + "\n"
        "u_1, a@x.org ,Ann,Lee,63.0,,USA,Ohio,Troy,Premium+,2022-10-07,True,27.745,Desktop,1,x\n"
        "u_2,,,,109.0,Prefer not to say,France,,,gold,never,no,,,,\n"
    )
    rows = files.read_pack(spark, f"{tmp_path}/users.csv", schemas.USERS_FILE)
    users = normalise.normalise_users(rows, "native")
    numbered = catalog.assign_ids(users, "user_id", "u", 41, [files.ORDER])
    one, two = numbered.orderBy("user_id").collect()
    assert (one.user_id, one.age, one.gender, one.country, one.preferred_language) == ("u42", 63, None, "US", "en")
    assert (one.subscription_plan, one.account_status, one.email) == ("premium_plus", "active", "a@x.org")
    assert (one.signup_date, one.monthly_spend_hours) == (date(2022, 10, 7), Decimal("27.75"))
    assert (two.user_id, two.age, two.gender, two.country) == ("u43", None, "unknown", "FR")
    assert (two.subscription_plan, two.account_status, two.signup_date, two.email) == ("basic", "cancelled", None, None)


def test_ids_are_dense_and_in_order_over_many_partitions(spark):
    df = spark.range(5000).repartition(7).withColumn("rank", F.expr("id * 7919 % 5003"))
    got = catalog.assign_ids(df, "item_id", "i", 100, ["rank"]).collect()
    ordered = [r.item_id for r in sorted(got, key=lambda r: r["rank"])]
    assert ordered == [f"i{n}" for n in range(101, 5101)]


def test_counter_never_goes_back(spark):
    items = spark.createDataFrame([("i3",), ("i12",), ("ix",)], "item_id string")
    counter = spark.createDataFrame([("u", 7)], "prefix string, next_n bigint")
    assert catalog.counter_start(counter, items, "item_id", "i") == 12
    counter = catalog.advance_counter(counter, "i", 15)
    assert catalog.counter_start(counter, items.limit(0), "item_id", "i") == 15
    assert catalog.counter_start(counter, items, "user_id", "u") == 7


def test_vocabulary_and_load_log(spark):
    known = spark.createDataFrame([("a",)], "name string")
    used = spark.createDataFrame([("a", "b"), (None, "c"), ("b", None)], "x string, y string")
    added = catalog.sync_vocab(known, "name", used.select("x"), used.select("y"))
    assert sorted(r.name for r in added.collect()) == ["b", "c"]

    at = datetime(2024, 1, 1)
    log = spark.createDataFrame([], schemas.LOAD_LOG)
    log = catalog.record_load(log, catalog.load_key("pack"), 3, 4, at)
    log = catalog.record_load(log, catalog.load_key("pack", "items"), 3, 0, at)
    with pytest.raises(catalog.AlreadyLoaded):
        catalog.record_load(log, "pack", 3, 4, at)
    log = catalog.record_load(log, "pack", 0, 4, datetime(2024, 2, 1), force=True)
    history = {r.seed_name: (r["count"], r.last_loaded_at) for r in catalog.load_history(log).collect()}
    assert history == {"pack": (2, datetime(2024, 2, 1)), "pack:items": (1, at)}


def test_pack_previews(spark, folder):
    rows, _ = files.read_titles(spark, f"{folder}/titles.csv")
    assert tuple(catalog.title_pack_counts(rows).first()) == (5, 4, 0)
    users = spark.createDataFrame([("u1",), (" ",), (None,)], "user_id string")
    assert tuple(catalog.movie_pack_counts(None, users).first()) == (0, 0, 1)
    movies = spark.createDataFrame([("A", "Drama", "drama "), ("", "Noir", None)], "title string, genre_primary string, genre_secondary string")
    assert tuple(catalog.movie_pack_counts(movies).first()) == (1, 2, 0)


def test_loading_and_unloading_packs(spark, folder):
    vocabulary = spark.createDataFrame([("drama",)], "code string")
    empty = loading.Catalogue(
        items=spark.createDataFrame([], schemas.ITEMS), users=spark.createDataFrame([], schemas.USERS),
        counter=spark.createDataFrame([], "prefix string, next_n bigint"), log=spark.createDataFrame([], schemas.LOAD_LOG),
        genres=vocabulary, countries=vocabulary.limit(0), languages=vocabulary.limit(0),
    )
    rows, lookup = load(spark, folder)
    (folder / "users.dat").write_text("1::F::1::10::48067\n2::M::25::3::1\n")
    people = normalise.normalise_ml_users(files.read_users_dat(spark, f"{folder}/users.dat"), "road")
    at = datetime(2024, 1, 1)
    full, brought = loading.load(empty, "road", at, rows, people, lookup)
    assert brought == loading.Loaded(items=3, skipped=2, users=2, genres=2)
    assert {r.item_id: r.title for r in full.items.collect()} == {"i1": "Long Road", "i2": "The Reef", "i3": "Untold"}
    assert sorted(r.user_id for r in full.users.collect()) == ["u1", "u2"]
    assert sorted(r.code for r in full.countries.collect()) == ["FR", "US", "XX"]
    with pytest.raises(catalog.AlreadyLoaded):
        loading.load(full, "road", at, rows)

    again, brought = loading.load(full, "road", at, rows, people, mode="users")
    assert (brought.items, brought.users) == (0, 2)
    forced, brought = loading.load(again, "road", at, rows, force=True)
    assert (brought.items, brought.skipped) == (0, 5)

    bare = loading.unload(forced, "road")
    assert bare.items.isEmpty() and bare.users.isEmpty() and bare.log.isEmpty()
    other = normalise.normalise_titles(rows_of(spark, folder), "other")
    reloaded, _ = loading.load(bare, "other", at, other)
    assert sorted(r.item_id for r in reloaded.items.collect()) == ["i4", "i5", "i6"]  # ids are not reused

    cleared = loading.delete_genres(reloaded, ["drama"])
    assert cleared.items.filter("genre_primary = 'drama' OR genre_secondary = 'drama'").isEmpty()
    assert "drama" not in [r.code for r in cleared.genres.collect()]
    assert loading.delete_countries(full, ["US"]).users.filter("country IS NOT NULL").isEmpty()
    assert loading.delete_languages(full, ["fr"]).items.filter("original_language = 'fr'").isEmpty()


def rows_of(spark, folder):
    return files.read_titles(spark, f"{folder}/titles.csv")[0]


def _pack(spark, *titles):
    rows = [(t, 2000, "movie", "drama", "US", n) for n, t in enumerate(titles)]
    return spark.createDataFrame(rows, f"title string, release_year int, type string, genre_primary string, country string, {files.ORDER} long")


def _stored(spark, root):
    after = loading.read_catalogue(spark, root)
    ids = {r.title: r.item_id for r in after.items.collect()}
    return ids, {r.prefix: r.next_n for r in after.counter.collect()}, sorted(r.seed_name for r in after.log.collect()), sorted(r.name for r in after.genres.collect())


def test_a_stored_load_commits_all_tables_or_nothing(spark, tmp_path, monkeypatch):
    root, at = f"{tmp_path}/catalogue", datetime(2024, 1, 1)
    brought = loading.load_stored(spark, root, "one", at, _pack(spark, "a", "b"))
    assert (brought.items, brought.genres) == (2, 1)
    first = ({"a": "i1", "b": "i2"}, {"i": 2}, ["one"], ["drama"])
    assert _stored(spark, root) == first

    def fail(*args):
        raise OSError("no space")

    with monkeypatch.context() as broken:  # all tables are written, the ledger entry is not
        broken.setattr(tables, "_create", fail)
        with pytest.raises(OSError):
            loading.load_stored(spark, root, "two", at, _pack(spark, "b", "c"))
    assert _stored(spark, root) == first
    with monkeypatch.context() as broken:  # it fails between two tables
        one = spark.createDataFrame([("x", 1, 1, at)], schemas.LOAD_LOG)
        broken.setattr(catalog, "record_load", lambda *_, **__: one.withColumn("seed_name", F.raise_error(F.lit("broken")).cast("string")))
        with pytest.raises(Exception, match="broken"):
            loading.load_stored(spark, root, "two", at, _pack(spark, "b", "c"))
    assert _stored(spark, root) == first
    loading.load_stored(spark, root, "two", at, _pack(spark, "b", "c"))
    second = ({"a": "i1", "b": "i2", "c": "i3"}, {"i": 3}, ["one", "two"], ["drama"])
    assert _stored(spark, root) == second
    with pytest.raises(catalog.AlreadyLoaded):
        loading.load_stored(spark, root, "two", at, _pack(spark, "d"))
    loading.load_stored(spark, root, "two", at, _pack(spark, "d"), mode="items")
    assert _stored(spark, root)[1:3] == ({"i": 4}, ["one", "two", "two:items"])

    # unloading keeps the counter: no id is used again
    loading.store(root, loading.unload(loading.read_catalogue(spark, root), "none"))
    loading.store(root, loading.delete_genres(loading.read_catalogue(spark, root), ["drama"]))
    assert _stored(spark, root)[1:] == ({"i": 4}, ["one", "two", "two:items"], [])


def test_a_stored_load_refuses_rejected_rows_and_loses_no_race(spark, tmp_path, monkeypatch):
    root, at = f"{tmp_path}/catalogue", datetime(2024, 1, 1)
    (tmp_path / "titles.csv").write_text("id,title\n1,a\n2,b,too,many\n")
    _, rejects = files.read_titles(spark, f"{tmp_path}/titles.csv", struct("id string, title string"))
    with pytest.raises(ValueError, match="too,many"):
        loading.load_stored(spark, root, "one", at, _pack(spark, "a"), rejects=rejects)
    assert tables.current_version(spark, root) is None

    create = tables._create

    def late(*args):
        monkeypatch.setattr(tables, "_create", create)
        loading.load_stored(spark, root, "fast", at, _pack(spark, "a", "x"))
        return create(*args)

    monkeypatch.setattr(tables, "_create", late)
    with pytest.raises(tables.Conflict):
        loading.load_stored(spark, root, "slow", at, _pack(spark, "a", "y"), rejects=rejects.limit(0))
    loading.load_stored(spark, root, "slow", at, _pack(spark, "a", "y"))
    assert _stored(spark, root)[:3] == ({"a": "i1", "x": "i2", "y": "i3"}, {"i": 3}, ["fast", "slow"])
