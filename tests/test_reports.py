import pytest
from pyspark.sql import functions as F

from data import NOW, ago, by_key, items, ratings, users, watches
from marquee.plans import reports


def test_user_average_and_deleted_items(spark):
    rated = ratings(spark, ("u1", "i1", 4, NOW), ("u1", "i2", 2, NOW))
    people = users(spark, ("u1",))
    row = by_key(reports.rating_avg(rated, items(spark, ("i1",), ("i2",)), people, "user_id"), "user_id")["u1"]
    assert row.avg_rating == pytest.approx(3.0) and row.rating_count == 2
    assert reports.rating_avg(rated, items(spark, ("i9",)), people, "user_id").isEmpty()
    assert reports.rating_avg(rated, items(spark, ("i1",)), users(spark, ("u9",)), "user_id").isEmpty()


def test_item_average(spark):
    rated = ratings(spark, ("u1", "i1", 5, NOW), ("u2", "i1", 3, NOW), ("u9", "i1", 1, NOW))
    got = reports.rating_avg(rated, items(spark, ("i1",)), users(spark, ("u1",), ("u2",)), "item_id")
    row = by_key(got, "item_id")["i1"]
    assert row.avg_rating == pytest.approx(4.0) and row.rating_count == 2


def test_view_ranking_uses_the_window_and_counts(spark):
    watched = watches(
        spark,
        ("u1", "hit", 100, "mobile", NOW), ("u2", "hit", 100, "mobile", NOW),
        ("u3", "calm", 100, "mobile", NOW), ("u1", "old", 100, "mobile", ago(minutes=5)),
        ("u9", "calm", 100, "mobile", NOW), ("u8", "calm", 100, "mobile", NOW),
    )
    got = reports.view_ranking(
        watched, items(spark, ("hit",), ("calm",), ("old",)), users(spark, ("u1",), ("u2",), ("u3",)),
        F.lit(NOW), minutes=1,
    )
    assert [(r.rank, r.item_id, r.view_count) for r in got.orderBy("rank").collect()] == [
        (1, "hit", 2), (2, "calm", 1),
    ]


def test_view_ranking_keeps_the_exact_window_start_and_the_future(spark):
    watched = watches(
        spark, ("u1", "i1", 1, "mobile", ago(minutes=10)), ("u1", "i2", 1, "mobile", ago(minutes=10, seconds=1)),
        ("u1", "i3", 1, "mobile", ago(minutes=-60)),
    )
    got = reports.view_ranking(watched, items(spark, ("i1",), ("i2",), ("i3",)), users(spark, ("u1",)), F.lit(NOW))
    assert {r.item_id for r in got.collect()} == {"i1", "i3"}


def test_view_ranking_keeps_top_n_per_type(spark):
    catalogue = items(spark, *[(f"m{i}", "movie") for i in range(4)], *[(f"s{i}", "series") for i in range(4)])
    watched = watches(spark, *[
        ("u1", f"{kind}{i}", 1, "mobile", NOW) for kind in "ms" for i in range(4) for _ in range(i + 1)
    ])
    got = reports.view_ranking(watched, catalogue, users(spark, ("u1",)), F.lit(NOW), top_n=2).collect()
    assert {(r.type, r.rank, r.item_id) for r in got} == {
        ("movie", 1, "m3"), ("movie", 2, "m2"), ("series", 1, "s3"), ("series", 2, "s2"),
    }


def test_rating_ranking_breaks_ties_by_count_then_views(spark):
    catalogue = items(spark, ("i1",), ("i2",), ("i3",), ("i4",))
    people = users(spark, ("u1",), ("u2",))
    rated = ratings(
        spark, ("u1", "i1", 4, NOW), ("u1", "i2", 4, NOW), ("u1", "i3", 4, NOW), ("u2", "i3", 4, NOW),
        ("u1", "i4", 5, ago(minutes=11)),
    )
    watched = watches(
        spark, ("u1", "i2", 1, "mobile", NOW), ("u1", "i1", 1, "mobile", ago(minutes=11)),
        ("u2", "i1", 1, "mobile", ago(minutes=12)),
    )
    got = reports.rating_ranking(rated, watched, catalogue, people, F.lit(NOW))
    assert [r.item_id for r in got.orderBy("rank").collect()] == ["i3", "i2", "i1"]


def test_top_genre_takes_the_last_watches_first(spark):
    catalogue = items(
        spark, *[(f"h{i}", "movie", 100, "Horror") for i in range(3)], *[(f"c{i}", "movie", 100, "Comedy") for i in range(2)]
    )
    order = ["h0", "h1", "h2", "c0", "c1"]
    watched = watches(spark, *[("u1", item, 1, "mobile", ago(minutes=5 - i)) for i, item in enumerate(order)])
    row = reports.top_genre(watched, catalogue, users(spark, ("u1",)), n=2).first()
    assert (row.top_genre, row.genre_watch_count, row.watches_used) == ("Comedy", 2, 2)


def test_top_genre_ties_and_missing_genres(spark):
    catalogue = items(
        spark, ("d", "movie", 100, "Drama"), ("c", "movie", 100, "Comedy"), ("n", "movie", 100, None)
    )
    watched = watches(
        spark,
        *[("u1", item, 1, "mobile", ago(minutes=m)) for m, item in enumerate(["d", "c", "d", "c"])],
        *[("u2", item, 1, "mobile", ago(minutes=m)) for m, item in enumerate(["n", "d", "n"])],
        ("u3", "n", 1, "mobile", NOW),
    )
    got = by_key(reports.top_genre(watched, catalogue, users(spark, ("u1",), ("u2",), ("u3",)), n=4), "user_id")
    assert (got["u1"].top_genre, got["u1"].genre_watch_count) == ("Comedy", 2)
    assert (got["u2"].top_genre, got["u2"].watches_used) == ("Drama", 1)
    assert "u3" not in got


def test_completion_threshold(spark):
    catalogue = items(spark, ("m", "movie", 100), ("s", "series", None), ("x", "movie", None))
    watched = watches(
        spark, ("u1", "m", 5100, "mobile", NOW), ("u2", "m", 5099, "mobile", NOW),
        ("u1", "s", 2040, "mobile", NOW), ("u2", "s", 2039, "mobile", NOW), ("u1", "x", 9000, "mobile", NOW),
    )
    got = by_key(reports.completion_rate(watched, catalogue, users(spark, ("u1",), ("u2",))), "item_id")
    assert (got["m"].completion_rate, got["m"].watch_count) == (0.5, 2)
    assert (got["s"].completion_rate, got["s"].watch_count) == (0.5, 2)
    assert (got["x"].completion_rate, got["x"].watch_count) == (None, 1)


def test_demographics_count_each_viewer_once(spark):
    people = users(spark, ("u1", 20, "male"), ("u2", 40, "female"), ("u3", 30, "nonbinary"), ("u4", None, None))
    watched = watches(
        spark, ("u1", "i1", 100, "mobile", NOW), ("u1", "i1", 200, "mobile", NOW),
        ("u2", "i1", 100, "mobile", NOW), ("u3", "i1", 100, "mobile", NOW), ("u4", "i2", 1, "mobile", NOW),
    )
    got = by_key(reports.viewer_demographics(watched, items(spark, ("i1",), ("i2",)), people), "item_id")
    row = got["i1"]
    assert row.viewer_count == 3 and row.average_age == pytest.approx(30)
    assert row.pct_unknown == pytest.approx(1 / 3) and row.pct_other == 0
    assert row.pct_male + row.pct_female + row.pct_other + row.pct_unknown == pytest.approx(1)
    assert got["i2"].average_age is None and got["i2"].pct_unknown == 1


def test_mood_limits_and_recency(spark):
    given = {"good": [5, 5, 5], "high": [4, 5], "low": [3, 4], "bad": [1, 2], "recent": [1, 1, 1, 5, 5]}
    rows = [
        (user, f"i{i}", value, ago(minutes=len(values) - i))
        for user, values in given.items() for i, value in enumerate(values)
    ]
    catalogue = items(spark, *[(f"i{i}",) for i in range(5)])
    got = by_key(reports.user_mood(ratings(spark, *rows), catalogue, users(spark, *[(u,) for u in given])), "user_id")
    assert {user: row.mood for user, row in got.items()} == {
        "good": "good", "high": "average", "low": "average", "bad": "bad", "recent": "average",
    }
    assert got["recent"].ratings_used == 3
    assert got["recent"].avg_recent_rating == pytest.approx(11 / 3)


def test_type_ratio_counts_rewatches(spark):
    catalogue = items(spark, ("m", "movie"), ("s", "series"))
    watched = watches(spark, *[("u1", item, 100, "mobile", NOW) for item in ("m", "m", "m", "s")])
    row = reports.type_ratio(watched, catalogue, users(spark, ("u1",))).first()
    assert (row.movie_watch_count, row.series_watch_count) == (3, 1)
    assert (row.movie_percentage, row.series_percentage) == (0.75, 0.25)


def test_device_tie_goes_to_the_later_watch_and_null_language_has_no_vote(spark):
    catalogue = items(
        spark, ("en", "movie", 100, None, "en"), ("es", "movie", 100, None, "es"), ("none", "movie", 100, None, None)
    )
    watched = watches(
        spark, ("u1", "en", 100, "mobile", ago(minutes=4)), ("u1", "en", 100, "mobile", ago(minutes=3)),
        ("u1", "es", 100, "desktop", ago(minutes=2)), ("u1", "none", 100, "desktop", ago(minutes=1)),
        ("u2", "none", 100, "tablet", NOW),
    )
    got = by_key(reports.top_device_language(watched, catalogue, users(spark, ("u1",), ("u2",))), "user_id")
    assert tuple(got["u1"])[1:] == ("desktop", 2, "en", 2)
    assert tuple(got["u2"])[1:] == ("tablet", 1, None, None)


def test_watch_counts(spark):
    watched = watches(spark, *[("u1", item, 100, "mobile", NOW) for item in ("i1", "i1", "i1", "i2", "gone")])
    row = reports.watch_counts(watched, items(spark, ("i1",), ("i2",)), users(spark, ("u1",))).first()
    assert (row.distinct_items_watched, row.total_watches) == (2, 4)
