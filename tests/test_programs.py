from __future__ import annotations

import os

import pytest

from quarry.functions.calendar import WEEKDAY_LABELS_US
from quarry.plans import formats
from quarry.plans import programs as P
from quarry.sources.text import read_lines, route_by_file
from tests.conftest import rows

MOVIES = (
    "1::Alpha (1999)::Fantasy|Drama\n"
    "2::Beta (2000)::Drama\n"
    "3::Gamma (2001)::Fantasy\n"
    '4::"Delta" (2002)::Comedy|Fantasy\n'
    "5::Eps (2003)::Fantasy\n"
)
RATINGS = "7::1::5::0\n8::1::4::0\n7::2::5::0\n7::4::3::0\n8::5::0::0\n9::99::5::0\n"


def test_genre_count_fixture_m(spark, write_files):
    movies = formats.movies(read_lines(spark, write_files({"movies.dat": MOVIES})))
    assert rows(P.list_item_count(movies)) == [("Comedy", 1), ("Drama", 2), ("Fantasy", 4)]


@pytest.mark.parametrize("k", [2, 10])
def test_fantasy_top_k_fixture_m(spark, write_files, k):
    d = write_files({"movies.dat": MOVIES, "ratings.dat": RATINGS})
    rel = route_by_file(read_lines(spark, d, with_file=True), {"movies": "movies.dat"}, rest="ratings")
    out = P.filtered_join_avg_top_k(
        formats.movies(rel["movies"]), formats.ratings(rel["ratings"]), "Fantasy", k
    )
    assert rows(out, "title", "avg_rating") == [('"Delta" (2002)', 3.0), ("Alpha (1999)", 4.5)]


U_LINES = "B1,1/1/2015,10,100\nB1,1/8/2015,20,200\nB1,1/2/2015,1,2\nB2,01/01/2015,3,4\n"


def test_weekday_totals_fixture_u(spark, write_files):
    trips = formats.dispatches(read_lines(spark, write_files({"trips.txt": U_LINES})))
    assert rows(P.weekday_totals(trips)) == [
        ("B1", "FRI", 2, 1),
        ("B1", "THR", 300, 30),
        ("B2", "THR", 4, 3),
    ]
    us = P.weekday_totals(trips, labels=WEEKDAY_LABELS_US)
    assert ("B1", "THU", 300, 30) in rows(us)


def test_weekday_totals_header_raises_or_drops(spark, write_files):
    d = write_files({"trips.txt": "base,date,vehicles,trips\n" + U_LINES})
    with pytest.raises(Exception):
        P.weekday_totals(formats.dispatches(read_lines(spark, d))).collect()
    dropped = formats.dispatches(read_lines(spark, d), mode="drop")
    assert len(rows(P.weekday_totals(dropped))) == 3


def test_weekday_totals_cover_every_day(spark):
    import datetime as dt

    days = [(f"b{i % 3}", dt.date(2024, 1, 1) + dt.timedelta(days=i), i, 1) for i in range(28)]
    df = spark.createDataFrame(days, "base string, date date, trips long, vehicles long")
    got = {(r["base"], r["day"]): (r["trips"], r["vehicles"]) for r in P.weekday_totals(df).collect()}
    want = {}
    for b, d, t, v in days:
        key = (b, ("MON", "TUE", "WED", "THR", "FRI", "SAT", "SUN")[d.weekday()])
        a = want.get(key, (0, 0))
        want[key] = (a[0] + t, a[1] + v)
    assert got == want


Y_LINES = (
    "v1|u|1|Music|10|20|4.0\nv2|u|1|Music|10|20|5.0\nv3|u|1|News|10|20|3.0\nv4|u|1|Games|10|20|4.0\n"
)


def test_group_avg_top_k_fixture_y(spark, write_files):
    videos = formats.videos(read_lines(spark, write_files({"yt.txt": Y_LINES})))
    out = P.group_avg_top_k(videos, "category", "rating", 2)
    assert rows(out) == [("Games", 4.0), ("Music", 4.5)]


def test_entry_smoke(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["id", "title", "avg_rating"]
    assert len(df.collect()) > 0
