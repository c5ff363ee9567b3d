"""Holidays by rule against published days."""

import datetime as dt

from pyspark.sql import functions as F

from floorlens.functions import holidays

# Days off as published, by year, as month and day.
PUBLISHED = {
    1973: "0101 0115 0211 0321 0429 0430 0503 0505 0915 0923 0924 1010 1103 1123",
    1986: "0101 0115 0211 0321 0429 0503 0505 0915 0923 1010 1103 1123 1124",
    1993: "0101 0115 0211 0320 0429 0503 0504 0505 0609 0915 0923 1010 1011 1103 1123 1223",
    1998: "0101 0115 0211 0321 0429 0503 0504 0505 0720 0915 0923 1010 1103 1123 1223",
    2003: "0101 0113 0211 0321 0429 0503 0505 0721 0915 0923 1013 1103 1123 1124 1223",
    2008: "0101 0114 0211 0320 0429 0503 0504 0505 0506 0721 0915 0923 1013 1103 1123 1124 1223",
    2009: "0101 0112 0211 0320 0429 0503 0504 0505 0506 0720 0921 0922 0923 1012 1103 1123 1223",
    2015: "0101 0112 0211 0321 0429 0503 0504 0505 0506 0720 0921 0922 0923 1012 1103 1123 1223",
    2019: "0101 0114 0211 0321 0429 0430 0501 0502 0503 0504 0505 0506 0715 0811 0812 0916 0923 1014 1022 1103 1104 1123",
    2020: "0101 0113 0211 0223 0224 0320 0429 0503 0504 0505 0506 0723 0724 0810 0921 0922 1103 1123",
    2021: "0101 0111 0211 0223 0320 0429 0503 0504 0505 0722 0723 0808 0809 0920 0923 1103 1123",
    2024: "0101 0108 0211 0212 0223 0320 0429 0503 0504 0505 0506 0715 0811 0812 0916 0922 0923 1014 1103 1104 1123",
}


def test_holidays_equal_the_published_days(spark):
    rows = holidays.holidays(spark, dt.date(1949, 1, 1), dt.date(2030, 12, 31)).orderBy("holiday_date").collect()
    for year, days in PUBLISHED.items():
        assert [x["holiday_date"].strftime("%m%d") for x in rows if x["holiday_date"].year == year] == days.split(), year


def test_names_and_other_days(spark):
    def name(*day):
        rows = holidays.holidays(spark, dt.date(*day), dt.date(*day)).collect()
        return rows[0]["holiday_name"] if rows else None

    assert [name(2026, 1, 1), name(2009, 9, 22), name(2008, 5, 6), name(2019, 4, 30)] == ["元日", "国民の休日", "振替休日", "国民の休日"]
    assert [name(1986, 5, 4), name(2020, 10, 12), name(1973, 2, 12)] == [None, None, None]


def test_an_empty_span(spark):
    assert holidays.holidays(spark, dt.date(2026, 1, 2), dt.date(2026, 1, 3)).count() == 0
