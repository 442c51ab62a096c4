from datetime import date

import pytest

from tillstone.plans.calendar import calendar_spine
from tillstone.schemas import CALENDAR


@pytest.fixture(scope="module")
def calendar(spark):
    bounds = spark.createDataFrame([(date(2016, 12, 1), date(2024, 3, 1))], "first_day date, last_day date")
    return calendar_spine(bounds)


def test_contract(calendar):
    assert [(f.name, f.dataType) for f in calendar.schema] == [(f.name, f.dataType) for f in CALENDAR]


def test_known_days(calendar):
    rows = {r["Date"]: r for r in calendar.collect()}

    def brief(day):
        r = rows[day]
        return (r["FiscalYear"], r["FiscalQuarter"], r["FiscalMonthNumber"], r["FiscalWeekOfYear"], r["FiscalMonthName"])

    assert brief("2017-01-28") == ("2016", "4", "12", "52", "January")
    assert brief("2017-01-29") == ("2017", "1", "1", "1", "February")
    assert brief("2017-02-25") == ("2017", "1", "1", "4", "February")
    assert brief("2017-02-26") == ("2017", "1", "2", "5", "March")
    assert brief("2017-04-01") == ("2017", "1", "2", "9", "March")
    assert brief("2017-04-02") == ("2017", "1", "3", "10", "April")
    assert brief("2018-02-03") == ("2017", "4", "12", "53", "January")  # a year of 53 weeks
    assert brief("2018-02-04") == ("2018", "1", "1", "1", "February")
    assert brief("2019-02-03") == ("2019", "1", "1", "1", "February")
    assert brief("2024-02-03") == ("2023", "4", "12", "53", "January")
    r = rows["2019-04-30"]
    assert (r["date_id"], r["DayOfWeek"], r["DayName"], r["DayOfMonthNumber"]) == ("20190430", "3", "Tuesday", "30")
    assert (r["FiscalMonthYear"], r["FiscalQuarterYear"], r["FiscalMonthOfQuarter"]) == ("April 2019", "Q1 2019", "3")


def test_every_day_once_and_weeks_of_seven_days(calendar):
    rows = calendar.collect()
    assert len(rows) == len({r["date_id"] for r in rows}) == (date(2024, 3, 1) - date(2016, 12, 1)).days + 1
    weeks = {}
    for r in rows:
        weeks.setdefault((r["FiscalYear"], r["FiscalWeekOfYear"]), set()).add(r["DayOfWeek"])
    inner = [days for (year, _), days in weeks.items() if year in ("2017", "2018", "2019", "2020", "2021", "2022")]
    assert all(len(days) == 7 for days in inner)
