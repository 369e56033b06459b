"""Holiday expressions against lists of dates made by the same rules in plain Python, over some centuries."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from wattline.sources.calendar import PROCLAIMED, is_holiday

_MON, _THU, _FRI, _SAT = 0, 3, 4, 5


def _nth(year: int, month: int, weekday: int, nth: int) -> date:
    first = date(year, month, 1)
    return first + timedelta((weekday - first.weekday()) % 7 + 7 * (nth - 1))


def _last(year: int, month: int, weekday: int) -> date:
    end = date(year, month + 1, 1) - timedelta(1)
    return end - timedelta((end.weekday() - weekday) % 7)


def _easter(year: int) -> date:
    """Easter Sunday by the anonymous Gregorian rule."""
    century, moon = year // 100, year % 19
    epact = (19 * moon + century - century // 4 - (century - (century + 8) // 25 + 1) // 3 + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * (year % 100 // 4) - epact - year % 100 % 4) % 7
    serial = epact + weekday - 7 * ((moon + 11 * epact + 22 * weekday) // 451) + 114
    return date(year, serial // 31, serial % 31 + 1)


def _nearest_workday(day: date) -> date:
    """Saturday moves to Friday, Sunday to Monday."""
    return day + timedelta({5: -1, 6: 1}.get(day.weekday(), 0))


def _next_monday(day: date) -> date:
    """A weekend day moves to Monday."""
    return day + timedelta(max(0, 7 - day.weekday())) if day.weekday() >= _SAT else day


def _boxing_days(y: int) -> set[date]:
    """25 and 26 December; weekend days are made up for on the 27th and 28th."""
    days = {date(y, 12, 25), date(y, 12, 26)}
    return days | {d + timedelta(2) for d in days if d.weekday() >= _SAT}


def _united_states(y: int) -> set[date]:
    dated = {date(y, 1, 1), date(y, 7, 4), date(y, 12, 25)}
    dated |= {date(y, 11, 11)} if y >= 1971 else set()
    dated |= {date(y, 6, 19)} if y >= 2021 else set()
    days = dated | {_nearest_workday(d) for d in dated}
    days |= {_nth(y, 2, _MON, 3), _last(y, 5, _MON), _nth(y, 9, _MON, 1), _nth(y, 10, _MON, 2), _nth(y, 11, _THU, 4)}
    return days | ({_nth(y, 1, _MON, 3)} if y >= 1986 else set())


def _united_kingdom(y: int) -> set[date]:
    days = _boxing_days(y) | {_easter(y) - timedelta(2)}
    if y >= 1974:
        days |= {date(y, 1, 1), _next_monday(date(y, 1, 1))}
    if y >= 1978:
        days.add(date(y, 5, 8) if y in (1995, 2020) else _nth(y, 5, _MON, 1))
    if y not in (2002, 2012, 2022):  # moved for the jubilees, see PROCLAIMED
        days.add(_last(y, 5, _MON))
    return days


def _canada(y: int) -> set[date]:
    dated = {date(y, 1, 1), date(y, 7, 1), date(y, 12, 25)}
    return dated | {_next_monday(d) for d in dated} | {_easter(y) - timedelta(2), _nth(y, 9, _MON, 1)}


def _ireland(y: int) -> set[date]:
    dated = {date(y, 1, 1), date(y, 3, 17)}
    days = dated | {_next_monday(d) for d in dated} | _boxing_days(y)
    days |= {_easter(y) + timedelta(1), _nth(y, 6, _MON, 1), _nth(y, 8, _MON, 1)}
    if y >= 1977:
        days.add(_last(y, 10, _MON))
    if y >= 1994:
        days.add(_nth(y, 5, _MON, 1))
    if y >= 2023:
        days.add(date(y, 2, 1) if date(y, 2, 1).weekday() == _FRI else _nth(y, 2, _MON, 1))
    return days


RULES = {"US": _united_states, "UK": _united_kingdom, "CA": _canada, "IE": _ireland}


def test_every_day_of_many_years(spark):
    years = [1899, 1900, 1901, 1970, 1971, 1973, 1974, 1977, 1978, 1986, 1993, 1994, 1995, 2000, 2002, 2004, 2010, 2011, 2012, 2020, 2021, 2022, 2023, 2024, 2038, 2100, 2199, 2200, 2400]
    listed = {(c, d) for c, rule in RULES.items() for y in range(1898, 2402) for d in rule(y)}
    listed |= {(c, date.fromisoformat(d)) for c, days in PROCLAIMED.items() for d in days}
    days = spark.createDataFrame([(date(y, 1, 1) + timedelta(n),) for y in years for n in range(366) if (date(y, 1, 1) + timedelta(n)).year == y], "day date")
    rows = days.crossJoin(spark.createDataFrame([(c,) for c in [*RULES, "XX"]], "country string"))
    found = {(r.country, r.day) for r in rows.where(is_holiday(F.col("country"), F.col("day"))).collect()}
    assert found == {(c, d) for c, d in listed if d.year in years}
    assert spark.range(1).select(is_holiday(F.lit("US"), F.lit(None).cast("date")).alias("x")).first().x is False
