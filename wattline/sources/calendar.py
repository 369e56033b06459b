"""Public holidays by rule, as expressions of a date.

Nation-wide days only: the days all parts of a country share, with the days
observed when one falls on a weekend. There is no table and no span of years:
whether a date is a holiday is computed from the date.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The country of each site; unknown sites count as US.
SITE_COUNTRIES = {
    0: "US", 1: "UK", 2: "US", 3: "US", 4: "US", 5: "UK", 6: "US", 7: "CA",
    8: "US", 9: "US", 10: "US", 11: "CA", 12: "IE", 13: "US", 14: "US", 15: "US",
}
DEFAULT_COUNTRY = "US"

# Days set by proclamation, by country.
PROCLAIMED = {
    "UK": ["1973-11-14", "1977-06-07", "1981-07-29", "1999-12-31", "2002-06-03", "2002-06-04",
           "2011-04-29", "2012-06-04", "2012-06-05", "2022-06-02", "2022-06-03", "2022-09-19", "2023-05-08"],
}

_MON, _THU, _FRI, _SAT = 0, 3, 4, 5


def _over(a: Column | int, b: int) -> Column:
    """Whole quotient of numbers that aren't negative."""
    return F.floor(a / F.lit(b)).cast("int")


class _Day:
    """A date and what rules ask of it; weekdays count from Monday = 0."""

    def __init__(self, date: Column):
        self.date = date
        self.year, self.month, self.day, self.weekday = F.year(date), F.month(date), F.dayofmonth(date), F.weekday(date)

    def shifted(self, days: int) -> _Day:
        return _Day(F.date_add(self.date, days))

    def on(self, month: int, *days: int) -> Column:
        return (self.month == month) & self.day.isin(*days)

    def nth(self, month: int, weekday: int, nth: int) -> Column:
        return (self.month == month) & (self.weekday == weekday) & (_over(self.day - 1, 7) == nth - 1)

    def last(self, month: int, weekday: int) -> Column:
        return (self.month == month) & (self.weekday == weekday) & (F.month(F.date_add(self.date, 7)) != month)

    def since(self, year: int) -> Column:
        return self.year >= year

    def after_easter(self, days: int) -> Column:
        """Whether this is so many days after Easter Sunday, by the anonymous Gregorian rule. Easter lies between March and April."""
        century, moon, rest = _over(self.year, 100), self.year % 19, self.year % 100
        epact = (19 * moon + century - _over(century, 4) - _over(century - _over(century + 8, 25) + 1, 3) + 15) % 30
        weekday = (32 + 2 * (century % 4) + 2 * _over(rest, 4) - epact - rest % 4) % 7
        serial = epact + weekday - 7 * _over(moon + 11 * epact + 22 * weekday, 451) + 114
        easter = F.make_date(self.year, _over(serial, 31), serial % 31 + 1)
        return self.month.between(3, 5) & (F.datediff(self.date, easter) == days)


def _any(*rules: Column) -> Column:
    return reduce(or_, rules)


def _or_nearest_workday(day: _Day, rule) -> Column:
    """A day of the rule; a Saturday is also kept on the Friday before, a Sunday on the Monday after."""
    before, after = day.shifted(-1), day.shifted(1)
    return _any(rule(day), (day.weekday == _FRI) & rule(after), (day.weekday == _MON) & rule(before))


def _or_next_monday(day: _Day, rule) -> Column:
    """A day of the rule; a weekend day is also kept on the Monday after."""
    return rule(day) | ((day.weekday == _MON) & _any(*[rule(day.shifted(-n)) for n in (1, 2)]))


def _boxing_days(day: _Day) -> Column:
    """25 and 26 December; weekend days are made up for two days later."""
    ago = day.shifted(-2)
    return day.on(12, 25, 26) | (ago.on(12, 25, 26) & (ago.weekday >= _SAT))


def _united_states(day: _Day) -> Column:
    def dated(d: _Day) -> Column:
        return _any(d.on(1, 1), d.on(7, 4), d.on(12, 25), d.on(11, 11) & d.since(1971), d.on(6, 19) & d.since(2021))

    return _any(
        _or_nearest_workday(day, dated), day.nth(1, _MON, 3) & day.since(1986), day.nth(2, _MON, 3), day.last(5, _MON),
        day.nth(9, _MON, 1), day.nth(10, _MON, 2), day.nth(11, _THU, 4))


def _united_kingdom(day: _Day) -> Column:
    may = F.when(day.year.isin(1995, 2020), day.on(5, 8)).otherwise(day.nth(5, _MON, 1))
    return _any(
        _boxing_days(day), day.after_easter(-2), _or_next_monday(day, lambda d: d.on(1, 1)) & day.since(1974), may & day.since(1978),
        day.last(5, _MON) & ~day.year.isin(2002, 2012, 2022))  # moved for the jubilees, see PROCLAIMED


def _canada(day: _Day) -> Column:
    return _any(
        _or_next_monday(day, lambda d: _any(d.on(1, 1), d.on(7, 1), d.on(12, 25))), day.after_easter(-2), day.nth(9, _MON, 1))


def _ireland(day: _Day) -> Column:
    friday = F.weekday(F.make_date(day.year, F.lit(2), F.lit(1))) == _FRI
    return _any(
        _or_next_monday(day, lambda d: d.on(1, 1) | d.on(3, 17)), _boxing_days(day), day.after_easter(1), day.nth(6, _MON, 1),
        day.nth(8, _MON, 1), day.last(10, _MON) & day.since(1977), day.nth(5, _MON, 1) & day.since(1994),
        F.when(friday, day.on(2, 1)).otherwise(day.nth(2, _MON, 1)) & day.since(2023))


RULES = {"US": _united_states, "UK": _united_kingdom, "CA": _canada, "IE": _ireland}


def is_holiday(country: Column, date: Column) -> Column:
    """Whether a date is a holiday of a country; false for other countries and missing dates."""
    day, cases = _Day(date), None
    for name, rule in RULES.items():
        own = rule(day)
        if name in PROCLAIMED:
            own = own | date.isin(*[F.lit(d).cast("date") for d in PROCLAIMED[name]])
        cases = F.when(country == name, own) if cases is None else cases.when(country == name, own)
    return F.coalesce(cases, F.lit(False))


def site_country(site: Column) -> Column:
    pairs = [F.lit(x) for site_id, country in SITE_COUNTRIES.items() for x in (site_id, country)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), site.cast("int")), F.lit(DEFAULT_COUNTRY))
