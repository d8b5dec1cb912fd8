"""Calendar expressions: date keys, day and month names, fiscal periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English name to (Spanish, French).
DAY_NAMES = {
    "Monday": ("Lunes", "Lundi"),
    "Tuesday": ("Martes", "Mardi"),
    "Wednesday": ("Miércoles", "Mercredi"),
    "Thursday": ("Jueves", "Jeudi"),
    "Friday": ("Viernes", "Vendredi"),
    "Saturday": ("Sábado", "Samedi"),
    "Sunday": ("Domingo", "Dimanche"),
}
MONTH_NAMES = {
    "January": ("Enero", "Janvier"),
    "February": ("Febrero", "Février"),
    "March": ("Marzo", "Mars"),
    "April": ("Abril", "Avril"),
    "May": ("Mayo", "Mai"),
    "June": ("Junio", "Juin"),
    "July": ("Julio", "Juillet"),
    "August": ("Agosto", "Août"),
    "September": ("Septiembre", "Septembre"),
    "October": ("Octubre", "Octobre"),
    "November": ("Noviembre", "Novembre"),
    "December": ("Diciembre", "Décembre"),
}
SPANISH, FRENCH = 0, 1


def date_key(when: Column) -> Column:
    """yyyyMMdd as an integer, by arithmetic rather than by formatting text."""
    return F.year(when) * 10000 + F.month(when) * 100 + F.dayofmonth(when)


def translated(english: Column, names: dict[str, tuple[str, str]], language: int) -> Column:
    """Look the name up in a literal map; an unknown name gives an empty string."""
    pairs = [F.lit(part) for name, words in names.items() for part in (name, words[language])]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), english), F.lit(""))


def semester(quarter: Column) -> Column:
    return F.when(quarter <= 2, 1).otherwise(2)


def fiscal_quarter(quarter: Column) -> Column:
    """Calendar quarters 1 to 4 are fiscal quarters 3, 4, 1 and 2."""
    return (quarter + 1) % 4 + 1


def fiscal_year(year: Column, quarter: Column) -> Column:
    """The year moves forward in fiscal quarter 1 only, so fiscal quarter 2
    (October to December) stays with the calendar year."""
    return F.when(fiscal_quarter(quarter) == 1, year + 1).otherwise(year)


def calendar_columns(day: str) -> dict[str, Column]:
    """Every DimDate column, derived from one date column."""
    date = F.col(day)
    quarter, year = F.quarter(date), F.year(date)
    day_name, month_name = F.date_format(date, "EEEE"), F.date_format(date, "MMMM")
    return {
        "DateKey": date_key(date),
        "FullDateAlternateKey": date,
        "DayNumberOfWeek": F.dayofweek(date),
        "EnglishDayNameOfWeek": day_name,
        "SpanishDayNameOfWeek": translated(day_name, DAY_NAMES, SPANISH),
        "FrenchDayNameOfWeek": translated(day_name, DAY_NAMES, FRENCH),
        "DayNumberOfMonth": F.dayofmonth(date),
        "DayNumberOfYear": F.dayofyear(date),
        "WeekNumberOfYear": F.weekofyear(date),
        "EnglishMonthName": month_name,
        "SpanishMonthName": translated(month_name, MONTH_NAMES, SPANISH),
        "FrenchMonthName": translated(month_name, MONTH_NAMES, FRENCH),
        "MonthNumberOfYear": F.month(date),
        "CalendarQuarter": quarter,
        "CalendarYear": year,
        "CalendarSemester": semester(quarter),
        "FiscalQuarter": fiscal_quarter(quarter),
        "FiscalYear": fiscal_year(year, quarter),
        "FiscalSemester": semester(fiscal_quarter(quarter)),
    }
