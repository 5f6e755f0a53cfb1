"""Day keys (``yyyyMMdd``), hour keys (``yyyyMMddHH``), calendar parts and spines.

All column functions here work on zone-less timestamps and dates and give the same result
under any session time zone: ``date_trunc`` and ``date_format`` on a zone-less timestamp go
through the session zone, so they are avoided for anything finer than a date.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyyMMdd"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- timestamps ------------------------------------------------------------------------


def lenient_timestamp(c: Column | str) -> Column:
    """Parse text to a zone-less timestamp; unparseable text becomes null."""
    return _col(c).try_cast("timestamp_ntz")


def floor_hour(c: Column | str) -> Column:
    """Start of the hour of a zone-less timestamp."""
    c = _col(c)
    return c.cast("date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(c))


def floor_minute(c: Column | str) -> Column:
    """Start of the minute of a zone-less timestamp."""
    return floor_hour(c) + F.make_dt_interval(mins=F.minute(_col(c)))


# ---- keys ------------------------------------------------------------------------------


def day_key(c: Column | str) -> Column:
    return F.date_format(_col(c).cast("date"), DAY)


def day_of_key(key: Column | str) -> Column:
    """Date of a day key or of an hour key."""
    return F.to_date(F.substring(_col(key), 1, 8), DAY)


def two_digits(n: Column | str) -> Column:
    return F.lpad(_col(n).cast("string"), 2, "0")


def hour_key(day: Column | str, hour: Column | str) -> Column:
    """Day key and hour number to an hour key."""
    return F.concat(_col(day), two_digits(hour))


def shift_day_key(key: Column | str, days: int) -> Column:
    return day_key(F.date_add(day_of_key(key), days))


def shifted_hour_key(day: Column | str, hour: Column | str, days: int = -2) -> Column:
    """Hour key of the day ``days`` later (two days back by default)."""
    return hour_key(shift_day_key(day, days), hour)


# ---- calendar parts --------------------------------------------------------------------


def weekday_monday0(c: Column | str) -> Column:
    return F.weekday(_col(c).cast("date"))


def weekday_sunday1(c: Column | str) -> Column:
    return F.dayofweek(_col(c).cast("date"))


def weekday_name(c: Column | str) -> Column:
    return F.date_format(_col(c).cast("date"), "EEEE")


# ---- spines ----------------------------------------------------------------------------


def ntz(ts: datetime | str) -> Column:
    return F.lit(str(ts)).cast("timestamp_ntz")


def hour_spine(start: datetime | str, end: datetime | str) -> Column:
    """Array of every hour from ``start`` to ``end``, both included."""
    return F.sequence(ntz(start), ntz(end), F.make_dt_interval(hours=F.lit(1)))


def day_spine(start: date | str, end: date | str) -> Column:
    """Array of every date from ``start`` to ``end``, both included."""
    return F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))


# ---- run parameters (resolved once, on the driver) ---------------------------------------


def day_text(day: date | str) -> str:
    """Day key of a calendar day, for filters and paths; a key stays as it is."""
    return day if isinstance(day, str) else f"{day:%Y%m%d}"


def days_after(day: date, n: int) -> date:
    return day + timedelta(n)


@dataclass(frozen=True)
class RunDates:
    """Calendar of one run: the feature range ``start``..``end`` and the days around it.

    ``today`` may be given as a day key. Days are dates; text is made where one is compared with
    a partition column (:func:`day_text`).
    """

    today: date
    start: date
    end: date
    max_lag_days: int = 11

    @classmethod
    def predict(cls, today: date | str, weeks: int = 2, delay_days: int = 2) -> RunDates:
        """Prediction run: truth is known up to ``delay_days`` before today."""
        return cls._ending(today, weeks, delay_days)

    @classmethod
    def train(cls, today: date | str, weeks: int = 6) -> RunDates:
        """Training run: the range ends today."""
        return cls._ending(today, weeks, 0)

    @classmethod
    def _ending(cls, today: date | str, weeks: int, delay_days: int) -> RunDates:
        today = date.fromisoformat(today) if isinstance(today, str) else today
        end = days_after(today, -delay_days)
        return cls(today, days_after(end, 1 - 7 * weeks), end)

    @property
    def tomorrow(self) -> date:
        return days_after(self.today, 1)

    @property
    def yesterday(self) -> date:
        return days_after(self.today, -1)

    @property
    def warm_up_start(self) -> date:
        """First day needed so that the longest lag of ``start`` exists."""
        return days_after(self.start, -self.max_lag_days)

    @property
    def activity_start(self) -> date:
        """First of the 14 days over which site activity is judged."""
        return days_after(self.end, -13)

    @property
    def weather_days(self) -> tuple[date, date]:
        """Days whose weather the prediction features need: the range, two days ahead."""
        return days_after(self.start, 2), days_after(self.end, 2)

    @property
    def fence_days(self) -> tuple[date, date]:
        """Days whose fences name the cities of a training run."""
        return days_after(self.end, -10), self.end

    @property
    def label_start(self) -> date:
        """First day with a complete two-week history (training)."""
        return days_after(self.start, 14)

    @property
    def label_end(self) -> date:
        """Last day whose target two days later is known (training)."""
        return days_after(self.end, -2)

    @property
    def label_weather_days(self) -> tuple[date, date]:
        """Days whose weather the daily features need: the label days, a day ahead."""
        return days_after(self.label_start, 1), days_after(self.label_end, 1)
