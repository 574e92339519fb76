"""Day folders that arrive one after the other."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..session import working_dir
from ..sinks.csv import write_day_folders
from ..sources.baskets import read_csv, text_schema
from .inputs import EVENT_IDS, EVENT_TYPES, event_baskets

COLUMNS = [*EVENT_IDS, *EVENT_TYPES]

IN_ORDER = ([0], [1], [2], [3], [4], [5], [6])
# Day 2 comes after day 3, and one run finds nothing new.
LATE_DAY = ([0, 1], [3], [2], [], [4, 5, 6])


class Arrivals:
    """Event baskets staged by weekday, moved to the landing folder on request."""

    def __init__(self, spark: SparkSession, sf_dir: str, label: str):
        self.spark = spark
        base = working_dir(spark, label)
        self.staged, self.landing, self.state = (f"{base}/{n}" for n in ("staged", "landing", "state"))
        write_day_folders(event_baskets(spark, sf_dir), self.staged)

    def arrive(self, days: Iterable[int]) -> None:
        for day in days:
            self.staged_day(day).write.mode("append").option("header", True).csv(
                f"{self.landing}/{day}"
            )

    def staged_day(self, day: int) -> DataFrame:
        return read_csv(self.spark, f"{self.staged}/day={day}/*.csv", text_schema(COLUMNS))
