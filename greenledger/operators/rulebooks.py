"""Rules over any raw table: a book names its table and rules, and is compiled like the
rules of readings, into one pass over the table and one report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null, duck_date, duck_int
from . import quality
from .quality import Check, ExistsIn, InDomain, KeyedAgg, Rule, UniqueSubmission

BOOK_QUARANTINE_COLUMNS = ["source", "rule_id", "row_id", "column_name", "value", "reason"]


def _flag(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), F.lit(1)).otherwise(F.lit(0))


@dataclass(frozen=True)
class IsDay(Check):
    """The column is a date; blank counts as none, which ``optional`` allows."""
    column: str
    optional: bool = False

    def failed(self, p: str) -> Column:
        missing = blank_to_null(self.column).isNull()
        return _flag(duck_date(blank_to_null(self.column)).isNull() & (~missing if self.optional else F.lit(True)))


@dataclass(frozen=True)
class IsWhole(Check):
    """The column is a whole number of at least ``least``."""
    column: str
    least: int = 0

    def failed(self, p: str) -> Column:
        n = duck_int(self.column)
        return _flag(n.isNull() | (n < self.least))


@dataclass(frozen=True)
class OnValidDay(Check):
    """The day lies inside a version of the row's site, its ends included. Rows of unknown
    sites are not in scope; a day that is none fails no version."""
    column: str = "incident_date"
    site_column: str = "site_id"
    unit_checked = False

    def keyed_aggs(self):
        versions = F.collect_list(F.struct(duck_date("valid_from").alias("lo"), duck_date(blank_to_null("valid_to")).alias("hi")))
        return [KeyedAgg("sites", "site_id", self.site_column, (("days", versions),))]

    def _versions(self) -> Column:
        return quality.lookup_column("sites", "site_id", self.site_column, "days")

    def checked(self, p: str) -> Column:
        return F.when(self._versions().isNull(), F.lit(0)).otherwise(F.lit(1))

    def failed(self, p: str) -> Column:
        day = duck_date(self.column)
        inside = F.exists(self._versions(), lambda v: (day >= v["lo"]) & (v["hi"].isNull() | (day <= v["hi"])))
        return _flag(day.isNotNull() & ~inside)


@dataclass(frozen=True)
class RuleBook:
    """The rules of one raw table and the column that names its rows."""
    source: str
    id_column: str
    rules: Sequence[Rule]


# Rules of the sources beside readings (ids, names, severities, actions, reasons).
INCIDENT_BOOK = RuleBook("incidents", "incident_id", (
    Rule("DQ101", "incident references a known site", "ERROR", "QUARANTINE", ExistsIn("site_id", "sites", "site_id"),
         "site_id does not exist in the site master"),
    Rule("DQ102", "incident date is a day", "ERROR", "QUARANTINE", IsDay("incident_date"), "incident_date is not a date"),
    Rule("DQ103", "incident day is within the site consolidation period", "ERROR", "QUARANTINE", OnValidDay(),
         "incident is outside the site consolidation period"),
    Rule("DQ104", "lost days are a whole number", "ERROR", "QUARANTINE", IsWhole("lost_days"), "lost_days is no whole number from 0 on"),
    Rule("DQ105", "recordable is answered", "WARN", "FLAG", InDomain("is_recordable", ("Y", "N")), "is_recordable must be Y or N"),
    Rule("DQ106", "incident is reported once", "INFO", "FLAG", UniqueSubmission(("incident_id",))),
))
SITE_BOOK = RuleBook("sites", "site_id", (
    Rule("DQ201", "site validity begins on a day", "ERROR", "QUARANTINE", IsDay("valid_from"), "valid_from is not a date"),
    Rule("DQ202", "site validity ends on a day or is open", "ERROR", "QUARANTINE", IsDay("valid_to", optional=True), "valid_to is not a date"),
    Rule("DQ203", "headcount is a whole number", "WARN", "FLAG", IsWhole("headcount", 1), "headcount is no whole number from 1 on"),
    Rule("DQ204", "site has one version", "INFO", "FLAG", UniqueSubmission(("site_id",))),
))
BOOKS = (INCIDENT_BOOK, SITE_BOOK)


def flagged(book: RuleBook, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The book's table with the weights of its rules: the one pass."""
    return quality.flag_readings(tables[book.source], tables, book.rules)


def book_report(book: RuleBook, flagged_rows: DataFrame) -> DataFrame:
    """``source`` and the columns of the report, one row per rule."""
    return quality.dq_report(flagged_rows, book.rules).select(F.lit(book.source).alias("source"), *quality.REPORT_COLUMNS)


def book_quarantine(book: RuleBook, flagged_rows: DataFrame) -> DataFrame:
    """One row per rule with a reason and failing row, with what stands in the column it asks."""
    rules = [r for r in book.rules if r.reason is not None and not r.is_group_rule]
    hits = [F.when(F.col(quality.failure_column(r)) > 0, F.struct(
        F.lit(r.rule_id).alias("rule_id"), F.lit(r.check.column).alias("column_name"),
        F.col(r.check.column).cast("string").alias("value"), F.lit(r.reason).alias("reason"))) for r in rules]
    rows = flagged_rows.select(F.lit(book.source).alias("source"), F.col(book.id_column).alias("row_id"),
                               F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("h"))
    return rows.select("source", "h.rule_id", "row_id", "h.column_name", "h.value", "h.reason")


def report_of_sources(tables: Mapping[str, DataFrame], books: Sequence[RuleBook] = BOOKS) -> DataFrame:
    return reduce(DataFrame.unionByName, [book_report(b, flagged(b, tables)) for b in books])


def quarantine_of_sources(tables: Mapping[str, DataFrame], books: Sequence[RuleBook] = BOOKS) -> DataFrame:
    return reduce(DataFrame.unionByName, [book_quarantine(b, flagged(b, tables)) for b in books])
