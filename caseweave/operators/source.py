"""The wide incident frame from the mart's tables.

Column names: tickets, texts, facts, notes and values share the key ``in_id``; contacts have ``contact_name``.
Each input is filtered and pruned before it is shuffled; the joins on ``in_id`` reuse one hash partitioning; contacts
are joined by broadcast only if their measured size allows it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of contacts up to which they are broadcast.
BROADCAST_CONTACTS = 200_000


def time_filter(
    col: Column, today: dt.date, start: dt.date | None = None, end: dt.date | None = None, days: int | None = None,
    hours: int | None = None, minutes: int | None = None, default_days: int = 9,
) -> Column:
    """Window on the *date*: start (and end, inclusive) before minutes before hours before days.

    The comparison is on dates, so "30 minutes back" from any time of a day means that whole day.
    """
    day = F.to_date(col)
    if start and end:
        return day.between(F.lit(start), F.lit(end))
    if start:
        return day >= F.lit(start)
    if minutes is not None or hours is not None:
        return day >= F.lit(today)
    return day >= F.lit(today - dt.timedelta(days=default_days if days is None else days))


def look_back(days: int | None = None, hours: int | None = None, minutes: int | None = None, default_minutes: int = 30) -> dt.timedelta:
    """The callers' precedence: days before hours before minutes."""
    if days is not None:
        return dt.timedelta(days=days)
    if hours is not None:
        return dt.timedelta(hours=hours)
    return dt.timedelta(minutes=default_minutes if minutes is None else minutes)


def fix_start(col: Column, today: dt.date, days: int = 7500) -> Column:
    """A start more than ``days`` days ago moves to the current year."""
    limit = F.lit(today) - F.make_dt_interval(F.lit(days))
    return F.when(col < limit, col + F.make_ym_interval(F.year(F.lit(today)) - F.year(col))).otherwise(col)


def neg_to_null(col: Column) -> Column:
    return F.when(col >= 0, col)


def gated_reference(col: Column, opened: Column, since: dt.datetime, prefix: str = "KB", width: int = 40) -> Column:
    """A reference id only after the cut-over, only with its prefix, cut to a width."""
    return F.when((opened > F.lit(since)) & col.startswith(prefix), F.substring(col, 1, width))


def portal_nonworked(portal: Column, contacts: Column) -> Column:
    worked = F.coalesce(contacts, F.lit(0)) != 0
    return F.when((portal == 1) & ~worked, 1).when(portal == 1, 0)


def closed_at(pending_closed: Column, closed: Column) -> Column:
    """When an incident was closed: when it went to pending closed, else its close time."""
    return F.coalesce(pending_closed, closed)


#: Shapes of a text, time or number column; ``cut`` takes a width.
SHAPES = {
    "cut": lambda c, width: F.substring(c, 1, width), "upper": F.upper, "lower": F.lower, "trim": F.trim, "text": lambda c: c.cast("string"),
    "day": lambda c: F.date_trunc("day", c).cast("timestamp_ntz"), "whole": lambda c: c.cast("int"),
}


def shaped(df: DataFrame, key: str, columns: dict[str, tuple]) -> DataFrame:
    """``key`` and one column for each ``new: (old, shape, arguments...)``; shapes are applied from left to right if several are given.

    A null stays null.
    """

    def column(old: str, *steps) -> Column:
        out, left = F.col(old), list(steps)
        while left:
            shape = left.pop(0)
            out = SHAPES[shape](out, left.pop(0)) if shape == "cut" else SHAPES[shape](out)
        return out

    return df.select(key, *(column(*how).alias(new) for new, how in columns.items()))


def note_flag(notes: DataFrame, marker: str, prefix: str = "INC") -> DataFrame:
    """Distinct incidents with the marker in any note, whatever its case."""
    hit = F.upper("note").contains(marker.upper()) & F.col("in_id").startswith(prefix)
    return notes.where(hit).select("in_id").distinct().withColumn("note_flag", F.lit(1))


def row_filter(tickets: DataFrame, updated_since: dt.datetime, primary: str = "Primary", prefix: str = "INC") -> DataFrame:
    """Base rows: no event, type not primary (null types go too), id prefix, updated since or with a parent."""
    recent = (F.col("update_time") >= F.lit(updated_since)) | F.col("parent_id").isNotNull()
    return tickets.where(F.col("event_id").isNull() & (F.col("incident_type") != primary) & F.col("in_id").startswith(prefix) & recent)


def _sized(contacts: DataFrame) -> DataFrame:
    """Contacts with a broadcast hint if they are few; a larger table is left to a shuffled join."""
    few = contacts.limit(BROADCAST_CONTACTS + 1).count() <= BROADCAST_CONTACTS
    return F.broadcast(contacts) if few else contacts


def incident_joins(tickets: DataFrame, texts: DataFrame, facts: DataFrame, flags: DataFrame, contacts: DataFrame, values: DataFrame) -> DataFrame:
    """Tickets with texts and facts (inner), note flags, values and contacts in three roles (left).

    A fourth role of the contacts selects no column and is left out.  Contacts must be unique by name.
    """
    joined = tickets.join(texts, "in_id").join(facts, "in_id").join(flags, "in_id", "left").join(values, "in_id", "left")
    people = _sized(contacts)
    for role, key in (("caller", "callback_contact"), ("opened_by", "opened_by_id"), ("first_assigned", "first_assigned_id")):
        named = people.select(F.col("contact_name").alias(f"__{role}"), *(F.col(c).alias(f"{role}_{c}") for c in contacts.columns if c != "contact_name"))
        joined = joined.join(named, F.col(key) == F.col(f"__{role}"), "left").drop(f"__{role}")
    return joined.withColumn("note_flag", F.coalesce("note_flag", F.lit(0)))


def incident_base(joined: DataFrame, today: dt.date, cutover: dt.datetime) -> DataFrame:
    """The derived columns of the wide frame over the joined tables."""
    c = F.col
    return joined.select(
        "in_id", fix_start(c("start_time"), today).alias("start_time"), "open_time", F.date_trunc("day", c("close_time")).alias("close_day"),
        F.substring(c("brief_description"), 1, 60).alias("brief_description"), F.upper("app").alias("app"),
        neg_to_null(c("restored_duration")).alias("restored_duration"), gated_reference(c("knowledge_id"), c("open_time"), cutover).alias("knowledge_id"),
        F.when(c("open_time") > F.lit(cutover), c("knowledge_id")).alias("issue_ki_id"),
        F.coalesce(c("fact_contact_type"), F.lower("contact_type")).alias("contact_type"),
        portal_nonworked(c("volume_web_portal"), c("contacts")).alias("portal_nonworked"), c("complaints").cast("int").alias("escalation_count"),
        "note_flag", "caller_full_name", "opened_by_full_name", "first_assigned_full_name",
        c("open_time").alias("opened_at"), F.coalesce("pending_closed", "close_time").alias("closed_at"), c("workgroup").alias("first_assignment_group"),
    )


def scope_filter(df: DataFrame, rules: dict) -> DataFrame:
    """Channel, work-group, opener, priority, type, category, article and status rules; the lists are parameters.

    Where a rule excludes a list, nulls stay; a plain ``NOT IN`` would drop them.
    """
    c = F.col
    not_in = lambda col, values: ~col.isin(*values) | col.isNull()
    special = F.upper("workgroup").isin(*(x.upper() for x in rules["integration_groups"]))
    channel = (
        (c("volume_phone") == 1) | (c("volume_chat") == 1) | (c("volume_web_portal") == 1)
        | (((c("volume_integration") == 1) | (c("volume_technician") == 1)) & special)
        | ((c("volume_integration") == 1) & c("opened_by_full_name").isin(*rules["integration_openers"]))
    )
    kind = (c("incident_type") == "Standard") | ((c("incident_type") == "Secondary") & c("first_assigned_id").isNotNull())
    return df.where(
        channel & F.upper("workgroup").isin(*(x.upper() for x in rules["groups"])) & not_in(c("opened_by_id"), rules["openers_out"])
        & not_in(c("priority_code"), rules["priorities_out"]) & kind & c("category").isin(*rules["categories"])
        & not_in(F.trim("knowledge_id"), rules["articles_out"]) & (c("problem_status") == rules["status"])
    )
