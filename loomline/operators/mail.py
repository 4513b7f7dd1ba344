"""Which mail attachments a rule picks, over a manifest table.

The manifest has entry_id, attachment_index, filename, subject, sender_values
and received_at. Rules are configuration, a handful per mailbox, so they become
expressions: matching is a projection without any join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .versions import first_per_key

# Fixed value: extensions taken when a rule names none.
DEFAULT_EXTENSIONS = (".xlsx", ".xls", ".xlsm", ".csv")
REPLACE_LATEST, DATED_ARCHIVE = "replace_latest", "dated_archive"


@dataclass(frozen=True)
class AttachmentRule:
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    extensions: tuple[str, ...] = DEFAULT_EXTENSIONS
    dataset_name: str = ""
    output_folder: str | None = None
    save_mode: str | None = None


@dataclass(frozen=True)
class MailRule:
    name: str
    attachments: tuple[AttachmentRule, ...]
    sender: str = ""
    subject: str = ""
    output_folder: str | None = None
    save_mode: str = DATED_ARCHIVE
    enabled: bool = True

    def folder_of(self, attachment: AttachmentRule) -> str:
        if attachment.output_folder is not None:
            return attachment.output_folder
        return self.name if self.output_folder is None else self.output_folder

    def mode_of(self, attachment: AttachmentRule) -> str:
        return (attachment.save_mode or self.save_mode).strip() or DATED_ARCHIVE


def active_rules(rules: Sequence[MailRule], only: str | None = None) -> list[MailRule]:
    """Enabled rules, or the one asked for; asking for a missing or disabled one is an error."""
    chosen = [r for r in rules if r.enabled and only in (None, r.name)]
    if only is not None and not chosen:
        raise ValueError(f"Enabled rule not found: {only}")
    return chosen


def received_between(manifest: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Mail of the inclusive date range, as a half-open range of instants."""
    if last < first:
        raise ValueError("The end date is before the start date.")
    at = F.col("received_at")
    start, end = F.lit(first).cast("timestamp_ntz"), F.lit(last + dt.timedelta(days=1)).cast("timestamp_ntz")
    return manifest.where((at >= start) & (at < end))


def mail_matches(rule: MailRule) -> Column:
    """Sender and subject contain the rule's texts, ignoring case; an empty text matches all."""
    kept = F.lit(True)
    if rule.sender:
        sender = F.lit(rule.sender.casefold())
        kept = kept & F.exists("sender_values", lambda v: F.contains(F.lower(v), sender))
    if rule.subject:
        kept = kept & F.contains(F.lower(F.coalesce("subject", F.lit(""))), F.lit(rule.subject.casefold()))
    return kept


def file_suffix(name: Column) -> Column:
    """Last extension with its dot in lower case; '' when there is none."""
    return F.lower(F.regexp_extract(name, r"[^/](\.[^./]+)\z", 1))


def attachment_matches(rule: AttachmentRule) -> Column:
    """Extension allowed, no excluded word, and an included word if any are named."""
    name = F.lower("filename")

    def any_word(words: Sequence[str]) -> Column:
        found = F.lit(False)
        for word in words:
            found = found | F.contains(name, F.lit(word.casefold()))
        return found

    kept = file_suffix(F.col("filename")).isin([e.casefold() for e in rule.extensions]) & ~any_word(rule.exclude)
    return kept & any_word(rule.include) if rule.include else kept


def match_mail(manifest: DataFrame, rules: Sequence[MailRule]) -> DataFrame:
    """One row per attachment and mail rule that takes its mail (column rule)."""
    hits = F.array_compact(F.array(*[F.when(mail_matches(r), F.lit(r.name)) for r in rules]))
    return manifest.withColumn("rule", F.explode(hits))


def first_rule(matched: DataFrame, rules: Sequence[MailRule]) -> DataFrame:
    """Settings of the first attachment rule that matches; attachments without one are dropped."""
    chosen = F.lit(None)
    for r in rules:
        of_rule = F.col("rule") == r.name
        for position, a in enumerate(r.attachments, start=1):
            settings = F.struct(
                F.lit(position).alias("attachment_rule"),
                F.lit(a.dataset_name.strip()).alias("dataset_name"),
                F.lit(r.folder_of(a)).alias("output_folder"),
                F.lit(r.mode_of(a)).alias("save_mode"),
            )
            chosen = F.coalesce(chosen, F.when(of_rule & attachment_matches(a), settings))
    return matched.withColumn("_chosen", chosen).where("_chosen is not null").select(*matched.columns, "_chosen.*")


def with_output_name(chosen: DataFrame) -> DataFrame:
    """File name to save under: dataset name and suffix, else the attachment's own name, dated unless latest."""

    def no_slashes(name: Column) -> Column:
        return F.translate(name, "/\\", "__")

    stem = F.col("dataset_name")
    named = F.when(file_suffix(stem) != "", no_slashes(stem)).otherwise(F.concat(stem, file_suffix(F.col("filename"))))
    safe = F.when(stem != "", named).otherwise(no_slashes(F.col("filename")))
    dated = F.concat(F.date_format("received_at", "yyyy-MM-dd"), F.lit("_"), safe)
    return chosen.withColumn("output_name", F.when(F.col("save_mode") == REPLACE_LATEST, safe).otherwise(dated))


def _is_latest() -> Column:
    return F.col("save_mode") == REPLACE_LATEST


def state_key() -> Column:
    """What identifies a saved attachment: the data set for latest files, else the attachment itself."""
    dataset = F.coalesce(F.nullif("dataset_name", F.lit("")), F.col("filename"))
    latest = F.concat_ws("|", "rule", "output_folder", dataset)
    archived = F.concat_ws("|", "rule", "entry_id", F.col("attachment_index").cast("string"), "filename")
    return F.when(_is_latest(), latest).otherwise(archived)


def newest_per_dataset(chosen: DataFrame) -> DataFrame:
    """Of latest-only data sets keep the newest attachment; archived ones all stay.

    One rank over one read: an archived attachment is ranked alone, so the filter is the plain one that cuts each key before the shuffle.
    """
    keyed = chosen.withColumn("state_key", state_key()).withColumn("_alone", F.when(~_is_latest(), F.monotonically_increasing_id()))
    order = [F.desc("received_at"), F.asc("entry_id"), F.asc("attachment_index")]
    return first_per_key(keyed, ["state_key", "_alone"], order).drop("_alone")


def not_seen(newest: DataFrame, state: DataFrame, force: bool = False) -> DataFrame:
    """Drop what was saved before and still exists.

    ``state`` has state_key, received_at and output_exists. An archived
    attachment is done when its key is there; a latest file when the saved one
    is as new. ``force`` takes everything.
    """
    if force:
        return newest
    saved = state.where("output_exists").select(
        F.col("state_key").alias("_key"), F.col("received_at").alias("_saved_at")
    )
    done = (F.col("state_key") == F.col("_key")) & (
        (F.col("save_mode") != REPLACE_LATEST) | (F.col("_saved_at") >= F.col("received_at"))
    )
    return newest.join(saved, done, "left_anti")


def counts_per_rule(matched: DataFrame, saved: DataFrame) -> DataFrame:
    """Mails matched and files saved per rule."""
    mails = matched.groupBy("rule").agg(F.countDistinct("entry_id").alias("matched_emails"))
    files = saved.groupBy("rule").agg(F.count(F.lit(1)).alias("saved_files"))
    return mails.join(files, "rule", "left").select(
        "rule", "matched_emails", F.coalesce("saved_files", F.lit(0)).alias("saved_files")
    )
