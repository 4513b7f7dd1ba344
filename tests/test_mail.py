from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomline.operators import mail

SCHEMA = "entry_id string, attachment_index int, filename string, subject string, sender_values array<string>, received_at timestamp_ntz"
RULE = mail.MailRule(
    "r", (mail.AttachmentRule(("plan",), ("draft",), (".xlsx", ".XLS"), "plans", save_mode="replace_latest"),
          mail.AttachmentRule(extensions=(".csv",))), sender="bob")


def manifest(spark, rows):
    return spark.createDataFrame([(e, i, f, "s", s, dt.datetime(2024, 1, d)) for e, i, f, s, d in rows], SCHEMA)


ROWS = [
    ("1", 1, "Plan A.xlsx", ["Bob@x"], 1), ("2", 1, "PLAN b.xls", ["c", "bob"], 2), ("2", 2, "plan draft.xlsx", ["bob"], 2),
    ("3", 1, "x/y.CSV", ["bob"], 3), ("4", 1, "plan.xlsx", ["alice"], 4), ("5", 1, "noext", ["bob"], 5),
]


def test_selection(spark):
    matched = mail.match_mail(manifest(spark, ROWS), [RULE])
    assert {r["entry_id"] for r in matched.collect()} == {"1", "2", "3", "5"}
    chosen = mail.with_output_name(mail.first_rule(matched, [RULE]))
    assert {(r["entry_id"], r["attachment_rule"], r["output_name"]) for r in chosen.collect()} == {
        ("1", 1, "plans.xlsx"), ("2", 1, "plans.xls"), ("3", 2, "2024-01-03_x_y.CSV")}
    newest = mail.newest_per_dataset(chosen)
    assert {r["entry_id"] for r in newest.collect()} == {"2", "3"}
    state = newest.select("state_key", "received_at", F.lit(True).alias("output_exists"))
    assert mail.not_seen(newest, state).count() == 0
    assert mail.not_seen(newest, state, force=True).count() == 2
    assert mail.not_seen(newest, state.withColumn("output_exists", F.lit(False))).count() == 2
    older = state.withColumn("received_at", F.col("received_at") - F.expr("interval 1 day"))
    assert {r["entry_id"] for r in mail.not_seen(newest, older).collect()} == {"2"}


def test_rule_and_date_errors(spark):
    with pytest.raises(ValueError):
        mail.active_rules([mail.MailRule("a", (), enabled=False)], "a")
    with pytest.raises(ValueError):
        mail.received_between(manifest(spark, ROWS), dt.date(2024, 1, 2), dt.date(2024, 1, 1))
    assert mail.received_between(manifest(spark, ROWS), dt.date(2024, 1, 2), dt.date(2024, 1, 2)).count() == 2
