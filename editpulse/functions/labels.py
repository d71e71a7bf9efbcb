"""Display labels and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the well-known namespaces.
NAMESPACE_LABELS = {
    0: "0 — Articles",
    1: "1 — Talk",
    2: "2 — User",
    3: "3 — User talk",
    4: "4 — Wikipedia",
    6: "6 — File",
    10: "10 — Template",
    14: "14 — Category",
}

# Severity labels with the anonymous-edit count or revert share that reaches them.
SEVERITY_HIGH = "🔴 high"
SEVERITY_MEDIUM = "🟡 medium"
SEVERITY_LOW = "🟢 low"
SEVERITY_LIMITS = ((SEVERITY_HIGH, 6, 0.5), (SEVERITY_MEDIUM, 4, 0.4))


def namespace_label(namespace: Column) -> Column:
    label = F.concat(namespace.cast("string"), F.lit(" — other"))
    for number, text in NAMESPACE_LABELS.items():
        label = F.when(namespace == number, text).otherwise(label)
    return label


def editor_kind(is_bot: Column, is_anon: Column) -> Column:
    return F.when(is_bot, "Bot").when(is_anon, "Anonymous").otherwise("Registered user")


def ticker_who(is_bot: Column, is_anon: Column) -> Column:
    return F.when(is_bot, "🤖 bot").when(is_anon, "👤 anon").otherwise("👨‍💻 user")


def severity(anon_edits: Column, revert_share: Column) -> Column:
    """A NULL share counts as 0."""
    share = F.coalesce(revert_share, F.lit(0.0))
    result = F.lit(SEVERITY_LOW)
    for label, edits, limit in reversed(SEVERITY_LIMITS):
        result = F.when((anon_edits >= edits) | (share >= limit), label).otherwise(result)
    return result


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double; NULL when whole is 0."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def marks_average(first: Column, second: Column) -> Column:
    return (first.cast("bigint") + second.cast("bigint")) / F.lit(2)
