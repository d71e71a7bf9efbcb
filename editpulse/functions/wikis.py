"""Language and project family of a wiki database name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Project families that end a database name. Names with any other
# ending belong to the default family.
SUFFIX_FAMILIES = (
    "wiktionary", "wikibooks", "wikinews", "wikiquote",
    "wikisource", "wikiversity", "wikivoyage",
)
DEFAULT_FAMILY = "wikipedia"
FAMILIES = (DEFAULT_FAMILY, *SUFFIX_FAMILIES)


def language(wiki_db: Column) -> Column:
    return F.regexp_replace(wiki_db, rf"({'|'.join(SUFFIX_FAMILIES)}|wiki)$", "")


def family(wiki_db: Column) -> Column:
    ending = F.regexp_extract(wiki_db, rf"({'|'.join(SUFFIX_FAMILIES)})$", 1)
    return F.when(ending != "", ending).otherwise(DEFAULT_FAMILY)
