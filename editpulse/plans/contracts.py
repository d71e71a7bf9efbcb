"""The declared contracts of every relation: 61 checks and one freshness rule."""

from __future__ import annotations

from editpulse.functions.wikis import FAMILIES
from editpulse.operators.quality import Contract

# Accepted values and freshness limits in minutes.
EDITOR_TYPES = ("user", "anon", "bot")
NAV_TYPES = ("link", "external", "other")
FRESHNESS = {"relation": "raw.stg_edit", "column": "ingested_at", "warn_minutes": 5, "error_minutes": 30}

_PAGE = {"page_id": ("core.dim_page", "page_id")}
_WIKI = {"wiki_id": ("core.dim_wiki", "wiki_id")}

CONTRACTS: dict[str, Contract] = {
    "raw.stg_edit": Contract(not_null=("edit_id", "ts", "page_title", "wiki_db", "editor")),
    "raw.stg_clickstream": Contract(not_null=("target", "nav_count", "dump_month")),
    "core.dim_time": Contract(not_null=("time_id", "ts"), unique=("time_id", "ts")),
    "core.dim_wiki": Contract(
        not_null=("wiki_id", "wiki_db"), unique=("wiki_id", "wiki_db"), accepted={"family": FAMILIES}
    ),
    "core.dim_page": Contract(
        not_null=("page_id", "wiki_id", "page_title", "namespace"), unique=("page_id",), relationships=_WIKI
    ),
    "core.dim_editor": Contract(
        not_null=("editor_id", "editor_name", "editor_type"),
        unique=("editor_id",),
        accepted={"editor_type": EDITOR_TYPES},
    ),
    "core.fact_edit": Contract(
        not_null=("edit_id", "time_id", "wiki_id", "page_id", "editor_id", "ts"),
        unique=("edit_id",),
        relationships={
            "time_id": ("core.dim_time", "time_id"),
            **_WIKI,
            **_PAGE,
            "editor_id": ("core.dim_editor", "editor_id"),
        },
    ),
    "core.fact_clickstream": Contract(
        not_null=("fc_id", "wiki_id", "target_page_id", "nav_type", "nav_count", "dump_month"),
        unique=("fc_id",),
        accepted={"nav_type": NAV_TYPES},
        relationships={**_WIKI, "target_page_id": ("core.dim_page", "page_id")},
    ),
    "marts.trending_per_minute": Contract(
        not_null=("minute_bucket", "page_id", "edit_count", "rank_in_minute"), relationships=_PAGE
    ),
    "marts.edit_velocity": Contract(not_null=("minute_bucket", "page_id"), relationships=_PAGE),
    "marts.vandalism_candidates": Contract(
        not_null=("window_start", "window_end", "page_id"), relationships=_PAGE
    ),
}
