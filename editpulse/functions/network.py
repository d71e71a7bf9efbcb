"""Is this editor name an IP address? One loose and one strict answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes the stream parser accepts. The IPv6 shape needs no colon and
# the IPv4 shape checks no range, so "Ada", "2024" and "999.1.1.1" count as addresses.
LOOSE_IPV4 = r"^(\d{1,3}\.){3}\d{1,3}$"
LOOSE_IPV6 = r"^[0-9a-fA-F:]+$"

LONGEST_ADDRESS = 45

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_HEX = r"[0-9a-fA-F]{1,4}"
_RUN = rf"(?:{_HEX}(?::{_HEX})*)?"


def has_ipv4_shape(name: Column) -> Column:
    return name.rlike(LOOSE_IPV4)


def looks_like_ip_loose(name: Column) -> Column:
    return has_ipv4_shape(name) | name.rlike(LOOSE_IPV6)


def is_ip_strict(name: Column) -> Column:
    """True for a valid IPv4 or IPv6 literal (RFC 4291 text forms, optional %zone); NULL is false.

    An address has at most 45 characters before its zone, so longer names meet no pattern with repeated groups.
    """
    v4 = name.rlike(rf"\A{_V4}\z")
    zone_ok = name.rlike(r"\A[^%/]+(?:%[^%/]+)?\z")
    address = F.regexp_replace(name, r"%[^%]*\z", "")
    # A dotted tail stands for two groups.
    groups = F.regexp_replace(address, rf"(?<=:){_V4}\z", "0:0")
    full = groups.rlike(rf"\A{_HEX}(?::{_HEX}){{7}}\z")
    compressed = groups.rlike(rf"\A{_RUN}::{_RUN}\z") & (
        F.regexp_count(groups, F.lit(r"[0-9a-fA-F]+")) <= 7
    )
    # Most names have neither separator and need no pattern at all.
    possible = name.contains(":") | name.contains(".")
    short = F.length(F.substring_index(name, "%", 1)) <= LONGEST_ADDRESS
    return F.coalesce(F.when(possible & short, v4 | (zone_ok & (full | compressed))), F.lit(False))
