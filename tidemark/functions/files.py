"""File names, URLs and content hashes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def extension(name: Column) -> Column:
    """Lower-case text after the last dot, blank when there is none."""
    return F.when(F.instr(name, ".") > 0, F.lower(F.substring_index(name, ".", -1))).otherwise("")


def storage_suffix(name: Column) -> Column:
    """Suffix kept on stored files, `.bin` for names without one.

    A leading dot or a trailing dot makes no suffix.
    """
    base = F.substring_index(F.coalesce(name, F.lit("")), "/", -1)
    suffix = F.regexp_extract(base, r"^.+(\.[^.]+)$", 1)
    return F.when(suffix == "", F.lit(".bin")).otherwise(suffix)


def content_hash(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def stored_name(hash_text: Column, name: Column) -> Column:
    return F.concat(hash_text, storage_suffix(name))


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def url_host(url: Column) -> Column:
    """Host in lower case without user info and port."""
    authority = F.regexp_extract(url, r"^[^:/?#]*://([^/?#]*)", 1)
    host = F.regexp_replace(authority, r"^.*@", "")
    bracketed = F.regexp_extract(host, r"^\[([^\]]*)\]", 1)
    plain = F.substring_index(host, ":", 1)
    return F.lower(F.when(bracketed != "", bracketed).otherwise(plain))


def url_problem(url: Column, allowed_domains: Iterable[str]) -> Column:
    """Why a URL may not be fetched; blank when it may.

    https only, and the host is an allowed domain or a subdomain of one.
    """
    host = url_host(url)
    allowed = F.lit(False)
    for domain in allowed_domains:
        allowed = allowed | (host == domain) | host.endswith(f".{domain}")
    return (
        F.when(url.isNull() | (url == ""), F.lit("empty"))
        .when(url_scheme(url) != "https", F.lit("scheme"))
        .when(host == "", F.lit("no_host"))
        .when(~allowed, F.lit("domain"))
        .otherwise(F.lit(""))
    )


def error_class(error: Column) -> Column:
    """First line of an error, at most 50 characters."""
    line = F.substring(F.substring_index(error, "\n", 1), 1, 50)
    return F.when(F.coalesce(error, F.lit("")) == "", F.lit("Unknown")).otherwise(line)
