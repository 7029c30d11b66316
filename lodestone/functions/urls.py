"""URL predicates, parts and the file names made from URLs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Code points whose compatibility form holds one of / ? # @ :
NETLOC_LOOKALIKES = (
    "⁇⁈⁉℀℁℅℆⩴︓︖"
    "﹕﹖﹟﹫＃／：？＠"
)
# The name rules for a stored document.
SAFE_NAME_LENGTH = 100
SAFE_NAME_REPLACED = "/?&:=."
SAFE_NAME_EMPTY = "content"

AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"


def _ipv6_pattern() -> str:
    group = "[0-9A-Fa-f]{1,4}"
    octet = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    quad = rf"{octet}(?:\.{octet}){{3}}"
    forms = [f"(?:{group}:){{7}}{group}", f"(?:{group}:){{6}}{quad}"]
    for before in range(8):
        head = f"{group}(?::{group}){{{before - 1}}}" if before else ""
        room = 7 - before
        tails = [f"{group}(?::{group}){{0,{room - 1}}}"] if room else []
        if room >= 2:
            tails.append(f"(?:{group}:){{0,{room - 2}}}{quad}")
        forms.append(f"{head}::(?:{'|'.join(tails)})?" if tails else f"{head}::")
    return f"(?:{'|'.join(forms)})(?:%[^%]+)?"


BRACKETED_HOST = rf"^(?:v[0-9A-Fa-f]+\..+|{_ipv6_pattern()})$"


def is_valid_url(url: Column) -> Column:
    """True where ``url`` has a scheme and a network location; null counts as false."""
    cleaned = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    netloc = F.regexp_extract(cleaned, AUTHORITY, 1)
    opens, closes = netloc.contains("["), netloc.contains("]")
    inside = F.regexp_extract(netloc, r"\[([^\]]*)", 1)
    brackets_ok = (~opens & ~closes) | (opens & closes & inside.rlike(BRACKETED_HOST))
    lookalike = netloc.rlike(f"[{NETLOC_LOOKALIKES}]")
    return F.coalesce((netloc != "") & brackets_ok & ~lookalike, F.lit(False))


def safe_url_name(url: Column) -> Column:
    """The file stem under which a URL's document is stored."""
    bare = F.replace(F.replace(url, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    mapped = F.translate(bare, SAFE_NAME_REPLACED, "_" * len(SAFE_NAME_REPLACED))
    short = F.substring(mapped, 1, SAFE_NAME_LENGTH)
    return F.when(short == "", SAFE_NAME_EMPTY).otherwise(short)


def without_extension(path: Column) -> Column:
    """Drop the last extension; a name that starts with its only dot has none."""
    return F.regexp_replace(path, r"([^/.][^/]*)\.[^./]*$", "$1")


def relative_path(path: Column, root: str) -> Column:
    """``path`` below ``root``; paths elsewhere, or an empty root, stay as they are."""
    prefix = root.rstrip("/") + "/"
    if prefix == "/":
        return path
    return F.when(path.startswith(prefix), F.substr(path, F.lit(len(prefix) + 1))).otherwise(path)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def content_path(file_path: Column, url: Column, root: str = "") -> Column:
    """Where a document goes, relative to the output root."""
    return F.concat(
        without_extension(relative_path(file_path, root)), F.lit("/"), safe_url_name(url), F.lit(".md")
    )


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def path_extension(url: Column) -> Column:
    pattern = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/[^?#]*\.([A-Za-z0-9]+)(?:[?#]|$)"
    return F.lower(F.regexp_extract(url, pattern, 1))


def host_suffixes(host_name: Column) -> Column:
    """``a.b.c`` gives ``[a.b.c, b.c, c]``: the domains a host belongs to."""
    labels = F.split(host_name, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
