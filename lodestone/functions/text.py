"""Category slugs, search words and Unicode normalisation."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def category_slug(category: Column) -> Column:
    """File name for a category: letters, digits, blanks, hyphens and underscores survive."""
    kept = F.rtrim(F.regexp_replace(category, r"[^\p{L}\p{N} _-]", ""))
    return F.concat(F.translate(F.lower(kept), " -", "__"), F.lit(".json"))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


@F.pandas_udf(T.StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


def normalise_unicode(text: Column) -> Column:
    """NFC form. ASCII text is in that form already, so Python sees only the rest."""
    return F.coalesce(_nfc(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


@F.pandas_udf(T.StringType())
def _python_literal(text: pd.Series) -> pd.Series:
    return text.map(repr, na_action="ignore")


def quoted(text: Column) -> Column:
    """The text as it shows inside a printed Python list.

    Printable ASCII without quotes or backslashes needs only the outer quotes;
    Python sees only the rest.
    """
    plain = text.rlike(r"^[\x20-\x7E]*$") & ~text.rlike(r"['\\]")
    return F.coalesce(_python_literal(F.when(~plain, text)), F.concat(F.lit("'"), text, F.lit("'")))
