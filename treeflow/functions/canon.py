"""Byte-stable JSON text and percent-encoding.

Spark's own JSON functions rewrite numbers and escapes and drop nulls, and url_encode is form
encoding, so these few run in Python, a batch at a time.
"""

from __future__ import annotations

import json
from typing import Any
from urllib.parse import quote

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The separators that JSON allows raw but script sources do not.
SEPARATORS = (chr(0x2028), chr(0x2029))


def escape_separators(text: str) -> str:
    for c in SEPARATORS:
        text = text.replace(c, f"\\u{ord(c):04x}")
    return text


def canonical(value: Any, pretty: bool = False) -> str:
    """JSON text: compact without spaces or, if pretty, indented by two; characters as they are."""
    style = {"indent": 2} if pretty else {"separators": (",", ":")}
    return escape_separators(json.dumps(value, ensure_ascii=False, **style))


def reserialise(text: str | None, pretty: bool = False) -> str | None:
    """Canonical form of a JSON text; null for null and for what is no JSON."""
    if text is None:
        return None
    try:
        return canonical(json.loads(text), pretty)
    except ValueError:
        return None


def percent_encode(text: str | None) -> str | None:
    return None if text is None else quote(text, safe="")


@F.pandas_udf(StringType())
def canonical_json(texts: pd.Series) -> pd.Series:
    return texts.map(reserialise)


@F.pandas_udf(StringType())
def pretty_json(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: reserialise(t, True))


@F.pandas_udf(StringType())
def percent_encoded(texts: pd.Series) -> pd.Series:
    return texts.map(percent_encode)
