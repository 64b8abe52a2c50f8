"""X-2, F-10, F-11: arrays of objects recovered from model output that may be cut off or wrapped in prose."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def salvage(raw: str | None) -> list[dict] | None:
    """F-10, F-11: the objects of the array that begins at the first bracket of raw. A whole array comes back as it is,
    whatever follows it; one that cannot be read ends after the last brace of raw. None if there is no array, if it still
    cannot be read (a cut inside a nested object, for instance), or if it holds anything but objects."""
    raw = raw or ""
    start = raw.find("[")
    if start < 0:
        return None
    try:
        got = json.JSONDecoder().raw_decode(raw, start)[0]
    except ValueError:
        try:
            got = json.loads(raw[start : raw.rfind("}") + 1] + "]")
        except ValueError:
            return None
    return got if isinstance(got, list) and all(isinstance(x, dict) for x in got) else None


@F.pandas_udf(T.StringType())
def _salvaged(raw: pd.Series) -> pd.Series:
    def one(x) -> str | None:
        got = salvage(x) if x is not None else None
        return None if got is None else json.dumps(got)

    return raw.map(one).astype(object)


def rules_from_answer(raw: Column) -> Column:
    """array<struct> of the rules in a model's answer; null where nothing can be recovered."""
    item = "name string, if_condition string, then_logic string, source_excerpt string, domain_tag string, confidence_score string, status string"
    return F.from_json(_salvaged(raw), f"array<struct<{item.replace(' string', ':string')}>>")
