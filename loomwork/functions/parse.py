"""Column functions on JSON texts and loosely typed values."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def whole(value: Column) -> Column:
    """Whole number of a text, 0 where it is none; true and false are none."""
    return F.coalesce(F.floor(value.try_cast("double")).cast("bigint"), F.lit(0).cast("bigint"))


def json_int(text: Column, path: str) -> Column:
    return whole(F.get_json_object(text, path))


# How a refused request is told.
FILTER_CODES = ("content_filter", "content_policy_violation")
INNER_CODES = ("responsibleaipolicyviolation",)
FILTER_MARKERS = ("content management policy", "content safety system", "responsibleaipolicyviolation", "content_filter")


def content_filtered(body: Column) -> Column:
    """A refusal by its code, its inner code, or marker words in a body that isn't JSON."""
    code = F.lower(F.coalesce(F.try_variant_get(F.try_parse_json(body), F.lit("$.error.code"), "string"), F.lit("")))
    inner = F.lower(F.coalesce(F.try_variant_get(F.try_parse_json(body), F.lit("$.error.innererror.code"), "string"), F.lit("")))
    marked = F.lit(False)
    for m in FILTER_MARKERS:
        marked = marked | F.contains(F.lower(body), F.lit(m))
    return F.coalesce(code.isin(*FILTER_CODES) | inner.isin(*INNER_CODES) | marked, F.lit(False))


def first_object(text: str | None) -> str | None:
    """The first JSON object that stands whole somewhere in a text, or None."""
    decode = json.JSONDecoder().raw_decode
    for at in (m.start() for m in re.finditer(r"\{", text or "")):
        try:
            return text[at : decode(text, at)[1]]
        except ValueError:
            continue
    return None


@F.pandas_udf(StringType())
def repaired_json(texts: pd.Series) -> pd.Series:
    return texts.map(first_object)


def structured(text: Column, schema: str) -> Column:
    """from_json of a model's answer: as it is without its fence; only where that gives nothing, by the first balanced object."""
    bare = F.regexp_replace(F.trim(text), r"^```[a-z]*\s*|\s*```$", "")
    sound = F.try_parse_json(bare).isNotNull()
    return F.from_json(F.when(sound, bare).otherwise(repaired_json(text)), schema)
