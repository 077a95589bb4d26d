"""Type rules of an item as written: checked on the variant, before anything is cast.

A number, boolean, list or object where a text belongs is an error, as is a whole number written with a fraction; casts
would hide these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import error, violations

REQUIRED = ("title", "summary", "why_it_matters")
OPTIONAL = ("original_title", "confidence_note", "follow_up_of")
LISTS = ("entities", "key_numbers", "tickers")


def kind(value: Column, path: str = "$") -> Column:
    """Name of the type at a path: STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, ARRAY<..>, OBJECT<..>, VOID; null if absent."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def _text(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def _missing(value: Column, field: str) -> Column:
    """Absent, null, or the empty text."""
    found = F.coalesce(kind(value, f"$.{field}"), F.lit("VOID"))
    return (found == "VOID") | ((found == "STRING") & (_text(value, f"$.{field}") == ""))


def _whole(found: Column) -> Column:
    """Written without a fraction. 3.0 is a DECIMAL(1,0); only whole numbers beyond 64 bits are long decimals."""
    return F.coalesce(found.rlike(r"^(BIGINT|DECIMAL\((19|[23]\d),0\))$"), F.lit(False))


def _number(found: Column) -> Column:
    return F.coalesce(found.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.lit(False))


def _texts(value: Column, field: str) -> Column:
    """A list of non-empty texts; the empty list is one."""
    found = F.coalesce(kind(value, f"$.{field}"), F.lit(""))
    items = F.try_variant_get(value, f"$.{field}", "array<string>")
    bad = F.exists(items, lambda x: F.coalesce(x == "", F.lit(True)))
    return found.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.coalesce(bad, F.lit(True))


def item_type_violations(items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, rule, severity. items: keys and `value`, the item as a variant."""
    v = F.col("value")
    found = lambda field: F.coalesce(kind(v, f"$.{field}"), F.lit("absent"))
    is_object = F.coalesce(kind(v).startswith("OBJECT"), F.lit(False))
    rules = [("id must be a string", found("id") != "STRING")]
    for field in REQUIRED:
        rules += [(f"missing {field}", _missing(v, field)), (f"{field} must be a string", ~_missing(v, field) & (found(field) != "STRING"))]
    rules += [(f"{field} must be a string", ~_missing(v, field) & (found(field) != "STRING")) for field in OPTIONAL]
    for field in LISTS:
        given = F.lit(True) if field == "entities" else found(field) != "absent"
        rules.append((f"{field} must be a list of non-empty strings", given & ~_texts(v, field)))
    for field in ("impact", "novelty"):
        inside = F.coalesce(F.try_variant_get(v, f"$.{field}", "double").between(0.0, 1.0), F.lit(False))
        rules.append((f"{field} must be a number in [0, 1]", ~(_number(found(field)) & inside)))
    at_least_one = F.coalesce(F.try_variant_get(v, "$.coverage", "decimal(38,0)") >= 1, F.lit(False))
    rules.append(("coverage must be a positive integer", ~(_whole(found("coverage")) & at_least_one)))
    rules.append(("published_at must be a string", found("published_at") != "STRING"))
    sources = F.coalesce(F.size(F.try_variant_get(v, "$.sources", "array<variant>")), F.lit(0))
    rules.append(("sources must be a non-empty list", ~found("sources").startswith("ARRAY") | (sources < 1)))
    broken = [error("item must be an object", ~is_object), *[error(name, is_object & F.coalesce(bad, F.lit(True))) for name, bad in rules]]
    return violations(items, keys, broken)


def source_type_violations(sources: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, rule, severity. sources: keys and `value`, a source as a variant."""
    v = F.col("value")
    is_object = F.coalesce(kind(v).startswith("OBJECT"), F.lit(False))
    text = F.coalesce(kind(v, "$.url") == "STRING", F.lit(False))
    outlet = ~_missing(v, "outlet") & (kind(v, "$.outlet") != "STRING")
    return violations(sources, keys, [
        error("source must be an object", ~is_object), error("url must be a string", is_object & ~text),
        error("missing outlet", is_object & text & _missing(v, "outlet")), error("outlet must be a string", is_object & text & F.coalesce(outlet, F.lit(True))),
    ])
