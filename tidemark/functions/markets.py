"""Symbol lookups: exchange suffix, home benchmark, closing time, t quantiles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import BENCHMARKS, EXCHANGES, INDEX_SUFFIX, T975, T975_LARGE


def _lookup(table: Mapping[str, object], key: Column) -> Column:
    """A configuration map as a literal: null when the key is missing."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def symbol_suffix(symbol: Column) -> Column:
    """Exchange suffix of a symbol; the empty suffix is the default exchange."""
    tail = F.regexp_extract(symbol, r"(\.[A-Z]{1,2})$", 1)
    known = F.when(tail.isin(*[s for s in EXCHANGES if s]), tail).otherwise(F.lit(""))
    return F.coalesce(_lookup(INDEX_SUFFIX, symbol), known)


def benchmark_of(symbol: Column, benchmarks: Mapping[str, str] = BENCHMARKS) -> Column:
    return F.coalesce(_lookup(benchmarks, symbol_suffix(symbol)), F.lit("^GSPC"))


def close_utc(symbol: Column, session: Column) -> Column:
    """The instant (UTC) at which the symbol's exchange closes on the session date."""
    suffix = symbol_suffix(symbol)
    zone = _lookup({s: z for s, (z, _) in EXCHANGES.items()}, suffix)
    clock = _lookup({s: c for s, (_, c) in EXCHANGES.items()}, suffix)
    local = F.to_timestamp(F.concat(F.date_format(session, "yyyy-MM-dd"), F.lit(" "), clock, F.lit(":00")))
    return F.to_utc_timestamp(local, zone)


def t_quantile(df: Column) -> Column:
    """97.5% Student-t quantile, taking the next larger tabulated df; null below 1."""
    value = F.when(df < 1, F.lit(None).cast("double"))
    for limit, t in T975.items():
        value = value.when(df <= limit, F.lit(t))
    return value.otherwise(F.lit(T975_LARGE))
