"""Coordinate ranges, 0-based and half-open, as arrays of structs within a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def between(starts: Column, ends: Column, length: Column) -> Column:
    """Ranges [0, ends[0]), [starts[0], ends[1]), ..., [starts[-1], length), without empty ones."""
    begs = F.concat(F.array(F.lit(0).cast("bigint")), starts)
    stops = F.concat(ends, F.array(length.cast("bigint")))
    both = F.zip_with(begs, stops, lambda b, e: F.struct(b.alias("beg"), e.alias("end")))
    return F.filter(both, lambda m: m["end"] > m["beg"])


def at_least(ranges: Column, length: int) -> Column:
    return F.filter(ranges, lambda m: m["end"] - m["beg"] >= length)


def cut_out(texts: dict[str, Column], ranges: Column, *fields: str) -> Column:
    """An array with a struct for each range: its ``fields``, and what of each ASCII text it holds, under the text's name.

    Texts are bytes here, as a place in bytes needs no count from the start: then the time follows what is cut out, and not a long text times
    its ranges. They are made bytes once for a row.
    """
    whole = F.array(F.struct(*[t.cast("binary").alias(name) for name, t in texts.items()]))

    def one(all_of: Column, m: Column) -> Column:
        part = lambda name: F.substring(all_of[name], (m["beg"] + 1).cast("int"), (m["end"] - m["beg"]).cast("int")).cast("string")
        return F.struct(*[m[f].alias(f) for f in fields], *[part(name).alias(name) for name in texts])

    return F.transform(whole, lambda x: F.transform(ranges, lambda m: one(x, m)))[0]


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` / ``whole`` rounded, 0 where there is no whole."""
    return F.when(whole > 0, F.round(part / whole, digits)).otherwise(F.lit(0.0))
