"""Expressions on barcodes and fragment locations."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(bc: Column, sample: str) -> Column:
    """``<text before the first dash>-<sample>``; null and empty stay empty."""
    clean = re.sub(r"\s+", "_", sample.strip())
    return F.when(F.coalesce(bc, F.lit("")) == "", "").otherwise(F.concat(F.split_part(bc, F.lit("-"), F.lit(1)), F.lit(f"-{clean}")))


def design_key(bc: Column, mode: str = "before-dash", n: int = 10) -> Column:
    """The part of a barcode that a design names, without separators; mode before-dash, full, first or last n."""
    own = F.trim(bc)
    flat = F.translate(own if mode == "full" else F.split_part(own, F.lit("-"), F.lit(1)), "_:.", "")
    if mode not in ("before-dash", "full", "first", "last"):
        raise ValueError(f"unknown design key mode {mode}")
    if n <= 0 or mode in ("before-dash", "full"):
        return flat
    return F.left(flat, F.lit(n)) if mode == "first" else F.right(flat, F.lit(n))


def fragment(frag_loc: Column) -> Column:
    """struct<chr, pos1, pos2> of ``chr:pos:mate``; null where a part is missing or a sentinel."""
    part = lambda i: F.split_part(frag_loc, F.lit(":"), F.lit(i))
    number = lambda i: F.when(part(i).rlike("^[0-9]+$"), part(i).cast("int"))
    return F.struct(F.when(~part(1).isin("*", ""), part(1)).alias("chr"), number(2).alias("pos1"), number(3).alias("pos2"))
