"""List columns unpacked to rows: items and records in text, with quoting, in their order, and reconciled to the parent.

An item is plain, or quoted (``"a, b"``, a doubled quote stands for one). What is neither (an open quote, text behind
a closing quote, a record that ends early) is a row of its own marked as malformed; nothing is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUOTED = '[ ]*"[^"]*(?:""[^"]*)*"[ ]*'


def item_pattern(sep: str) -> str:
    """Matches every item with its separator in front; both engines read it alike (no look-around)."""
    if len(sep) != 1 or sep in '" ':
        raise ValueError("a separator is one character other than a quote or a space")
    s, others = re.escape(sep), f"[^{re.escape(sep)}"
    return f'{s}{QUOTED}|{s}[ ]*"{others}]*|{s}{others}"]*|{others}]+'


def items(text: Column, sep: str) -> Column:
    """Array of ``value, malformed``; NULL and empty texts have no items.

    A text without a quote is cut at the separators; only the others need the patterns.
    """
    s = re.escape(sep)

    def read(item: Column) -> Column:
        body = F.trim(F.when(item.startswith(sep), F.substring(item, 2, 1_000_000_000)).otherwise(item))
        holds_quote = F.contains(item, F.lit('"'))
        quoted, plain = holds_quote & item.rlike(f"^{s}{QUOTED}$"), ~holds_quote & item.startswith(sep)
        inner = F.replace(F.substr(body, F.lit(2), F.length(body) - 2), F.lit('""'), F.lit('"'))
        return F.struct(F.when(quoted, inner).otherwise(body).alias("value"), (~(quoted | plain)).alias("malformed"))

    matched = F.transform(F.regexp_extract_all(F.concat(F.lit(sep), text), F.lit(item_pattern(sep)), F.lit(0)), read)
    cut = F.transform(F.split(text, s, -1), lambda item: F.struct(F.trim(item).alias("value"), F.lit(False).alias("malformed")))
    none = F.array().cast("array<struct<value:string,malformed:boolean>>")
    return F.when(F.length(text) > 0, F.when(F.contains(text, F.lit('"')), matched).otherwise(cut)).otherwise(none)


def unpack_list(df: DataFrame, column: str, keep: Sequence[str], sep: str = ",") -> DataFrame:
    """``keep, position, value, malformed``: one row per item, positions from 1."""
    return df.select(*keep, F.posexplode(items(F.col(column), sep)).alias("__at", "__item")).select(
        *keep, (F.col("__at") + 1).alias("position"), "__item.value", "__item.malformed")


def unpack_records(df: DataFrame, column: str, keep: Sequence[str], fields: Sequence[str], sep: str = "|") -> DataFrame:
    """``keep, position, fields, malformed``: one row per ``len(fields)`` items; a separator after the last record is allowed.

    A record is malformed when an item of it is, or when the text ends before its last field; the missing fields are NULL.
    """
    width = len(fields)
    # the items are a column of their own: they are named often and must be found once
    listed = df.select(*keep, items(F.col(column), sep).alias("__all"))
    size = F.size("__all")
    closed = (size % width == 1) & (F.get("__all", size - 1)["value"] == "") if width > 1 else F.lit(False)
    n = size - closed.cast("int")

    def record(i: Column) -> Column:
        parts = [F.get("__all", i * width + j) for j in range(width)]
        short = (i + 1) * width > n
        return F.struct(*[part["value"].alias(f) for part, f in zip(parts, fields)], reduce(
            Column.__or__, [F.coalesce(part["malformed"], F.lit(False)) for part in parts], short).alias("malformed"))

    starts = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int")))
    rows = listed.select(*keep, F.posexplode(F.transform(starts, record)).alias("__at", "__record"))
    return rows.select(*keep, (F.col("__at") + 1).alias("position"), "__record.*")


def reconcile(parents: DataFrame, records: DataFrame, key: str, total: str, part: str) -> DataFrame:
    """``key, n_records, n_malformed, records_total, total, difference`` per parent; ``key`` is unique in ``parents``.

    ``total`` is the parent's own amount, ``part`` the amount of a record; malformed records count but add nothing. The records are
    added up before they meet their parent.
    """
    sums = records.groupBy(key).agg(
        F.count("*").alias("n_records"), F.count_if("malformed").alias("n_malformed"), F.sum(F.when(~F.col("malformed"), F.col(part))).alias("records_total"))
    return parents.select(key, total).join(sums, key, "left").select(
        key, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_records", "n_malformed")],
        F.coalesce("records_total", F.lit(0)).cast("decimal(18,2)").alias("records_total"), F.col(total).cast("decimal(18,2)").alias(total),
        (F.col(total) - F.coalesce("records_total", F.lit(0))).cast("decimal(18,2)").alias("difference"))
