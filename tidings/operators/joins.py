"""Joins against lookup tables that stay safe when the table or one key grows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as text, an upper-level estimate of what a broadcast would ship."""
    text = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    on: str,
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join many ``facts`` to a ``table`` with one row per ``on``.

    The table is measured first. Up to ``broadcast_bytes`` it is shipped to every task and the
    facts do not move. Beyond that both sides are shuffled on the key and a salt: the facts of
    one key spread over ``salts`` partitions and the table is repeated once per salt, so a key
    that holds a third of the facts still splits. Pass a table that is cheap to read twice
    (a file scan or one behind ``cut_lineage``).
    """
    if how not in ("left", "inner"):
        raise ValueError("the lookup table can only be the optional side")
    if measured_bytes(table) <= broadcast_bytes:
        return facts.join(F.broadcast(table), on, how)
    # The salt follows the row's own values, so a task that runs again sends it the same way.
    others = [c for c in facts.columns if c != on] or [on]
    salted_facts = facts.withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in others]), F.lit(salts)).cast("int")
    )
    salted_table = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_facts.join(salted_table, [on, "_salt"], how).drop("_salt")
