"""Placement of rows on shards by a lookup table that shards fill in turns.

Every shard prefers the slots of a table of prime size in the order offset, offset + skip, offset +
2 skip, ... Shards take turns (a shard of weight w takes w slots in a turn) and claim their next free
slot until the table is full. So shares are even up to one turn, and a shard that leaves
moves few slots of the others. The table has ``size`` rows, a parameter: it is broadcast whatever the
number of rows, and a row's place costs one hash and one look-up.

Defined results: rows are placed by the text of their key, so equal keys share a shard; null keys
are placed by the text of ``spread`` columns if given (else all by one empty key). Empty tables give
empty tables; repeated rows share a shard; all columns stay, and the new names are parameters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65537


def _number(text: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{text}".encode()).hexdigest()[:15], 16)


def fill_table(shards: Mapping[str, int], size: int = TABLE_SIZE) -> list[str]:
    """The shard of every slot; ``shards`` maps names to positive weights, ``size`` is a prime."""
    if any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)) or size < 2:
        raise ValueError("the table size must be a prime")
    if not shards or min(shards.values()) < 1 or sum(shards.values()) > size:
        raise ValueError("at least one shard, weights of one or more, and a slot for each turn")
    names = sorted(shards)
    at = {s: _number(s, "offset") % size for s in names}
    skip = {s: 1 + _number(s, "skip") % (size - 1) for s in names}
    table: list[str | None] = [None] * size
    free = size
    while free:
        for shard in names:
            for _ in range(min(shards[shard], free)):
                while table[at[shard]] is not None:
                    at[shard] = (at[shard] + skip[shard]) % size
                table[at[shard]] = shard
                free -= 1
    return table


def slot(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: 60 bits of the MD5 of its text, modulo the table size."""
    head = F.substring(F.md5(key.cast("string").cast("binary")), 1, 15)
    return F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(size)).cast("int")


def place(
    df: DataFrame, key_col: str, table: list[str], spread: str | None = None,
    slot_col: str = "slot", shard_col: str = "shard",
) -> DataFrame:
    """``df`` with the slot and shard of each row; these two columns replace any of their names."""
    names = sorted(set(table))
    place_of = {s: i for i, s in enumerate(names)}
    ranks = F.split(F.lit(" ".join(str(place_of[s]) for s in table)), " ")
    listed = df.sparkSession.range(1).select(F.posexplode(ranks).alias("slot_", "rank"))
    name = F.element_at(F.array(*map(F.lit, names)), F.col("rank").cast("int") + 1)
    rows = listed.select("slot_", name.alias("shard_"))
    key = F.col(key_col).cast("string")
    if spread:
        key = F.coalesce(key, F.col(spread).cast("string"))
    own = [c for c in df.columns if c not in (slot_col, shard_col)]
    found = df.select(*[F.col(f"`{c}`") for c in own], slot(F.coalesce(key, F.lit("")), len(table)).alias("slot_"))
    return found.join(F.broadcast(rows), "slot_").select(
        *[F.col(f"`{c}`") for c in own], F.col("slot_").alias(slot_col), F.col("shard_").alias(shard_col)
    )
