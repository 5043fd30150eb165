"""Keys at given ranks of a total order, found without sorting the rows.

A pass counts the rows of a few zones of the key and samples the keys of each: rows fall into slots by a hash, and each
slot keeps the key with the smallest hash, which is a uniform sample of distinct keys, pre-aggregated like any sum.  The
zone that holds a rank is known exactly from the counts; the sample says where to cut it next.  When a zone has few
keys left they are counted and read off.  What travels is bounded by slots and zones, not by rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 4096
FEW = 20_000
# Shares of a zone that are cut off around the expected place of a rank; several standard deviations of the sample.
MARGIN = 0.04


def sortable(df: DataFrame, name: str) -> Column:
    """A column as a value that Python gives back unchanged: points in time with a zone as microseconds."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    return F.col(name)


def literal(value: Any, kind: T.DataType) -> Column:
    """``value`` of a row that was read, as a literal of its type."""
    if isinstance(kind, T.StructType):
        return F.struct(*[literal(value[f.name], f.dataType).alias(f.name) for f in kind])
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(kind)


def _inside(key: Column, low: Column | None, high: Column | None) -> Column:
    above = F.lit(True) if low is None else key > low
    return above if high is None else above & (key <= high)


def _read_zones(keys: DataFrame, kind: T.DataType, zones: list[tuple]) -> dict[int, Row]:
    """Of each zone (keys above the first and up to the second bound): ``n`` rows and a sorted sample of keys."""
    key, zone = F.col("key"), F.lit(None).cast("int")
    for i, (low, high) in enumerate(zones):
        bounds = [None if b is None else literal(b, kind) for b in (low, high)]
        zone = F.when(_inside(key, *bounds), F.lit(i)).otherwise(zone)
    hashed = F.xxhash64(key)
    slots = (
        keys.select("key", hashed.alias("_hash"), zone.alias("_zone"))
        .where("_zone IS NOT NULL")
        .groupBy("_zone", F.pmod("_hash", F.lit(SLOTS)).alias("_slot"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_hash", "key"))["key"].alias("key"))
    )
    rows = slots.groupBy("_zone").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list("key")).alias("sample")).collect()
    return {r["_zone"]: r for r in rows}


def _read_off(keys: DataFrame, kind: T.DataType, zone: tuple, ranks: Sequence[int]) -> list[Any]:
    """The keys at ranks within a zone of few distinct keys."""
    bounds = [None if b is None else literal(b, kind) for b in zone]
    counted = keys.where(_inside(F.col("key"), *bounds)).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    listed = counted.agg(F.array_sort(F.collect_list(F.struct("key", "n")))).first()[0]
    found, passed = {}, 0
    for key, n in listed:
        for rank in ranks:
            if passed < rank <= passed + n:
                found[rank] = key
        passed += n
    return [found[r] for r in ranks]


def keys_at_ranks(keys: DataFrame, ranks_of: Callable[[int], Sequence[int]]) -> tuple[int, list[Any]]:
    """Number of rows of ``keys`` (one column ``key`` of any sortable type) and the key at each wanted rank.

    ``ranks_of`` gets the number of rows and returns ranks from 1 on; a rank of 0 has no key (None).  Rows are read some
    four times for a billion of them, so pass a frame that is cheap to read.
    """
    kind = keys.schema["key"].dataType
    whole = _read_zones(keys, kind, [(None, None)]).get(0)
    total = whole["n"] if whole else 0
    ranks = [int(r) for r in ranks_of(total)]
    if any(r < 0 or r > total for r in ranks):
        raise ValueError(f"ranks {ranks} of {total} rows")
    # Of each rank: its zone, the rows before the zone, what was read of the zone.
    state = {r: ((None, None), 0, whole) for r in set(ranks) if r}
    found: dict[int, Any] = {0: None}
    while state:
        cuts: dict[tuple, set[int]] = {}
        ready: dict[tuple, list[int]] = {}
        for rank, (zone, before, read) in state.items():
            sample = read["sample"]
            if read["n"] <= FEW or len(sample) < SLOTS // 2:
                ready.setdefault(zone, []).append(rank)
                continue
            place, margin = (rank - before) / read["n"] * len(sample), MARGIN * len(sample)
            inner = {int(p) for p in (place - margin, place + margin) if 0 <= p < len(sample) - 1}
            cuts.setdefault(zone, set()).update(inner)
        for zone, wanted in ready.items():
            keys_found = _read_off(keys, kind, zone, [r - state[r][1] for r in wanted])
            found.update(zip(wanted, keys_found))
            for rank in wanted:
                del state[rank]
        if not state:
            break
        samples = {zone: read["sample"] for zone, _, read in state.values()}
        parts = {}
        for zone, places in cuts.items():
            edges = [zone[0], *(samples[zone][p] for p in sorted(places)), zone[1]]
            parts[zone] = list(zip(edges, edges[1:]))
        # Zones do not overlap, so one pass reads those of all ranks.
        listed = [part for zone in parts for part in parts[zone]]
        read = _read_zones(keys, kind, listed)
        at = {part: read.get(i) for i, part in enumerate(listed)}
        for rank, (zone, before, _) in list(state.items()):
            for part in parts[zone]:
                n = at[part]["n"] if at[part] else 0
                if before < rank <= before + n:
                    state[rank] = (part, before, at[part])
                    break
                before += n
    return total, [found[r] for r in ranks]
