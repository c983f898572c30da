"""Links among members of shared buckets: few candidate pairs first, then all that are still open."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.operators.graph import connected_components
from tracklake.storage import discard, materialize

NO_PAIRS = (np.zeros(0, np.int64), np.zeros(0, np.int64))


@dataclass
class Close:
    """What two members of a bucket must meet to be a pair. ``columns`` come along with the members;
    ``near(x, y)`` says which pairs may be linked. It gets two dicts of arrays. Where members
    are known whole, ``linked(x, y)`` says, of two arrays of bytes, which pairs are linked."""

    columns: list[str]
    near: Callable[[dict, dict], np.ndarray]
    linked: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None

    def fits(self, rows: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs of rows (a, b) may be linked, or are, where both are known whole."""
        out = self.near({c: rows[c][a] for c in self.columns}, {c: rows[c][b] for c in self.columns})
        if "whole" in rows:
            known = np.flatnonzero(out)
            known = known[(rows["whole"][a[known]] != None) & (rows["whole"][b[known]] != None)]  # noqa: E711  elementwise
            if len(known):
                out[known] = self.linked(rows["whole"][a[known]], rows["whole"][b[known]])
        return out


def shared_buckets(keys: DataFrame, more: DataFrame) -> DataFrame:
    """``(key, rep, company)`` and the columns that ``more`` (rep, ...) has, of the buckets with two members
    or more. ``company``, negative, counts the fellows of a member in all its buckets: the text that
    others were copied from has most."""
    shared = materialize(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = materialize(keys.join(shared, "key"), "members")
    company = materialize(members.groupBy("rep").agg((-F.sum("n")).alias("company")), "company")
    ranked = materialize(members.select("key", "rep").join(company.join(more, "rep"), "rep"), "ranked-members")
    discard(shared, members, company)
    return ranked


def bucket_pairs(rows: dict[str, np.ndarray], growth: int, close: Close | None, thrifty: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers (a, b) of pairs of different components in buckets, and of buckets of which pairs may
    be missing the keys, and the number of members that have been hubs.

    ``rows`` hold whole buckets in order. One member after the other, from ``start`` on, is the hub: it
    is paired with all after it. A bucket is left when its pairs are ``growth`` times its members or more;
    if ``thrifty``, times the links that would make it one component.
    """
    key, component = rows["key"], rows["component"]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(heads, len(key)))
    mixed = np.maximum.reduceat(component, heads) > np.minimum.reduceat(component, heads)
    hub, made = rows["start"][heads].copy(), np.zeros(len(heads), np.int64)
    base = size
    if thrifty:
        number = np.repeat(np.arange(len(heads)), size)
        order = np.lexsort((component, number))
        base = np.bincount(number[order][1:][(component[order][1:] != component[order][:-1]) & (number[order][1:] == number[order][:-1])], minlength=len(heads))
    found = [NO_PAIRS]
    use = np.flatnonzero(mixed & (hub < size - 1))
    while len(use):
        after = size[use] - hub[use] - 1
        bucket = np.repeat(use, after)
        a = heads[bucket] + hub[bucket]
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(after) - after, after)
        fits = np.flatnonzero(component[a] != component[b])
        if close:
            fits = fits[close.fits(rows, a[fits], b[fits])]
        found.append((a[fits], b[fits]))
        made += np.bincount(bucket[fits], minlength=len(made))
        hub[use] += 1
        use = use[(hub[use] < size[use] - 1) & (made[use] < growth * base[use])]
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    left = np.flatnonzero(mixed & (hub < size - 1))
    return a, b, key[heads[left]], hub[left]


def _values(column: pa.Array) -> np.ndarray:
    """Numbers, or a row of 64-bit words for each binary; these are all of one length."""
    if not pa.types.is_binary(column.type):
        return column.to_numpy(zero_copy_only=False)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(np.uint64).reshape(len(column), -1)


def _whole(column: pa.Array) -> np.ndarray:
    """Bytes for each binary or list of numbers, None for null."""
    if not pa.types.is_list(column.type):
        return column.to_numpy(zero_copy_only=False)
    out, at = np.empty(len(column), object), column.offsets.to_numpy()
    data = column.values.to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False)):
        out[i] = data[at[i] : at[i + 1]].tobytes()
    return out


def _scan(columns: list[str], order: str, growth: int, close: Close | None, thrifty: bool):
    """``(hub, rep, open, start)`` from rows in the order of keys: pairs, and the buckets left open."""

    def sorted_buckets(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """The buckets of two members or more, their members by ``order``. Spark sorts by the key alone, which it does by radix."""
        key = rows["key"]
        same = np.concatenate([[False], key[1:] == key[:-1], [False]])
        use = np.flatnonzero(same[1:] | same[:-1])
        use = use[np.lexsort((rows["rep"][use], rows[order][use], key[use]))]
        return {c: x[use] for c, x in rows.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []

        def done(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
            rows = sorted_buckets(rows)
            a, b, left, start = bucket_pairs(rows, growth, close, thrifty) if len(rows["key"]) else (*NO_PAIRS, *NO_PAIRS)
            ends = np.minimum(rows["rep"][a], rows["rep"][b]), np.maximum(rows["rep"][a], rows["rep"][b])
            columns = [pa.concat_arrays([pa.array(x), pa.nulls(len(left), pa.int64())]) for x in ends]
            columns += [pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(x)]) for x in (left, start)]
            return pa.RecordBatch.from_arrays(columns, names=["hub", "rep", "open", "start"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: _whole(batch.column(c)) if c == "whole" else _values(batch.column(c)) for c in batch.schema.names}
            rows.setdefault("component", rows["rep"])  # as long as no member has been linked
            rows.setdefault("start", np.zeros(batch.num_rows, np.int64))  # or been a hub
            last = int(np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1]]))[-1])
            if held and (last or rows["key"][0] != held[-1]["key"][-1]):
                cut = last if last else 0
                yield done({c: np.concatenate([*(h[c] for h in held), rows[c][:cut]]) for c in columns})
                held = [{c: rows[c][cut:] for c in columns}]
            else:
                held.append(rows)
        if held:
            yield done({c: np.concatenate([h[c] for h in held]) for c in columns})

    return run


def _merged(components: DataFrame | None, linked: DataFrame) -> DataFrame:
    """``components`` (node, component) after the further links (hub, rep); components stay named by their smallest member."""
    if components is None:
        return connected_components(linked, "hub", "rep")
    of = {end: components.select(F.col("node").alias(end), F.col("component").alias(f"{end}_of")) for end in ("hub", "rep")}
    ends = materialize(linked.join(of["hub"], "hub", "left").join(of["rep"], "rep", "left").select(F.coalesce("hub_of", "hub").alias("a"), F.coalesce("rep_of", "rep").alias("b")), "joined")
    moved = connected_components(ends, "a", "b")
    fresh = moved.select("node", F.col("node").alias("component")).join(components.select("node"), "node", "left_anti")
    renamed = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
    out = materialize(components.unionAll(fresh).join(renamed, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "components")
    discard(ends, moved, components)
    return out


def linked_components(members: DataFrame, verified: Callable[[DataFrame], DataFrame], close: Close | None = None, order: str = "rep", waves: int = 1, whole: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``(node, component)`` of all linked members of ``members`` (key, rep, ``order``, columns of ``close``).

    ``verified`` adds ``linked`` to distinct pairs (hub, rep), hub < rep. In the first round the first
    member of each bucket, by ``order``, is a hub: it is paired with all others of other components.
    If these pairs are fewer than the bucket's members, the next member is a hub as well, and so on.
    Buckets that still span several components are read again from there, with four times as many
    pairs, until every member has been a hub. So each close pair of a bucket is tested once or has
    its ends in one component, while a bucket of like members gives a star. Members that are read again come with
    all that their links depend on, as ``whole(reps)`` has it (rep, whole), so that pairs are judged in the bucket: only linked ones leave it, not all that a
    signature does not exclude, once for each bucket they share. For members that it leaves out, ``close.near`` decides. A bucket is read by one
    task; it holds the bucket's numbers, no texts. With ``waves``, one bucket in so many goes ahead, so
    that members who share many buckets are mostly linked before the others are read, and a bucket's
    pairs are counted against the links it lacks instead of its members.
    """
    columns = list(dict.fromkeys(["key", "rep", "component", "start", order, *(close.columns if close else [])]))
    rows = members
    every, tried, components, owned, ahead, growth = rows, [], None, None, waves > 1, 1
    if ahead:
        rows = rows.where(F.pmod("key", F.lit(waves)) == 0)
    while True:
        dealt = rows.repartition("key").sortWithinPartitions("key").select(*(c for c in columns if c in rows.columns))
        found = materialize(dealt.mapInArrow(_scan(columns, order, growth, close, waves > 1), "hub long, rep long, open long, start long"), "scanned")
        fresh = found.where("hub IS NOT NULL").select("hub", "rep").distinct()
        if tried:
            past = reduce(DataFrame.unionAll, tried)
            fresh = fresh.join(past.select("hub", "rep"), ["hub", "rep"], "left_anti")
        fresh = materialize(fresh, "pairs")
        if components is None or not fresh.isEmpty():
            judged = materialize(verified(fresh), "verified")
            tried.append(judged)
            if components is None or not judged.where("linked").isEmpty():
                components = _merged(components, judged.where("linked"))
        discard(fresh)
        if ahead:
            discard(found)
            named = every.drop("component").join(components.withColumnRenamed("node", "rep"), "rep", "left")
            rows, ahead = named.withColumn("component", F.coalesce("component", "rep")), False
            continue
        left = materialize(found.where("open IS NOT NULL").select(F.col("open").alias("key"), "start"), "open")
        discard(found)
        if left.isEmpty():
            discard(owned, left, *tried)
            return components
        still = materialize(members.drop("start").join(left, "key"), "open-members")
        discard(owned, left)
        if whole and "whole" not in columns:
            bare, columns = still, [*columns, "whole"]
            still = materialize(bare.join(whole(bare.select("rep").distinct()), "rep", "left"), "whole-members")
            discard(bare)
        members = owned = still
        named = members.join(components.withColumnRenamed("node", "rep"), "rep", "left")
        rows, growth = named.withColumn("component", F.coalesce("component", "rep")), 4 * growth
