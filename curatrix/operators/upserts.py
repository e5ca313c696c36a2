"""Upserts in order, where a row that one input appends can be updated by a later one through another of its keys.

Inputs come in a stated order, each with several keys. An input updates every row, of the base or appended before it, that shares one of
its keys; where there is none it is appended. Whether an input is appended depends on those before it, so it is decided in
rounds: an input is appended once no undecided earlier one could still provide one of its keys, and all later inputs with one of its keys
are then not. A key that half the inputs share is decided in one round, by its least input. Chains of keys that would take
many rounds are cut out as connected components and folded in order, a component a task, if they are small; larger ones go on in
rounds. What is known of a key (its first and last filled values) is rolled up before it meets rows, so that a key which many inputs and
many rows share is never multiplied out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import or_null
from ..sources.session import written

#: Rounds before what is left is cut into components, and the members of a component that one task may fold.
ROUNDS, MOST_FOLDED = 6, 1_000_000


def connected(members: DataFrame, item: str, key: str) -> DataFrame:
    """(item, component: the least item reachable) of items that share keys. Labels hook and jump, so the rounds grow with the logarithm of the longest chain."""
    labels = written(members.groupBy(item).agg(F.col(item).alias("component")))
    while True:
        of = labels.select(F.col(item).alias("_item"), F.col("component").alias("_up"))
        least = members.join(labels, item).groupBy(key).agg(F.min("component").alias("_least"))
        seen = members.join(least, key).groupBy(item).agg(F.min("_least").alias("_least")).join(labels, item)
        hooked = seen.select(item, "_least").unionByName(seen.select(F.col("component").alias(item), "_least")).groupBy(item).agg(F.min("_least").alias("component"))
        jumped = hooked.join(of, F.col("component") == F.col("_item")).select(item, F.least("component", "_up").alias("component"))
        new = written(jumped)
        if new.join(of, (F.col(item) == F.col("_item")) & (F.col("component") != F.col("_up"))).isEmpty():
            return new
        labels = new


def folded_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The appended inputs of components, which come one after the other, each in order of its inputs."""
    component, provided, n, hit, own = None, set(), None, False, []
    out: list = []
    for batch in batches:
        for c, order, key, provides in zip(*(batch.column(x).to_pylist() for x in ("component", "n", "key", "provides")), strict=True):
            if order != n or c != component:
                if n is not None and not hit:
                    out.append(n)
                    provided.update(own)
                n, hit, own = order, False, []
            if c != component:
                component, provided = c, set()
            hit |= key in provided
            if provides:
                own.append(key)
    if n is not None and not hit:
        out.append(n)
    yield pa.RecordBatch.from_pydict({"n": pa.array(out, pa.int64())})


def appended_inputs(members: DataFrame, rounds: int = ROUNDS, most_folded: int = MOST_FOLDED) -> DataFrame:
    """(n): the inputs that are appended, of members (n: order; key; provides: whether the appended row has this key too), none of which meets a row that is there already."""
    left, found = written(members), []
    done = 0
    while not left.isEmpty():
        first = left.where("provides").groupBy("key").agg(F.min("n").alias("_first"))
        free = left.join(first, "key", "left").groupBy("n").agg(F.bool_and(F.coalesce(F.col("_first") >= F.col("n"), F.lit(True))).alias("_free")).where("_free").select("n")
        winners = written(free)
        found.append(winners)
        taken = left.where("provides").join(winners, "n", "left_semi").groupBy("key").agg(F.min("n").alias("_winner"))
        absorbed = left.join(taken, "key").where(F.col("_winner") < F.col("n")).select("n").distinct()
        left = written(left.join(winners.unionByName(absorbed), "n", "left_anti"))
        done += 1
        if done % rounds == 0 and not left.isEmpty():
            parts = connected(left.select("n", "key"), "n", "key")
            small = parts.groupBy("component").agg(F.count("*").alias("_size")).where(F.col("_size") <= most_folded)
            sorted_ = left.join(parts, "n").join(small, "component").repartition("component").sortWithinPartitions("component", "n")
            found.append(written(sorted_.select("component", "n", "key", "provides").mapInArrow(folded_in_order, "n long")))
            left = written(left.join(parts.join(small, "component", "left_anti"), "n", "left_semi"))
    out = members.select("n").limit(0)
    for f in found:
        out = out.unionByName(f)
    return out


def transitive_upsert(base: DataFrame, inputs: DataFrame, row_id: str, order: str, base_keys: Column, input_keys: Column, last: list[str], first: list[str], new_keys: Column | None = None) -> DataFrame:
    """base and the appended inputs after all inputs, in order: row_id, origin (base, appended), n_inputs by its keys, and columns.

    last: columns in which a later filled value overwrites; first: columns that are only filled while blank. base_keys,
    input_keys: arrays; null and empty keys count for none, and an input without keys is always appended. new_keys: those of an input's keys that its
    appended row is found by (all). An appended row's row_id is its input's order, negative and less one, which no base row should have.
    Inputs of one order are an error of the caller's. n_inputs counts an input once for each key that it shares with the row."""
    columns = [*last, *first]
    keys = lambda c: F.coalesce(F.array_distinct(F.filter(c, lambda k: F.coalesce(k != "", F.lit(False)))), F.array().cast("array<string>"))
    rows = inputs.select(F.col(order).cast("long").alias("n"), keys(input_keys).alias("_keys"), *[or_null(F.col(c)).alias(c) for c in columns], *([keys(new_keys).alias("_new")] if new_keys is not None else []))
    rows = written(rows)
    provides = F.array_contains("_new", F.col("key")) if new_keys is not None else F.lit(True)
    members = rows.select("n", F.explode("_keys").alias("key"), *(["_new"] if new_keys is not None else [])).select("n", "key", provides.alias("provides"))
    base_members = base.select(F.col(row_id).alias("_row"), F.explode(keys(base_keys)).alias("key"))
    met = members.join(base_members.select("key").distinct(), "key", "left_semi").select("n").distinct()
    chosen = appended_inputs(members.join(met, "n", "left_anti"))
    appended = written(rows.where(F.size("_keys") == 0).select("n").unionByName(chosen))
    new_members = members.where("provides").join(appended, "n").select((-F.col("n") - 1).alias("_row"), "key", F.col("n").alias("_since"))
    # one appended row at most has a key: inputs of that key count for it from its own on, and for base rows from the first on
    since = new_members.groupBy("key").agg(F.max("_since").alias("_since"))
    filled = lambda c: F.col(c).isNotNull()
    wide = rows.select("n", F.explode("_keys").alias("key"), *columns).join(since, "key", "left")
    after = F.col("n") > F.col("_since")
    value = lambda c: F.struct("n", F.col(c).alias("v"))
    rolled = wide.groupBy("key").agg(F.count("*").alias("_all"), F.count_if(after).alias("_after"), *[F.max(F.when(filled(c), value(c))).alias(f"_l_{c}") for c in last], *[F.min(F.when(filled(c), value(c))).alias(f"_f_{c}") for c in first], *[F.min(F.when(filled(c) & after, value(c))).alias(f"_a_{c}") for c in first])
    own = [F.col(c).cast("string").alias(c) for c in columns]
    found = base_members.select("_row", "key", F.lit(None).cast("long").alias("_since")).unionByName(new_members).join(rolled, "key")
    is_new = F.col("_since").isNotNull()
    updates = found.groupBy("_row").agg(
        F.sum(F.when(is_new, F.col("_after")).otherwise(F.col("_all"))).alias("n_inputs"),
        *[F.max(F.when(~is_new | (F.col(f"_l_{c}.n") > F.col("_since")), F.col(f"_l_{c}"))).getField("v").alias(f"_{c}") for c in last],
        *[F.min(F.when(is_new, F.col(f"_a_{c}")).otherwise(F.col(f"_f_{c}"))).getField("v").alias(f"_{c}") for c in first],
    )
    new_rows = rows.join(appended, "n").select((-F.col("n") - 1).alias(row_id), F.lit("appended").alias("origin"), *own)
    both = base.select(F.col(row_id).cast("long").alias(row_id), F.lit("base").alias("origin"), *[or_null(F.col(c)).alias(c) for c in columns]).unionByName(new_rows)
    joined = both.join(updates, F.col(row_id) == F.col("_row"), "left")
    return joined.select(row_id, "origin", F.coalesce("n_inputs", F.lit(0)).alias("n_inputs"), *[F.coalesce(f"_{c}", c).alias(c) for c in last], *[F.coalesce(c, f"_{c}").alias(c) for c in first])
