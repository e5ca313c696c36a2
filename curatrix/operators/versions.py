"""Two versions of a catalog: differences, non-destructive merges, and patches with guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean, is_blank, is_track_id, nonblank, or_null, text_of
from ..functions.values import added_to_list, comparable_value, edition_score, value_of
from .matching import unambiguous


def field_differences(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], kinds: dict[str, str]) -> DataFrame:
    """(keys, field_name, left_value, right_value, difference) over keys that are unambiguous on both sides; values compare by the kind of their field."""
    def cells(df: DataFrame, name: str) -> DataFrame:
        return unambiguous(df, keys).select(*keys, *[text_of(F.col(c)).alias(c) for c in fields]).unpivot(keys, fields, "field_name", name)

    both = cells(left, "left_value").join(cells(right, "right_value"), [*keys, "field_name"])
    a, b = (comparable_value(F.col("field_name"), F.col(c), kinds) for c in ("left_value", "right_value"))
    kind = F.when(a == "", "missing_left").when(b == "", "missing_right").otherwise("different")
    return both.where(a != b).withColumn("difference", kind)


def key_census(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One row: keys of each side, shared, unambiguous on both, and on one side alone."""
    sizes = lambda df, n: df.groupBy(*keys).agg(F.count("*").alias(n))
    both = sizes(left, "l").join(sizes(right, "r"), keys, "full_outer")
    return both.agg(F.count("l").alias("left_keys"), F.count("r").alias("right_keys"), F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("shared"), F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("unambiguous"), F.count_if(F.col("r").isNull()).alias("only_left"), F.count_if(F.col("l").isNull()).alias("only_right"))


def id_status(legacy: Column, track: Column) -> Column:
    """Whether a legacy id may be copied to the track id."""
    a, b = clean(legacy), clean(track)
    return F.when(a == "", "no_legacy_id").when((b != "") & (a == b), "already_same").when(b != "", "conflict_legacy_id_differs_from_track_id").when(~is_track_id(a), "needs_review_invalid_id_shape").otherwise("safe_to_copy_legacy_id_to_track_id")


def filled(old: Column, new: Column) -> Column:
    """old, or new where old is blank."""
    return F.coalesce(or_null(old), or_null(new), F.lit(""))


def overwritten(old: Column, new: Column) -> Column:
    """new, or old where new is blank."""
    return F.coalesce(or_null(new), or_null(old), F.lit(""))


def patch_candidate(active: DataFrame, staged: DataFrame, keys: list[str], row_id: str, fields: list[str], copied: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(active with blanks filled from staged rows of the same unambiguous key, log of the cells filled). Nothing filled is overwritten. copied: columns of active that take another column's id where that is safe."""
    source = unambiguous(staged, keys).select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).cast("string").alias(f"_s_{c}") for c in fields])
    sole = active.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n = 1").select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    joined = active.join(source.join(sole, [f"_k_{k}" for k in keys]), on, "left")
    new = {c: F.coalesce(or_null(F.col(c)), or_null(F.col(f"_s_{c}")), text_of(F.col(c))) for c in fields}
    for c, legacy in (copied or {}).items():
        new[c] = F.when(id_status(F.col(legacy), F.col(c)).startswith("safe"), clean(F.col(legacy))).otherwise(text_of(F.col(c)))
    both = joined.withColumns({f"_n_{c}": v for c, v in new.items()})
    changes = F.filter(F.array(*[F.struct(F.lit(c).alias("field_name"), text_of(F.col(c)).alias("old_value"), F.col(f"_n_{c}").alias("new_value")) for c in new]), lambda x: x["old_value"] != x["new_value"])
    log = both.select(row_id, F.inline(changes))
    return both.select(*[F.col(f"_n_{c}").alias(c) if c in new else F.col(c) for c in active.columns]), log


def overwrite_violations(log: DataFrame, base: DataFrame, row_id: str, fields: list[str]) -> DataFrame:
    """Logged actions on cells that were filled with something else before."""
    cells = base.select(F.col(row_id).alias("_row"), *[text_of(F.col(c)).alias(c) for c in fields]).unpivot(["_row"], fields, "_field", "base_value")
    joined = log.join(cells, (F.col(row_id) == F.col("_row")) & (F.col("field_name") == F.col("_field")))
    return joined.where(nonblank(F.col("base_value")) & (F.col("base_value") != F.col("new_value"))).drop("_row", "_field")


def upserted(base: DataFrame, rows: DataFrame, key: str, order: list, update: dict[str, Column] | None = None) -> DataFrame:
    """base with the last row of each key in rows: the row itself, or (update) the columns it gives over the base row's. New keys are appended."""
    last = rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")
    if update is None:
        return base.join(last.select(key), key, "left_anti").unionByName(last)
    new = last.select(F.col(key).alias("_key"), *[F.col(c).alias(f"new_{c}") for c in rows.columns if c != key])
    changed = base.join(new, F.col(key) == F.col("_key"), "left")
    changed = changed.select(*[F.when(F.col("_key").isNotNull(), update[c]).otherwise(F.col(c)).alias(c) if c in update else F.col(c) for c in base.columns])
    return changed.unionByName(last.join(base.select(key), key, "left_anti").select(*base.columns))


def merged_one_to_one(base: DataFrame, legacy: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Every key's outcome with its fields: filled (one row each side: blanks of base filled), appended (only in legacy, once), kept (only in base) or ambiguous (several)."""
    side = lambda df, p: df.groupBy(*keys).agg(F.count("*").alias(f"{p}_n"), *[F.min(or_null(F.col(c))).alias(f"{p}_{c}") for c in fields])
    both = side(base, "b").join(side(legacy, "l"), keys, "full_outer")
    b, n = F.coalesce("b_n", F.lit(0)), F.coalesce("l_n", F.lit(0))
    outcome = F.when((b == 1) & (n == 1), "filled").when((b == 0) & (n == 1), "appended").when(n == 0, "kept").otherwise("ambiguous")
    return both.select(*keys, outcome.alias("outcome"), *[F.coalesce(f"b_{c}", f"l_{c}").alias(c) for c in fields])


def merged_catalog(base: DataFrame, legacy: DataFrame, keys: list[str], fields: list[str], renamed: dict[str, str] | None = None, lists: dict[str, str] | None = None) -> DataFrame:
    """base after a merge with legacy, all its rows and those appended, with outcome and n_filled (cells filled from legacy).

    A base row whose key one row has on each side takes legacy's values where it is blank (filled; kept if nothing is taken); rows of a key that several have on
    either side stay as they were (ambiguous); legacy rows whose key base lacks are appended, all of them. renamed: base columns that another column of
    legacy fills. lists: texts that are added to list columns of rows with anything from legacy. Keys are counted before rows are joined."""
    sources = {c: c for c in fields} | (renamed or {})
    counts = lambda df, n: df.groupBy(*keys).agg(F.count("*").alias(n)).select(*[F.col(k).alias(f"_{n}_{k}") for k in keys], n)
    on = lambda n: reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{n}_{k}")) for k in keys])
    mine, theirs = counts(base, "_mine"), counts(legacy, "_theirs")
    sole = legacy.join(theirs.where("_theirs = 1"), on("_theirs"), "left_semi").select(*[F.col(k).alias(f"__sole_{k}") for k in keys], F.struct(*[or_null(F.col(c)).alias(f"v{i}") for i, c in enumerate(sources.values())]).alias("_new"))
    rows = base.join(mine, on("_mine"), "left").join(theirs, on("_theirs"), "left").join(sole, on("_sole"), "left")
    one = (F.col("_mine") == 1) & F.coalesce(F.col("_theirs") == 1, F.lit(False))
    taken = {c: one & is_blank(F.col(c)) & F.col(f"_new.v{i}").isNotNull() for i, c in enumerate(sources)}
    n = sum((F.coalesce(t, F.lit(False)).cast("int") for t in taken.values()), F.lit(0))
    rows = rows.withColumn("n_filled", n)
    filled_in = {c: F.when(t, F.col(f"_new.v{i}")).otherwise(F.col(c)) for i, (c, t) in enumerate(taken.items())}
    filled_in |= {c: F.when(F.col("n_filled") > 0, added_to_list(F.col(c), F.lit(text))).otherwise(F.col(c)) for c, text in (lists or {}).items()}
    outcome = F.when(F.col("_theirs").isNull(), "kept").when(~one, "ambiguous").when(F.col("n_filled") > 0, "filled").otherwise("kept")
    kept = rows.select(*[filled_in.get(c, F.col(c)).alias(c) for c in base.columns], outcome.alias("outcome"), "n_filled")
    have = {c: or_null(F.col(k)) for c, k in sources.items() if c in base.columns} | {k: F.col(k) for k in keys} | {c: F.lit(text) for c, text in (lists or {}).items()}
    new = legacy.join(mine, on("_mine"), "left_anti").select(*[have.get(c, F.lit(None)).alias(c) for c in base.columns], F.lit("appended").alias("outcome"), F.lit(0).alias("n_filled"))
    return kept.unionByName(new)


def official_patch(promotions: DataFrame, columns: dict[str, str], current: dict[str, Column], field: str, value: str, status: str) -> DataFrame:
    """promotions with target_column, current_value and patch_action. columns: promoted field -> official column."""
    target = F.element_at(F.create_map(*[F.lit(x) for p in columns.items() for x in p]), F.col(field))
    rows = promotions.withColumn("target_column", target)
    now = F.coalesce(value_of(current, F.col("target_column")), F.lit(""))
    action = F.when(F.col("target_column").isNull() | F.col(status).isin("not_found", "matched_exact_ambiguous", "matched_title_only_ambiguous"), "manual_review").when(now == text_of(F.col(value)), "no_change").otherwise("update_existing")
    return rows.withColumns({"current_value": now, "patch_action": action})


def official_outcome(target_known: Column, matches: Column, now: Column, expected: Column, promoted: Column) -> Column:
    """Of one official patch: unknown columns first, then rows, then stale values, then values that are current already."""
    return F.when(~target_known, "missing_target_column").when(F.coalesce(matches, F.lit(0)) != 1, "official_match_not_unique").when(text_of(now) != text_of(expected), "stale_current_value").when(text_of(now) == text_of(promoted), "already_current").otherwise("applied")


def cell_patch_outcomes(table: DataFrame, patches: DataFrame, match_columns: list[str], target_columns: list[str]) -> DataFrame:
    """patches (patch_id, seq, match_column, match_value, target_column, old_value, new_value) with row_key, outcome and value_after.

    table needs row_key, which no two rows share. Patches of one cell are applied in order of seq, each on what the one before left: a value that is new already is
    already_applied, one that is not the old value is skipped as stale. A match column must not be patched itself. place tells the order within a cell."""
    cells = table.select("row_key", *[text_of(F.col(c)).alias(c) for c in dict.fromkeys([*match_columns, *target_columns])])
    found = cells.unpivot(["row_key"], match_columns, "_mc", "_mv").groupBy("_mc", "_mv").agg(F.count("*").alias("_hits"), F.min("row_key").alias("row_key"))
    now = cells.unpivot(["row_key"], target_columns, "_tc", "_now").withColumnRenamed("row_key", "_row")
    joined = patches.join(found, (F.col("match_column") == F.col("_mc")) & (F.col("match_value") == F.col("_mv")), "left")
    joined = joined.join(now, (F.col("row_key") == F.col("_row")) & (F.col("target_column") == F.col("_tc")), "left")
    known = lambda c, names: F.coalesce(F.col(c).isin(names), F.lit(False))
    reason = F.when(~known("match_column", match_columns), "missing_match_column").when(~known("target_column", target_columns), "missing_target_column").when(F.coalesce("_hits", F.lit(0)) != 1, "target_match_not_unique")
    joined = joined.withColumn("_reason", reason)
    good = joined.where(F.col("_reason").isNull())
    start = F.struct(F.first("_now").alias("value"), F.array().cast("array<struct<place:bigint,patch_id:string,outcome:string,value_after:string>>").alias("done"))
    steps = F.array_sort(F.collect_list(F.struct("seq", F.col("patch_id").cast("string").alias("patch_id"), text_of(F.col("old_value")).alias("old_value"), text_of(F.col("new_value")).alias("new_value"))))  # one cell's patches

    def apply(state: Column, p: Column) -> Column:
        outcome = F.when(state["value"] == p["new_value"], "already_applied").when(state["value"] != p["old_value"], "stale_current_value").otherwise("applied")
        value = F.when(outcome == "applied", p["new_value"]).otherwise(state["value"])
        return F.struct(value.alias("value"), F.array_append(state["done"], F.struct(F.size(state["done"]).cast("bigint").alias("place"), p["patch_id"].alias("patch_id"), outcome.alias("outcome"), value.alias("value_after"))).alias("done"))

    folded = good.groupBy("row_key", "target_column").agg(start.alias("s"), steps.alias("p")).select("row_key", "target_column", F.inline(F.aggregate("p", F.col("s"), apply)["done"]))
    bad = joined.where(F.col("_reason").isNotNull()).select("row_key", "target_column", F.lit(None).cast("bigint").alias("place"), F.col("patch_id").cast("string").alias("patch_id"), F.col("_reason").alias("outcome"), F.lit(None).cast("string").alias("value_after"))
    return folded.unionByName(bad)


def patched(table: DataFrame, outcomes: DataFrame, columns: list[str]) -> DataFrame:
    """table (with row_key) after its patches: each cell has what the last applied patch left there."""
    done = outcomes.where("outcome = 'applied'")
    last = lambda c: F.max_by("value_after", F.when(F.col("target_column") == c, F.col("place"))).alias(f"_new_{c}")
    new = done.groupBy(F.col("row_key").alias("_row")).agg(*[last(c) for c in columns])
    joined = table.join(new, F.col("row_key") == F.col("_row"), "left")
    return joined.withColumns({c: F.coalesce(f"_new_{c}", c) for c in columns}).select(*table.columns)


def appended_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows to append that the table does not have yet."""
    return rows.select(*table.columns).exceptAll(rows.select(*table.columns).intersect(table)).distinct()


def edition_decision(active: Column, staged: Column) -> Column:
    """Which of two editions to keep."""
    a, b = edition_score(active), edition_score(staged)
    return F.when(a > b, "keep_active").when(b > a, "use_staged").otherwise("needs_review")


def marked_decision(active_mark: Column, staged_mark: Column) -> Column:
    """A decision by marker columns; both marked is a conflict."""
    a, b = F.lower(clean(active_mark)) == "x", F.lower(clean(staged_mark)) == "x"
    return F.when(a & b, "conflict").when(a, "keep_active").when(b, "use_staged").otherwise("needs_review")


def decision_actions(decisions: DataFrame, decision: str, current: Column, accepted: Column, row_found: Column) -> DataFrame:
    """decisions with the action that applies them."""
    action = F.when(F.col(decision).isin("needs_review", "conflict"), "unresolved").when(~row_found, "append").when(is_blank(accepted) | (text_of(current) == text_of(accepted)), "already").otherwise("update")
    return decisions.withColumn("action", action)


def decisions_applied(table: DataFrame, actions: DataFrame, key: str, column: str, accepted: str) -> DataFrame:
    """table after decision_actions (one a key): updates take the accepted value, appended rows have the key and that value. Unresolved ones are an error."""
    if not actions.where("action = 'unresolved'").isEmpty():
        raise ValueError("some decisions are unresolved")
    new = actions.where("action = 'update'").select(F.col(key).alias("_key"), F.col(accepted).alias("_accepted"))
    updated = table.join(new, F.col(key) == F.col("_key"), "left").withColumn(column, F.coalesce("_accepted", column)).select(*table.columns)
    return updated.unionByName(actions.where("action = 'append'").select(key, F.col(accepted).alias(column)), allowMissingColumns=True)
