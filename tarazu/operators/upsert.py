"""Mutations as functions from table states to a new state: nothing is changed in place.

Column names of both sides may clash; the result has the columns of the old state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarazu.functions.jsonx import merged
from tarazu.operators.dedupe import first_wins
from tarazu.operators.ranking import positions


def _sides(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    a = old.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*old.columns).alias("o"))
    b = new.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*new.columns).alias("n"))
    on = [f"_k{i}" for i in range(len(keys))]
    cond = None
    for k in on:
        c = a[k].eqNullSafe(b[k])
        cond = c if cond is None else cond & c
    return a.join(b, cond, "full_outer").select("o", "n")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows are added; of known keys, values that the new row has replace the old, its nulls don't."""
    merged = [F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) if c in new.columns else F.col(f"o.{c}").alias(c) for c in old.columns]
    return _sides(old, new, keys).select(*merged)


def fill_nulls(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """New rows are added; of known keys, only blanks in columns are filled."""
    out = []
    for c in old.columns:
        n = F.col(f"n.{c}") if c in new.columns else F.lit(None)
        blank = F.nullif(F.trim(F.col(f"o.{c}")), F.lit("")) if dict(old.dtypes)[c] == "string" else F.col(f"o.{c}")
        out.append(F.when(F.col("o").isNull(), n).otherwise(F.coalesce(blank, n) if c in columns else F.col(f"o.{c}")).alias(c))
    return _sides(old, new, keys).select(*out)


def diff(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """keys, action (insert, update, unchanged, absent) and the names of changed columns, for every key of either side."""
    changed = F.array_join(F.filter(F.array(*[F.when(~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")), F.lit(c)) for c in columns]), lambda x: x.isNotNull()), ",")
    action = F.when(F.col("o").isNull(), "insert").when(F.col("n").isNull(), "absent").when(changed == "", "unchanged").otherwise("update")
    key = [F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys]
    return _sides(old, new, keys).select(*key, action.alias("action"), F.when(action == "update", changed).otherwise("").alias("changed"))


def replace_children(old: DataFrame, new: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """The children of the touched parents are replaced by the new ones; other parents keep theirs."""
    return old.join(parents.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def mirror(old: DataFrame, snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """keys, fate (kept, added, removed) under a full snapshot; an empty snapshot changes nothing."""
    if snapshot.isEmpty():
        return old.select(*keys, F.lit("kept").alias("fate"))
    fate = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").otherwise("kept")
    return _sides(old, snapshot, keys).select(*[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys], fate.alias("fate"))


def number_new(rows: DataFrame, existing: DataFrame, id_column: str, order: list[str]) -> DataFrame:
    """New rows numbered on from the greatest id there is, in a total order; an empty table counts as 0.

    Numbers are dealt per range partition after a count of each, so no task sees more than its share.
    """
    top = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("m")).first().m
    return positions(rows, [], order, "_pos").select(*rows.columns, (F.col("_pos") + F.lit(top + 1)).alias(id_column))


def save_listing(cases: DataFrame, hearings: DataFrame, ledger: DataFrame, listed: DataFrame, keys: list[str], unit: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cases, hearings, ledger) after a listing is saved. listed: case columns, hearing columns and the unit (court and day) each row was listed under.

    Units that the ledger has are not saved again, so a listing run twice changes nothing. Of a case listed more than once in a run the
    first row counts (by unit, then all columns); a known case keeps what the listing does not say. Hearings are appended.
    """
    new = listed.join(ledger.select(*unit).distinct(), unit, "left_anti")
    order = [F.struct(*[F.col(c) for c in unit]), F.struct(*[F.col(c) for c in sorted(listed.columns)])]
    first = first_wins(new, keys, order).select(*[c for c in cases.columns if c in listed.columns])
    added = new.select(*[F.col(c) if c in new.columns else F.lit(None).cast(t).alias(c) for c, t in hearings.dtypes])
    return upsert(cases, first, keys), hearings.unionByName(added), ledger.select(*unit).unionByName(new.select(*unit)).distinct()


def save_details(cases: DataFrame, parties: DataFrame, details: DataFrame, found: DataFrame, keys: list[str], status: str, done: str, sidecar: str) -> tuple[DataFrame, DataFrame]:
    """(cases, parties) after details are saved: only known cases that are not done take them, all others stay as they are.

    Values that the details have replace the case's, the sidecar is merged key by key, the status becomes done, and the parties
    of the cases that took them are replaced by those found.
    """
    open_ = cases.where(~F.coalesce(F.col(status) == done, F.lit(False))).select(*keys)
    new = details.join(open_, keys, "left_semi")
    named = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in details.columns if c not in keys], F.lit(True).alias("_took"))
    joined = cases.join(named, keys, "left")
    took = F.coalesce("_took", F.lit(False))
    out = []
    for c in cases.columns:
        if c == status:
            out.append(F.when(took, F.lit(done)).otherwise(F.col(c)).alias(c))
        elif c == sidecar and c in details.columns:
            out.append(F.when(took, merged(F.col(c), F.col(f"_n_{c}"))).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) if c in details.columns and c not in keys else F.col(c))
    return joined.select(*out), replace_children(parties, found.join(new.select(*keys), keys, "left_semi"), new, keys)
