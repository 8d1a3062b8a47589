"""References to records that do not exist, or that came later than the record naming them.

References are counted per key and period first (map-side combine), so the parents meet counted keys,
not rows. Keys holding a thousandth of all references or more are heavy; there can be no more than a
thousand of them, and they are checked by broadcast. The remaining keys are checked by a shuffled
anti-join, which no hot key enters, and the orphan counts of both are united. Rows are taken back by
the orphan keys, again by broadcast for the heavy and by shuffle for the others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarazu.session import cut

HEAVY_SHARE = 1000  # a key is heavy with 1/HEAVY_SHARE of the rows: at most HEAVY_SHARE keys


class Orphans:
    """The orphan references of child, counted, and the rows they stand for.

    missing: no parent has exactly this key; a null in any part of the key is missing too.
    late: the parent's first created time is later than the row's. Rows whose own time is null can
    be missing, with a null month, but not late. Repeated child rows count and come out repeated.
    Columns of child and parent may clash: only those named are read. Empty tables give empty results.
    """

    def __init__(self, child: DataFrame, key: list[str], created: str, record_key: Column, parent: DataFrame, parent_key: list[str], parent_created: str):
        self.names = names = [f"_k{i}" for i in range(len(key))]
        month = F.date_format("_at", "yyyy-MM").alias("created_month")
        self.rows = child.select(*[F.col(c).alias(n) for c, n in zip(key, names)], F.col(created).alias("_at"), record_key.alias("record_key")).select("*", month)
        firsts = parent.select(*[F.col(c).alias(n) for c, n in zip(parent_key, names)], F.col(parent_created).alias("_p")).groupBy(*names).agg(F.min("_p").alias("_first"))
        # the counted references are written once: their sum says which keys are heavy
        refs = cut(self.rows.groupBy(*names, "created_month").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_earliest"), F.max("_at").alias("_latest")))
        total = refs.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first().n
        self.heavy_keys = refs.groupBy(*names).agg(F.sum("_n").alias("_n")).where(F.col("_n") * HEAVY_SHARE >= total).select(*names)
        heavy = refs.join(F.broadcast(self.heavy_keys), names)
        light = refs.join(F.broadcast(self.heavy_keys), names, "left_anti")
        heavy_firsts = F.broadcast(firsts.join(F.broadcast(self.heavy_keys), names))
        # a null in the key equals nothing, so it stays in either anti-join
        self.heavy = self._verdicts(heavy, heavy_firsts)
        self.light = self._verdicts(light, firsts)

    def _verdicts(self, refs: DataFrame, firsts: DataFrame) -> DataFrame:
        """The orphan references among refs: keys, created_month, _n, _first (null if missing), _whole: all _n of them are orphans."""
        cols = [*self.names, "created_month", "_n"]
        none = F.lit(None).cast(firsts.schema["_first"].dataType)
        missing = refs.join(firsts.select(*self.names), self.names, "left_anti").select(*cols, none.alias("_first"), F.lit(True).alias("_whole"))
        late = refs.join(firsts, self.names).where(F.col("_first") > F.col("_earliest"))
        return missing.unionByName(late.select(*cols, "_first", (F.col("_first") > F.col("_latest")).alias("_whole")))

    def _rows_of(self, heavy: DataFrame, light: DataFrame, on: list[str]) -> DataFrame:
        """created_month, orphan_kind and record_key of the rows that heavy and light name, one line for each of on; of late ones those before their parent."""
        keyed = self.rows.dropna(subset=self.names)
        parts = [keyed.join(F.broadcast(heavy), on), keyed.join(F.broadcast(self.heavy_keys), self.names, "left_anti").join(light, on)]
        kind = F.when(F.col("_first").isNull(), "missing").otherwise("late")
        some = parts[0].unionByName(parts[1]).where(F.col("_first").isNull() | (F.col("_first") > F.col("_at")))
        return some.select("record_key", "created_month", kind.alias("orphan_kind"))

    def found(self) -> DataFrame:
        """record_key, created_month (YYYY-MM), orphan_kind of each row without its parent."""
        once = [d.groupBy(*self.names).agg(F.max("_first").alias("_first")) for d in (self.heavy, self.light)]
        null_key = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in self.names])
        nulls = self.rows.where(null_key).select("record_key", "created_month", F.lit("missing").alias("orphan_kind"))
        return self._rows_of(*once, self.names).unionByName(nulls)

    def counts(self) -> DataFrame:
        """created_month, orphan_kind, n_records: the counted references of heavy and light keys united.

        Rows are read again only for the one period of a key within which its parent came.
        """
        kind = F.when(F.col("_first").isNull(), "missing").otherwise("late").alias("orphan_kind")
        whole = [d.where("_whole").select("created_month", kind, "_n") for d in (self.heavy, self.light)]
        split = [d.where("NOT _whole").select(*self.names, "created_month", "_first") for d in (self.heavy, self.light)]
        mixed = self._rows_of(*split, [*self.names, "created_month"]).select("created_month", "orphan_kind", F.lit(1).cast("long").alias("_n"))
        return whole[0].unionByName(whole[1]).unionByName(mixed).groupBy("created_month", "orphan_kind").agg(F.sum("_n").alias("n_records"))


def court_references(entities: DataFrame, cases: DataFrame, courts: DataFrame) -> dict[str, Orphans]:
    """The parties' references to cases and the cases' to courts. A repeated case counts once, with its first created time."""
    key = ["case_number", "court_identifier"]
    once = cases.groupBy(*key).agg(F.min("created_at").alias("created_at"))
    case_key = F.concat(F.coalesce("case_number", F.lit("")), F.lit("@"), F.coalesce("court_identifier", F.lit("")))
    return {
        "court_case_entities": Orphans(entities, key, "created_at", F.col("id").cast("string"), cases, key, "created_at"),
        "court_cases": Orphans(once, ["court_identifier"], "created_at", case_key, courts, ["identifier"], "created_at"),
    }


def court_orphans(entities: DataFrame, cases: DataFrame, courts: DataFrame) -> DataFrame:
    """table_name, record_key, created_month, orphan_kind of parties without their case and cases without their court."""
    parts = [o.found().select(F.lit(n).alias("table_name"), "record_key", "created_month", "orphan_kind") for n, o in court_references(entities, cases, courts).items()]
    return parts[0].unionByName(parts[1])


def court_orphan_counts(entities: DataFrame, cases: DataFrame, courts: DataFrame) -> DataFrame:
    """table_name, created_month, orphan_kind, n_records per table and period."""
    parts = [o.counts().select(F.lit(n).alias("table_name"), "created_month", "orphan_kind", "n_records") for n, o in court_references(entities, cases, courts).items()]
    return parts[0].unionByName(parts[1])
