"""Data quality by rules that are data: masks, split, counts, rates.

Each rule becomes one boolean column; all are made in one projection, so the
valid rows, the quarantine and the counts share it.  A row that fails any rule
is quarantined.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit.functions.scalars import full_match, text_of

# Rule kinds as the data contracts name them (fixed values).
NOT_NULL, PATTERN, FOREIGN_KEY, RANGE, UNIQUE, SUM = "completude", "dominio", "referencial", "faixa", "unicidade", "consistencia"
KINDS = (NOT_NULL, PATTERN, FOREIGN_KEY, RANGE, UNIQUE, SUM)
log = logging.getLogger(__name__)
#: Patterns of known columns.
PATTERNS = {"id_municipio": r"\d{7}"}


@dataclass(frozen=True)
class Rule:
    id: str
    kind: str
    column: str | None = None
    columns: tuple[str, ...] = ()
    reference: str | None = None  #: ``table.column``
    pattern: str | None = None
    low: float = 0.0
    high: float = 100.0
    total: float = 100.0
    tolerance: float = 1.0
    description: str = ""


@dataclass(frozen=True)
class Checked:
    """``masked`` has every input row and one mask a rule; the rest derives from it."""

    masked: DataFrame
    rules: tuple[Rule, ...]
    quarantined_at: str

    def _mask(self, k: int) -> Column:
        return F.col(f"_fails_{k}")

    @property
    def _any(self) -> Column:
        return F.greatest(F.lit(False), F.lit(False), *[self._mask(k) for k in range(len(self.rules))])

    @property
    def _columns(self) -> list[str]:
        return [c for c in self.masked.columns if not c.startswith("_fails_")]

    @property
    def valid(self) -> DataFrame:
        return self.masked.where(~self._any).select(*self._columns)

    @property
    def quarantine(self) -> DataFrame:
        ids = F.concat_ws(",", *[F.when(self._mask(k), F.lit(r.id)) for k, r in enumerate(self.rules)])
        messages = F.concat_ws(" | ", *[F.when(self._mask(k), F.lit(r.description)) for k, r in enumerate(self.rules) if r.description])
        added = {"_quality_rule_ids": ids, "_quality_messages": messages, "_quarantined_at": F.lit(self.quarantined_at)}
        return self.masked.where(self._any).withColumns(added).select(*[c for c in self._columns if c not in added], *added)

    @property
    def counts(self) -> DataFrame:
        """``rule_id, failures``, one row a rule, from one aggregation."""
        if not self.rules:
            return self.masked.sparkSession.createDataFrame([], "rule_id string, failures long")
        one = self.masked.agg(*[F.count_if(self._mask(k)).alias(f"n{k}") for k in range(len(self.rules))])
        pairs = F.array(*[F.struct(F.lit(r.id).alias("rule_id"), F.col(f"n{k}").alias("failures")) for k, r in enumerate(self.rules)])
        return one.select(F.inline(pairs))

    @property
    def totals(self) -> DataFrame:
        """``input_rows, quarantined_rows, pass_rate``; the rate of no rows is 1."""
        one = self.masked.agg(F.count(F.lit(1)).alias("input_rows"), F.count_if(self._any).alias("quarantined_rows"))
        return one.withColumn("pass_rate", pass_rate(F.col("input_rows") - F.col("quarantined_rows"), F.col("quarantined_rows")))

    @property
    def failures_in_quarantine(self) -> dict[str, Column]:
        """What to count of :attr:`quarantine`, which has every failing row, while it
        is written: the failures of each rule (equal ids are one rule)."""
        ids = F.split("_quality_rule_ids", ",")
        return {r.id: F.count_if(F.array_contains(ids, r.id)) for r in self.rules}


@dataclass(frozen=True)
class Written:
    """What the passes that wrote valid rows and quarantine counted."""

    valid_rows: int
    quarantined_rows: int
    failures: dict[str, int]


def written(checked: Checked, valid: dict[str, int], quarantine: dict[str, int]) -> Written:
    """From the counts of both passes; the quarantine's are ``rows`` and
    :attr:`Checked.failures_in_quarantine`."""
    return Written(valid["rows"], quarantine["rows"], {r.id: quarantine[r.id] for r in checked.rules})


def metrics_of(spark: SparkSession, written: dict[str, Written]) -> DataFrame:
    """``entity, valid_rows, quarantined_rows, pass_rate`` without reading any row."""
    rows = spark.createDataFrame([(e, w.valid_rows, w.quarantined_rows) for e, w in written.items()], "entity string, valid_rows long, quarantined_rows long")
    return rows.withColumn("pass_rate", pass_rate(F.col("valid_rows"), F.col("quarantined_rows")))


def failures_of(spark: SparkSession, written: dict[str, Written]) -> DataFrame:
    """``entity, rule_id, failures`` without reading any row."""
    return spark.createDataFrame([(e, r, n) for e, w in written.items() for r, n in w.failures.items()], "entity string, rule_id string, failures long")


def pass_rate(valid: Column, quarantined: Column) -> Column:
    return F.coalesce(F.try_divide(valid.cast("double"), valid + quarantined), F.lit(1.0))


def check(df: DataFrame, rules: Iterable[Rule], references: dict[str, DataFrame] | None = None, quarantined_at: str = "", kinds: tuple[str, ...] | None = None) -> Checked:
    """Masks of all rules over ``df``.

    Not null, pattern, and foreign key on an absent column fail every row; a
    range or sum on absent columns, a foreign key without its reference table,
    a pattern rule on a column without pattern, a rule without columns and an
    unknown kind fail none; the last two are logged as warnings.  ``kinds`` limits
    which kinds act.
    """
    references, rules = references or {}, tuple(rules)
    for rule in rules:
        if rule.kind not in KINDS:
            log.warning("rule %s has the unknown kind %s and fails no row", rule.id, rule.kind)
        elif not _columns(rule):
            log.warning("rule %s names no column and fails no row", rule.id)
    masks: dict[str, Column] = {}
    out = df
    joined: dict[tuple[str, str], str] = {}
    for k, rule in enumerate(rules):
        active = kinds is None or rule.kind in kinds
        if active and rule.kind == FOREIGN_KEY and rule.column in df.columns and rule.reference:
            table, _, key = rule.reference.partition(".")
            if table in references and key in references[table].columns:
                marker = joined.get((rule.column, rule.reference))
                if marker is None:
                    marker = joined[(rule.column, rule.reference)] = f"_fails_key_{len(joined)}"
                    known = references[table].select(F.col(key).cast("string").alias(f"{marker}_k")).where(F.col(f"{marker}_k").isNotNull()).distinct()
                    known, own = known.withColumns({marker: F.lit(True), f"{marker}_h": F.hash(f"{marker}_k")}), F.col(rule.column).cast("string")
                    # With the hash beside the key, the join shuffles both sides itself, and only such shuffles does AQE split where a key is hot.
                    out = out.join(known, (own == F.col(f"{marker}_k")) & (F.hash(own) == F.col(f"{marker}_h")), "left")
                masks[f"_fails_{k}"] = F.col(rule.column).isNotNull() & F.col(marker).isNull()
                continue
        if active and rule.kind == UNIQUE and (keys := _columns(rule)) and all(c in df.columns for c in keys):
            # Keys that repeat, counted before the shuffle, meet the rows; no task gets all rows of a key at once.
            marker = f"_fails_key_u{k}"
            again = df.groupBy(*[F.col(c).alias(f"{marker}_{i}") for i, c in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
            again = again.withColumns({marker: F.lit(True), f"{marker}_h": F.hash(*[f"{marker}_{i}" for i in range(len(keys))])})
            same = F.hash(*keys) == F.col(f"{marker}_h")  # as above
            for i, c in enumerate(keys):
                same = same & F.col(c).eqNullSafe(F.col(f"{marker}_{i}"))
            out = out.join(again, same, "left")
            masks[f"_fails_{k}"] = F.col(marker).isNotNull()
            continue
        masks[f"_fails_{k}"] = F.coalesce(_mask(df, rule), F.lit(False)) if active else F.lit(False)
    out = out.withColumns(masks) if masks else out
    helpers = [c for c in out.columns if c.startswith("_fails_key_")]
    return Checked(out.drop(*helpers), rules, quarantined_at)


def _columns(rule: Rule) -> tuple[str, ...]:
    return rule.columns or ((rule.column,) if rule.column else ())


def _mask(df: DataFrame, rule: Rule) -> Column:
    columns = _columns(rule)
    if not columns:
        return F.lit(False)
    present = all(c in df.columns for c in columns)
    if rule.kind == NOT_NULL:
        return F.col(columns[0]).isNull() if present else F.lit(True)
    if rule.kind == PATTERN:
        pattern = rule.pattern or PATTERNS.get(columns[0])
        if not present:
            return F.lit(True)
        if not pattern:
            return F.lit(False)
        return (text_of(columns[0]) != "") & ~full_match(columns[0], pattern)
    if rule.kind == FOREIGN_KEY:
        return F.lit(not present)
    if rule.kind == RANGE and present:
        x = F.col(columns[0]).try_cast("double")
        return ~F.isnan(x) & ~x.between(rule.low, rule.high)
    if rule.kind == SUM and present:
        total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
        return F.abs(total - rule.total) > rule.tolerance
    return F.lit(False)


def coverage(df: DataFrame, official: str) -> DataFrame:
    """Rows without an official value: a warning, never quarantined."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(official).isNull()).alias("without_target"))


def metrics(results: dict[str, Checked]) -> DataFrame:
    """``entity, valid_rows, quarantined_rows, pass_rate``, one row an entity."""
    out = None
    for entity, checked in results.items():
        one = checked.totals.select(F.lit(entity).alias("entity"), (F.col("input_rows") - F.col("quarantined_rows")).alias("valid_rows"), "quarantined_rows", "pass_rate")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no results")
    return out
