"""Data-quality rules compiled into a single aggregation pass.

Rules are declared with a fluent builder.  One predicate per rule says whether a
row fails; ``check`` counts it with ``count_if`` and ``row_failures`` lists it.  All
counts are taken per key of the first uniqueness rule and then summed, so one scan
and one shuffle give them together (partial aggregation; skew-safe); each further
uniqueness rule is its own ``groupBy(keys).count()``.  The wide one-row result is
exploded into one report row per rule.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import blank, with_scalars
from strata.functions.numeric import ratio_round

# fixed values: layer gates (bronze→silver, silver→gold)
LAYER_GATES = {
    "bronze_to_silver": {"completeness": 0.95, "accuracy": 0.98, "uniqueness": 1.0, "timeliness_hours": 24},
    "silver_to_gold": {"completeness": 0.98, "accuracy": 0.99, "uniqueness": 1.0, "timeliness_hours": 4},
}


@dataclass
class Rule:
    name: str
    dimension: str
    column: str | None
    threshold: float
    severity: str
    params: dict = field(default_factory=dict)


class QualityChecker:
    def __init__(self) -> None:
        self.rules: list[Rule] = []

    def add_completeness_rule(self, column: str, threshold: float = 0.95, severity: str = "error"):
        self.rules.append(Rule(f"completeness_{column}", "completeness", column, threshold, severity))
        return self

    def add_accuracy_rule(self, column: str, min_value=None, max_value=None, pattern: str | None = None,
                          allowed_values: list | None = None, threshold: float = 0.98, severity: str = "error"):
        self.rules.append(Rule(f"accuracy_{column}", "accuracy", column, threshold, severity,
                               dict(min_value=min_value, max_value=max_value, pattern=pattern,
                                    allowed_values=allowed_values)))
        return self

    def add_uniqueness_rule(self, columns: list[str], threshold: float = 1.0, severity: str = "error"):
        self.rules.append(Rule(f"uniqueness_{'_'.join(columns)}", "uniqueness", ",".join(columns),
                               threshold, severity, dict(keys=list(columns))))
        return self

    def add_timeliness_rule(self, column: str, max_age_hours: float = 24, threshold: float = 0.95,
                            severity: str = "warning"):
        self.rules.append(Rule(f"timeliness_{column}", "timeliness", column, threshold, severity,
                               dict(max_age_hours=max_age_hours)))
        return self

    def add_consistency_rule(self, column_a: str, column_b: str, relationship: str = "a_lte_b",
                             threshold: float = 0.98, severity: str = "warning"):
        self.rules.append(Rule(f"consistency_{column_a}_vs_{column_b}", "consistency", column_a,
                               threshold, severity, dict(a=column_a, b=column_b, rel=relationship)))
        return self

    # ------------------------------------------------------------------
    def _predicate(self, df: DataFrame, r: Rule, as_of: _dt.datetime,
                   hours: float | None = None) -> tuple[Column, Column | None]:
        """(row fails the rule, row counts for it or None: every row); never null.

        Report and row routing both read it.  A missing column or a rule that does
        not compile fails every row."""
        fails = F.lit(True)
        needed = [r.params["a"], r.params["b"]] if r.dimension == "consistency" else [r.column]
        if any(c not in df.columns for c in needed):
            return fails, None
        c = F.col(needed[0])
        if r.dimension == "consistency":
            x, y = c.try_cast("double"), F.col(needed[1]).try_cast("double")
            bad = {"a_lte_b": x > y, "a_gte_b": x < y, "a_equals_b": x != y}.get(r.params["rel"], F.lit(False))
            both = x.isNotNull() & y.isNotNull()
            return F.coalesce(both & bad, F.lit(False)), both
        if r.dimension == "completeness":
            return blank(c), None
        if r.dimension == "accuracy":
            p, ok, num = r.params, F.lit(True), c.try_cast("double")
            if p.get("min_value") is not None:
                ok = ok & F.coalesce(num >= F.lit(p["min_value"]), F.lit(False))
            if p.get("max_value") is not None:
                ok = ok & F.coalesce(num <= F.lit(p["max_value"]), F.lit(False))
            if p.get("allowed_values"):
                ok = ok & F.coalesce(c.isin(list(p["allowed_values"])), F.lit(False))
            if p.get("pattern"):
                try:
                    re.compile(p["pattern"])
                except re.error:
                    return fails, None
                ok = ok & F.coalesce(c.cast("string").rlike("^(?:" + p["pattern"] + ")"), F.lit(False))
            return c.isNotNull() & ~ok, None
        if r.dimension == "timeliness":
            cutoff = _cutoff(as_of, hours or r.params["max_age_hours"])
            return F.coalesce(_timestamp(df, r.column) < cutoff, F.lit(False)), None
        raise ValueError(r.dimension)

    def _broken(self, df: DataFrame, r: Rule) -> bool:
        """The rule's column is missing or its pattern does not compile: score 0, also on empty input."""
        if r.dimension == "uniqueness":
            return not [k for k in r.params["keys"] if k in df.columns]
        needed = [r.params["a"], r.params["b"]] if r.dimension == "consistency" else [r.column]
        if any(c not in df.columns for c in needed):
            return True
        try:
            re.compile(r.params.get("pattern") or "")
        except re.error:
            return True
        return False

    def check(self, df: DataFrame, dataset_name: str, layer: str = "silver",
              as_of: _dt.datetime | None = None, transition: str | None = None) -> DataFrame:
        """One row per rule: rule_name, dimension, column, score (4 dp), passed,
        threshold, severity, total_records, failed_records (+ dataset, layer)."""
        as_of = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        spark = df.sparkSession
        hours = LAYER_GATES[transition]["timeliness_hours"] if transition else None
        if not self.rules:
            return spark.createDataFrame([], "rule_name string")
        # with one uniqueness rule every rule's counts are first taken per key, then
        # summed: one scan and one shuffle serve all of them
        unique = [r for r in self.rules if r.dimension == "uniqueness" and not self._broken(df, r)]
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, r in enumerate(self.rules):
            if r.dimension == "uniqueness":
                continue
            failed, counts = self._predicate(df, r, as_of, hours)
            aggs += [F.count_if(failed).alias(f"_f{i}"),
                     (F.count_if(counts) if counts is not None else F.count(F.lit(1))).alias(f"_d{i}")]
        if unique:
            keys = [k for k in unique[0].params["keys"] if k in df.columns]
            per = df.groupBy(*keys).agg(*aggs)
            again = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in per.columns[len(keys):]]
            wide = per.agg(*again, F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(f"_f{self.rules.index(unique[0])}"))
        else:
            wide = df.agg(*aggs)
        for r in unique[1:]:
            i = self.rules.index(r)
            keys = [k for k in r.params["keys"] if k in df.columns]
            per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_k"))
            wide = with_scalars(wide, per.agg(F.coalesce(F.sum(F.col("_k") - 1), F.lit(0)).alias(f"_f{i}")))
        structs = []
        for i, r in enumerate(self.rules):
            have = wide.columns
            failed = F.col(f"_f{i}") if f"_f{i}" in have else F.col("_n")
            den = F.col(f"_d{i}") if f"_d{i}" in have else F.col("_n")
            structs.append(self._result(r, failed, den, self._broken(df, r)))
        return wide.select(F.inline(F.array(*structs))).select(
            F.lit(dataset_name).alias("dataset_name"), F.lit(layer).alias("layer"), "*")

    def partial_counts(self, df: DataFrame, as_of: _dt.datetime) -> DataFrame:
        """(rule, key, failed, counted): what a part of a dataset adds to the report; a
        uniqueness rule gives one row per key, whose ``counted`` are its rows."""
        schema = "rule int, key string, failed bigint, counted bigint"
        aggs, rows, parts = [F.count(F.lit(1)).alias("_n")], [], []
        for i, r in enumerate(self.rules):
            if r.dimension == "uniqueness" and not self._broken(df, r):
                keys = [c for c in r.params["keys"] if c in df.columns]
                parts.append(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("counted")).select(
                    F.lit(i).alias("rule"), F.to_json(F.struct(*keys)).alias("key"),
                    F.lit(0).cast("bigint").alias("failed"), "counted"))
                continue
            failed, counts = (F.lit(True), None) if r.dimension == "uniqueness" else self._predicate(df, r, as_of)
            aggs += [F.count_if(failed).alias(f"_f{i}"),
                     (F.count_if(counts) if counts is not None else F.count(F.lit(1))).alias(f"_d{i}")]
            rows.append(F.struct(F.lit(i).alias("rule"), F.lit("rule").alias("key"), F.col(f"_f{i}").alias("failed"),
                                 F.col(f"_d{i}").alias("counted")))
        rows.append(F.struct(F.lit(-1).alias("rule"), F.lit("rows").alias("key"), F.lit(0).cast("bigint").alias("failed"),
                             F.col("_n").alias("counted")))
        out = df.agg(*aggs).select(F.inline(F.array(*rows)))
        for p in parts:
            out = out.unionByName(p)
        return out.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")])

    def report_of(self, partials: DataFrame, columns: list[str], dataset_name: str, layer: str) -> DataFrame:
        """The report from the rows of ``partial_counts`` of all parts."""
        shape = partials.sparkSession.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
        per_key = partials.groupBy("rule", "key").agg(F.sum("failed").alias("failed"), F.sum("counted").alias("counted"))
        per_rule = per_key.groupBy("rule").agg(F.sum("failed").alias("failed"), F.sum("counted").alias("counted"),
                                               F.sum(F.col("counted") - 1).alias("repeats"))
        pick = lambda i, c: F.coalesce(F.max(F.when(F.col("rule") == i, F.col(c))), F.lit(0))
        aggs, structs = [pick(-1, "counted").alias("_n")], []
        for i, r in enumerate(self.rules):
            unique = r.dimension == "uniqueness" and not self._broken(shape, r)
            aggs += [pick(i, "repeats" if unique else "failed").alias(f"_f{i}"), pick(i, "counted").alias(f"_d{i}")]
            structs.append(self._result(r, F.col(f"_f{i}"), F.col(f"_d{i}"), self._broken(shape, r)))
        return per_rule.agg(*aggs).select(F.inline(F.array(*structs))).select(
            F.lit(dataset_name).alias("dataset_name"), F.lit(layer).alias("layer"), "*")

    def sample_failures(self, df: DataFrame, k: int = 5) -> DataFrame:
        """For each uniqueness rule the k smallest repeated keys (JSON) with their row counts."""
        out = df.sparkSession.createDataFrame([], "rule_name string, key string, rows bigint")
        for r in self.rules:
            if r.dimension == "uniqueness" and not self._broken(df, r):
                keys = [c for c in r.params["keys"] if c in df.columns]
                out = out.unionByName(
                    df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
                    .select(F.lit(r.name).alias("rule_name"), F.to_json(F.struct(*keys)).alias("key"), "rows")
                    .orderBy("key").limit(k))
        return out

    def row_failures(self, df: DataFrame, as_of: _dt.datetime, arrival: list[str] | None = None,
                     within: list[str] | None = None) -> DataFrame:
        """Row-level routing for the layer gate: ``_dq_failures`` lists the rules a
        row fails (rule order), ``_dq_passed`` is true when it fails none.

        The same predicates as ``check``; a uniqueness rule fails every arrival
        of a key after the first (``arrival`` orders them, skew-safe flag; ``within`` names
        columns that the keys of every such rule determine, see ``with_duplicate_flag``);
        a rule on a missing column fails every row."""
        from strata.operators.rules import with_duplicate_flag
        cols = set(df.columns)
        out = df
        checks: list[tuple[Column, str]] = []
        for i, r in enumerate(self.rules):
            if r.dimension == "uniqueness":
                keys = [k for k in r.params["keys"] if k in cols]
                if not keys:
                    checks.append((F.lit(True), r.name))
                    continue
                flag = f"_uq{i}"
                key_col = f"_uqk{i}"
                out = out.withColumn(key_col, F.to_json(F.struct(*[F.col(k) for k in keys])))
                out = with_duplicate_flag(out, key_col, arrival or list(df.columns), out=flag,
                                          within=within).drop(key_col)
                checks.append((F.col(flag), r.name))
                continue
            checks.append((self._predicate(df, r, as_of)[0], r.name))
        fails = F.filter(F.array(*[F.when(p, F.lit(n)) for p, n in checks]), lambda x: x.isNotNull())
        flags = [c for c in out.columns if c.startswith("_uq")]
        return out.withColumns({"_dq_failures": fails, "_dq_passed": F.size(fails) == 0}).drop(*flags)

    @staticmethod
    def _result(r: Rule, failed: Column, den: Column, broken: bool) -> Column:
        d = F.greatest(den, F.lit(1))
        raw = F.lit(0.0) if broken else 1.0 - failed / d
        return F.struct(F.lit(r.name).alias("rule_name"), F.lit(r.dimension).alias("dimension"),
                        F.lit(r.column).cast("string").alias("column"),
                        (F.lit(0.0) if broken else ratio_round(d - failed, d, 4)).alias("score"),
                        (raw >= F.lit(r.threshold)).alias("passed"),
                        F.lit(float(r.threshold)).alias("threshold"), F.lit(r.severity).alias("severity"),
                        F.col("_n").alias("total_records"), failed.cast("bigint").alias("failed_records"),
                        raw.alias("_raw_score"))


def _timestamp(df: DataFrame, column: str) -> Column:
    t = df.schema[column].dataType
    return F.try_to_timestamp(F.col(column)) if isinstance(t, T.StringType) else F.col(column).cast("timestamp")


def _cutoff(as_of: _dt.datetime, hours: float) -> Column:
    return F.lit(as_of).cast("timestamp") - F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours) * 3600))


def summary(report: DataFrame) -> DataFrame:
    """overall (unweighted mean, 0.0 with no rules), all_passed, rule counts."""
    return report.agg(
        F.first("dataset_name").alias("dataset_name"), F.first("layer").alias("layer"),
        F.max("total_records").alias("total_records"),
        F.round(F.coalesce(F.avg("_raw_score"), F.lit(0.0)), 4).alias("overall_score"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
        F.count(F.lit(1)).alias("rules_checked"),
        F.count_if("passed").alias("rules_passed"),
        F.count_if(~F.col("passed")).alias("rules_failed"))


def dimension_scores(report: DataFrame) -> DataFrame:
    return report.groupBy("dimension").agg(F.round(F.avg("_raw_score"), 4).alias("score"),
                                          F.count(F.lit(1)).alias("rules"))


def gate(report: DataFrame, transition: str = "bronze_to_silver") -> DataFrame:
    """Dimension scores against the layer gate.  A dimension without a share in the
    gate (consistency; timeliness, whose gate is an age) must reach its rules' own
    threshold; ``check(transition=...)`` judges row ages by the gate's hours."""
    shares = {k: v for k, v in LAYER_GATES[transition].items() if k != "timeliness_hours"}
    known = F.element_at(F.create_map(*[x for k, v in shares.items() for x in (F.lit(k), F.lit(float(v)))]),
                         F.col("dimension"))
    d = report.groupBy("dimension").agg(F.round(F.avg("_raw_score"), 4).alias("score"), F.max("threshold").alias("own"))
    least = F.coalesce(known, F.col("own"))
    return d.select("dimension", "score", least.alias("gate_threshold"),
                    (F.col("score") >= least).alias("gate_passed"), F.lit(transition).alias("transition"))
