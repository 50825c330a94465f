"""Row validation, good/bad split, summary, quarantine, fail-job gate, status.

One validation is one plan: set rules (``unique``, ``foreign_key``) find their
violating keys in a pass over the key columns alone and add a flag through one
join per column set (see ``key_sets``); all row rules, the action text and the
verdict are then computed in a single ``select``.  Every derived output
(good rows, bad rows, summary, counts) is a filter or aggregate of that one
tagged frame.  ``Validation.materialize`` writes the tagged rows once, with
the summary collected by ``observe`` during the same write, so the input is
read a single time however many outputs are used.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corral.functions.rules import FAILJOB, QUARANTINE, Rule, RowRule
from corral.operators.key_sets import Keep, attach_flags, keep_in_scratch

# Fixed schema of the validation summary (as stored by the reference).
SUMMARY_SCHEMA = StructType(
    [
        StructField("Strategy", StringType(), True),
        StructField("Check", StringType(), True),
        StructField("Column", StringType(), True),
        StructField("Status", StringType(), True),
        StructField("Impacted_Records", LongType(), True),
        StructField("Action_Taken", StringType(), True),
    ]
)

# Fixed texts of the overall DQ status.
STATUS_PASSED_QUARANTINE = "Passed with Quarantine Data"
STATUS_FAILED_QUARANTINE = "Failed with Quarantine Data"
STATUS_FAILED_NO_QUARANTINE = "Failed with No Quarantine Data"
STATUS_PASSED_NO_QUARANTINE = "Passed with No Quarantine Data"
#: By (rows were quarantined, the job failed).
STATUSES = {
    (True, False): STATUS_PASSED_QUARANTINE,
    (True, True): STATUS_FAILED_QUARANTINE,
    (False, True): STATUS_FAILED_NO_QUARANTINE,
    (False, False): STATUS_PASSED_NO_QUARANTINE,
}

ACTION = "action"
VERDICT = "dq_verdict"  # 'good' / 'bad' partition value of a materialized validation
_FLAG = "__dq_v{}"
_BAD = "__dq_bad"


def _flag(i: int) -> str:
    return _FLAG.format(i)


class Validation:
    """Lazy result of checking ``df`` against ``rules``."""

    def __init__(self, df: DataFrame, rules: Sequence[Rule], keep: Keep = keep_in_scratch):
        self.source = df
        self.keep = keep  # where the violating keys of set rules are staged
        self.rules = list(rules)
        self.columns = list(df.columns)
        self._tagged: DataFrame | None = None

    # -- the one tagged frame -------------------------------------------------
    @property
    def tagged(self) -> DataFrame:
        """Input columns + one boolean per rule + ``action`` + verdict flag."""
        if self._tagged is None:
            set_rules = [(_flag(i), r) for i, r in enumerate(self.rules) if not isinstance(r, RowRule)]
            df = attach_flags(self.source, set_rules, self.keep)
            flags = []
            for i, rule in enumerate(self.rules):
                if isinstance(rule, RowRule):
                    flags.append(rule.violation().alias(_flag(i)))
                else:
                    flags.append(F.col(_flag(i)))
            df = df.select(*[F.col(c) for c in self.columns], *flags)
            self._tagged = df.select("*", self._action_text().alias(ACTION), self._any(lambda r: r.blocks).alias(_BAD))
        return self._tagged

    def _any(self, pick) -> Column:
        """OR of the flags of the rules chosen by ``pick`` (False if none)."""
        out = F.lit(False)
        for i, r in enumerate(self.rules):
            if pick(r):
                out = out | F.col(_flag(i))
        return out

    def _action_text(self) -> Column:
        """Actions of the violated rules joined by commas, in rule order, an
        action repeated by a later rule kept at its first place; null when no
        violated rule has an action.  Plain boolean logic and ``concat_ws``,
        so it stays inside generated code."""
        parts = []
        for i, r in enumerate(self.rules):
            if r.action is None:
                continue
            fired = F.col(_flag(i))
            for j in range(i):
                if self.rules[j].action == r.action:
                    fired = fired & ~F.col(_flag(j))
            parts.append(F.when(fired, F.lit(r.action)))
        if not parts:
            return F.lit(None).cast("string")
        return F.nullif(F.concat_ws(",", *parts), F.lit(""))

    def _has_action(self, word: str) -> Column:
        """Erroneous and some violated rule's action names ``word`` — the same
        as matching ``word`` in the action text, without building the text."""
        return F.col(_BAD) & self._any(lambda r: r.action is not None and word in r.action)

    # -- derived outputs ------------------------------------------------------
    @property
    def correct_data(self) -> DataFrame:
        return self.tagged.where(~F.col(_BAD)).select(*self.columns)

    @property
    def erroneous_data(self) -> DataFrame:
        return self.tagged.where(F.col(_BAD)).select(*self.columns, ACTION)

    def _count_exprs(self) -> list[Column]:
        return [F.count_if(F.col(_flag(i))).alias(f"n{i}") for i in range(len(self.rules))]

    @property
    def summary(self) -> DataFrame:
        """One row per rule with the fixed summary schema; one aggregate job."""
        spark = self.source.sparkSession
        if not self.rules:
            return spark.createDataFrame([], SUMMARY_SCHEMA)
        counts = self.tagged.agg(*self._count_exprs())
        return counts.select(F.inline(F.array(*[_summary_struct(r, F.col(f"n{i}")) for i, r in enumerate(self.rules)])))

    def counts(self) -> DataFrame:
        """source_count, target_count (good rows), quarantined_count, fail_job_count."""
        return self.tagged.agg(
            F.count(F.lit(1)).alias("source_count"),
            F.count_if(~F.col(_BAD)).alias("target_count"),
            F.count_if(self._has_action(QUARANTINE)).alias("quarantined_count"),
            F.count_if(self._has_action(FAILJOB)).alias("fail_job_count"),
        )

    # -- write once -----------------------------------------------------------
    def materialize(
        self,
        location: str | None = None,
        stage=None,
        kind: str = "dq",
        extra_metrics: Sequence[Column] = (),
    ) -> "MaterializedValidation":
        """Write the tagged rows once, partitioned by verdict, and collect the
        per-rule counts, the good-row count and the quarantine and fail-job
        counts with ``observe`` in the same job.  Writes to a parquet
        ``location`` or to ``stage`` (a ``corral.sources.stage.Stage``).
        ``extra_metrics`` are more named aggregates over the input rows to
        collect in the same pass (e.g. ``profile.simple_metrics``); they are
        in ``metrics`` by name."""
        obs = Observation("dq_counts")
        exprs = self._count_exprs() + [
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~F.col(_BAD)).alias("good_rows"),
            F.count_if(self._has_action(QUARANTINE)).alias("quarantined_rows"),
            F.count_if(self._has_action(FAILJOB)).alias("failjob_rows"),
        ] + list(extra_metrics)
        out = self.tagged.observe(obs, *exprs).select(
            *self.columns,
            ACTION,
            F.when(F.col(_BAD), F.lit("bad")).otherwise(F.lit("good")).alias(VERDICT),
        )
        if stage is not None:
            stage.save(kind, out, partition_by=[VERDICT])
            reader = lambda: stage.load(kind)
        elif location is not None:
            out.write.mode("overwrite").partitionBy(VERDICT).parquet(location)
            spark = self.source.sparkSession
            reader = lambda: spark.read.parquet(location)
        else:
            raise ValueError("materialize needs a location or a stage")
        return MaterializedValidation(self, reader, obs.get)


def _summary_struct(rule: Rule, n: Column) -> Column:
    return F.struct(
        F.lit(rule.strategy).alias("Strategy"),
        F.lit(rule.check).alias("Check"),
        F.lit(rule.column).alias("Column"),
        F.when(n == 0, F.lit("Passed")).otherwise(F.lit("Failed")).alias("Status"),
        n.cast("bigint").alias("Impacted_Records"),
        F.lit(rule.action).cast("string").alias("Action_Taken"),
    )


@dataclass
class MaterializedValidation:
    """A validation written once; outputs are partition-pruned reads."""

    validation: Validation
    reader: Callable[[], DataFrame]
    metrics: dict

    @property
    def _spark(self) -> SparkSession:
        return self.validation.source.sparkSession

    def _read(self) -> DataFrame:
        return self.reader()

    @property
    def correct_data(self) -> DataFrame:
        return self._read().where(F.col(VERDICT) == "good").select(*self.validation.columns)

    @property
    def erroneous_data(self) -> DataFrame:
        return self._read().where(F.col(VERDICT) == "bad").select(*self.validation.columns, ACTION)

    @property
    def good_count(self) -> int:
        return int(self.metrics["good_rows"])

    @property
    def row_count(self) -> int:
        return int(self.metrics["rows"])

    @property
    def quarantined_count(self) -> int:
        return int(self.metrics["quarantined_rows"])

    @property
    def failjob_count(self) -> int:
        return int(self.metrics["failjob_rows"])

    @property
    def status(self) -> str:
        """The DQ status text from the observed quarantine and fail-job counts."""
        return STATUSES[self.quarantined_count > 0, self.failjob_count > 0]

    @property
    def summary(self) -> DataFrame:
        """Built from the observed counts: one small row per rule."""
        rows = [
            (
                r.strategy,
                r.check,
                r.column,
                "Passed" if int(self.metrics[f"n{i}"]) == 0 else "Failed",
                int(self.metrics[f"n{i}"]),
                r.action,
            )
            for i, r in enumerate(self.validation.rules)
        ]
        return self._spark.createDataFrame(rows, SUMMARY_SCHEMA)


def validate(df: DataFrame, rules: Sequence[Rule], keep: Keep = keep_in_scratch) -> Validation:
    return Validation(df, rules, keep)


# --------------------------------------------------------------------------
# Quarantine, gate, status
# --------------------------------------------------------------------------


class DataQualityStop(RuntimeError):
    """Raised when a rule with action ``failjob`` was violated."""


def quarantine_rows(erroneous: DataFrame) -> DataFrame:
    """Erroneous rows whose action names quarantine, without the action."""
    return erroneous.where(F.col(ACTION).rlike(QUARANTINE)).drop(ACTION)


def failjob_gate(erroneous: DataFrame) -> DataFrame:
    """One row: fail_job_count and blocked (count > 0)."""
    n = F.count_if(F.coalesce(F.col(ACTION).rlike(FAILJOB), F.lit(False)))
    return erroneous.agg(n.alias("fail_job_count")).select(
        "fail_job_count", (F.col("fail_job_count") > 0).alias("blocked")
    )


def enforce_failjob_gate(erroneous: DataFrame) -> int:
    """Raise ``DataQualityStop`` when any row carries ``failjob``; else 0."""
    n = failjob_gate(erroneous).first()["fail_job_count"]
    if n:
        raise DataQualityStop(f"Data not loaded to target: {n} rows have action failjob")
    return 0


def status_text(quarantined: Column, failed: Column) -> Column:
    """The four DQ status texts from (quarantined > 0) x (job failed)."""
    cases = [F.when(((quarantined > 0) == q) & (failed == f), F.lit(text)) for (q, f), text in STATUSES.items()]
    return F.coalesce(*cases)


def execution_status(validation: Validation, configured_failjob: bool | None = None) -> DataFrame:
    """Overall DQ status from what happened: the quarantined count and the
    fail-job count.  ``configured_failjob`` reproduces the stored-setting
    reading (status "Failed" when any rule *may* fail the job)."""
    c = validation.counts()
    failed = F.col("fail_job_count") > 0 if configured_failjob is None else F.lit(bool(configured_failjob))
    return c.select(status_text(F.col("quarantined_count"), failed).alias("dq_status"))


def ticket_flag(rule_settings: Sequence[dict]) -> str:
    """'Yes' when any stored rule setting asks for a ticket."""
    return "Yes" if any(bool(s.get("ticket")) for s in rule_settings) else "No"
