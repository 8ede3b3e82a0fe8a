"""Data-quality rules as Column expressions, evaluated in one pass.

A rule is TRUE, FALSE or NULL for a row. What NULL means is stated per rule, so no row can fall
between the valid and the quarantined side unnoticed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

# The rule categories.
NOT_NULL = "NOT_NULL"
RANGE_CHECK = "RANGE_CHECK"
SCHEMA_VALIDATION = "SCHEMA_VALIDATION"
BUSINESS_RULE = "BUSINESS_RULE"
REFERENTIAL_INTEGRITY = "REFERENTIAL_INTEGRITY"
RULE_TYPES = (NOT_NULL, RANGE_CHECK, SCHEMA_VALIDATION, BUSINESS_RULE, REFERENTIAL_INTEGRITY)

FAILED = "_failed_rules"
UNDECIDED = "_undecided"


@dataclass(frozen=True)
class Rule:
    """``check`` is TRUE for a good row. ``on_null``: "fail", "pass" or "drop".

    "drop" keeps a row whose only shortcoming is a NULL verdict out of both sides. It exists to compare
    with filters written as ``check`` and ``NOT check``, which lose such rows.
    """

    name: str
    kind: str
    check: Column
    on_null: str = "fail"

    def __post_init__(self):
        if self.kind not in RULE_TYPES or self.on_null not in ("fail", "pass", "drop"):
            raise ValueError(f"unknown rule type or null policy: {self.kind}, {self.on_null}")

    @property
    def passed(self) -> Column:
        return F.coalesce(self.check, F.lit(self.on_null != "fail"))


def not_null(*cols: str, name: str | None = None) -> Rule:
    check = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return Rule(name or "NOT_NULL_" + "_".join(cols).upper(), NOT_NULL, check)


def in_range(col: str, low=None, high=None, name: str | None = None, on_null="fail") -> Rule:
    """Closed range; either bound may be left out."""
    bounds = []
    if low is not None:
        bounds.append(F.col(col) >= low)
    if high is not None:
        bounds.append(F.col(col) <= high)
    return Rule(
        name or f"VALID_{col.upper()}_RANGE", RANGE_CHECK, reduce(lambda a, b: a & b, bounds), on_null
    )


def in_values(col: str, values, name: str | None = None, on_null="fail") -> Rule:
    return Rule(name or f"KNOWN_{col.upper()}", BUSINESS_RULE, F.col(col).isin(*values), on_null)


def parsed(text_col: str, fmt: str, name: str | None = None) -> Rule:
    """The text is empty or parses as a timestamp."""
    text = F.nullif(F.trim(F.col(text_col)), F.lit(""))
    check = text.isNull() | F.try_to_timestamp(text, F.lit(fmt)).isNotNull()
    return Rule(name or f"PARSES_{text_col.upper()}", SCHEMA_VALIDATION, check)


def well_formed(name: str = "WELL_FORMED_ROW") -> Rule:
    """A row of sources.files.read_csv that had the contract's number of fields."""
    return Rule(name, SCHEMA_VALIDATION, F.col("_corrupt_record").isNull())


def fully_parsed(name: str = "PARSES_ALL_COLUMNS") -> Rule:
    """No column of a parse_text(..., keep_text=True) result lost its value."""
    return Rule(name, SCHEMA_VALIDATION, F.col("_unparsed").isNull())


def ordered_times(first: str, second: str, name: str | None = None) -> Rule:
    return Rule(
        name or f"{second.upper()}_NOT_BEFORE_{first.upper()}", BUSINESS_RULE,
        F.col(second) >= F.col(first), on_null="pass",
    )


def encounter_rules(los_null: str = "pass", other_null: str = "fail") -> list[Rule]:
    """The three gates of the encounter table. An open stay has no length of stay yet."""
    # Names and bounds of the three rules.
    keys = not_null("EncounterID", "PatientID", name="RULE_01_NOT_NULL_KEYS")
    return [
        keys,
        in_range("LengthOfStayHours", 0, 8760, "RULE_02_VALID_LENGTH_OF_STAY", los_null),
        in_range("TotalBilledAmount", 0, None, "RULE_03_VALID_BILLED_AMOUNT", other_null),
    ]


def vitals_rules(heart_rate=(20, 300), oxygen=(0, 100)) -> list[Rule]:
    """Grain key present and readings physically possible. The bounds are parameters."""
    return [
        not_null("TelemetryID", "PatientID", "EncounterID", name="NOT_NULL_TELEMETRY_KEYS"),
        in_range("HeartRate", *heart_rate, name="VALID_HEART_RATE_RANGE", on_null="pass"),
        in_range("OxygenSaturation", *oxygen, name="VALID_OXYGEN_RANGE", on_null="pass"),
        not_null("EventTimestamp", name="NOT_NULL_EVENT_TIMESTAMP"),
    ]


def contract_rules(contract) -> list[Rule]:
    """NOT NULL and length rules of a warehouse table, for columns typed by enforce()."""
    rules = []
    for col in contract:
        if col.required:
            rules.append(
                Rule(f"REQUIRED_{col.name}", SCHEMA_VALIDATION, F.col(col.name).isNotNull())
            )
        if col.length is not None:
            rules.append(
                Rule(
                    f"LENGTH_{col.name}", SCHEMA_VALIDATION,
                    F.char_length(F.col(col.name)) <= col.length, on_null="pass",
                )
            )
    return rules


def enforce(df: DataFrame, contract) -> DataFrame:
    """Cast to the warehouse types; a value that does not fit becomes NULL and fails its rule.

    A missing column becomes NULL. ``_misfit`` names columns whose value was lost by the cast.
    """
    have = set(df.columns)
    casts, lost = [], []
    for col in contract:
        source = F.col(col.name) if col.name in have else F.lit(None)
        cast = source.try_cast(col.kind)
        casts.append(cast.alias(col.name))
        lost.append(F.when(source.isNotNull() & cast.isNull(), F.lit(col.name)))
    misfit = F.nullif(F.concat_ws(",", *lost), F.lit("")).alias("_misfit")
    return df.select(*casts, misfit)


def misfit_rule() -> Rule:
    return Rule("TYPES_FIT", SCHEMA_VALIDATION, F.col("_misfit").isNull())


def tag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add the comma-separated names of the failed rules (empty text when none failed)."""
    failed = F.concat_ws(",", *[F.when(~r.passed, F.lit(r.name)) for r in rules])
    dropping = [r.check.isNull() for r in rules if r.on_null == "drop"]
    undecided = reduce(lambda a, b: a | b, dropping) if dropping else F.lit(False)
    return df.withColumns({FAILED: failed, UNDECIDED: undecided})


def is_valid() -> Column:
    return (F.col(FAILED) == "") & ~F.col(UNDECIDED)


def is_invalid() -> Column:
    return F.col(FAILED) != ""


def sides(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rows once, with their failed rules and ``side``: valid, invalid, or NULL where a rule drops."""
    side = F.when(is_valid(), "valid").when(is_invalid(), "invalid")
    return tag(df, rules).withColumn("side", side).drop(UNDECIDED)


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with their failed rules).

    Each side computes ``df`` on its own. Where both are used, take ``sides`` or ``sources.tables.gate``.
    """
    tagged = tag(df, rules)
    return (
        tagged.where(is_valid()).drop(FAILED, UNDECIDED),
        tagged.where(is_invalid()).drop(UNDECIDED),
    )


def quarantine_columns(invalid: DataFrame, run_id: str, reason: str | None = None) -> DataFrame:
    """Reason, time and run of a quarantined row."""
    return invalid.withColumns(
        {
            "_quarantine_reason": F.lit(reason) if reason else F.col(FAILED),
            "_quarantined_at": F.current_timestamp(),
            "run_id": F.lit(run_id),
        }
    )


def count_columns(rules: list[Rule]) -> list[Column]:
    """Aggregates that count all rules at once: total, passed, quarantined, one per rule."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_valid()).alias("passed"),
        F.count_if(is_invalid()).alias("quarantined"),
        *[F.count_if(~r.passed).alias(r.name) for r in rules],
    ]


def rule_counts(df: DataFrame, rules: list[Rule], by=()) -> DataFrame:
    """One row per rule (and group): rows checked and rows failed, from a single aggregation."""
    failed = [F.count_if(~r.passed).alias(f"f{i}") for i, r in enumerate(rules)]
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("TotalRecordsChecked"), *failed)
    names = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("RuleName"), F.lit(r.kind).alias("RuleType"),
                F.col(f"f{i}").alias("FailedRecordCount"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(*by, "TotalRecordsChecked", F.inline(names))


def observed(df: DataFrame, rules: list[Rule], name: str) -> tuple[DataFrame, Observation]:
    """Tag the rows and count every rule while they are being written: no extra job."""
    seen = Observation(name)
    return tag(df, rules).observe(seen, *count_columns(rules)), seen


def drift(df: DataFrame, contract: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """Differences between a DataFrame's schema and its contract: (column, issue, expected, found)."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    expected = {f.name: f.dataType.simpleString() for f in contract}
    rows = [(c, "missing", t, None) for c, t in expected.items() if c not in found]
    rows += [(c, "extra", None, t) for c, t in found.items() if c not in expected]
    rows += [
        (c, "type", t, found[c]) for c, t in expected.items() if c in found and found[c] != t
    ]
    return rows


DRIFT_SCHEMA = "ColumnName string, Issue string, Expected string, Found string"


def drift_report(df: DataFrame, contract: T.StructType) -> DataFrame:
    return df.sparkSession.createDataFrame(drift(df, contract), DRIFT_SCHEMA)


def drift_profile(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The drift report, with the number of rows that hold a value in each column concerned."""
    rows = drift(df, contract)
    counted = [
        F.struct(
            F.lit(name).alias("ColumnName"), F.lit(issue).alias("Issue"),
            F.lit(expected).cast("string").alias("Expected"), F.lit(found).cast("string").alias("Found"),
            (F.lit(0).cast("long") if issue == "missing" else F.col(f"n{i}")).alias("RowsWithValue"),
        )
        for i, (name, issue, expected, found) in enumerate(rows)
    ]
    if not rows:
        return df.sparkSession.createDataFrame([], DRIFT_SCHEMA + ", RowsWithValue long")
    present = [F.count(r[0]).alias(f"n{i}") for i, r in enumerate(rows) if r[1] != "missing"]
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *present)
    return counts.select(F.inline(F.array(*counted)))
