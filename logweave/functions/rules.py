"""Regular-expression label rules.

Rules live in a small table ``(log_name, rule_name, pattern)`` so a log can
carry alternative rule sets; the label of a message is 1 when its rule matches
anywhere in it, else 0 (a null message gives 0). Flags: ``i`` + ``u`` =
Unicode-aware case folding (Q7); ``d`` keeps ``.`` from matching only ``\\n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's label patterns.
MESSAGES_PATTERN = "lose cover|disabled|disabling|interrupt"
SYSMONITOR_PATTERN = "(alarm.*memory)|(memory.*alarm)|(resum.*alarm)"
# Alternatives the reference keeps in comments.
SYSMONITOR_ALTERNATIVES = {
    "alarm_or_abnormal": "alarm|abnormal",
    "alarm_then_memory": "(alarm)*.*(memory)",
}

FLAGS = "(?iud)"

DEFAULT_RULES = [
    ("messages", "default", MESSAGES_PATTERN),
    ("sysmonitor", "default", SYSMONITOR_PATTERN),
] + [("sysmonitor", k, v) for k, v in SYSMONITOR_ALTERNATIVES.items()]


def rule_label(message: Column, pattern: str) -> Column:
    """1 if ``pattern`` is found in ``message`` (case-insensitive), else 0."""
    return F.coalesce(message.rlike(FLAGS + pattern).cast("int"), F.lit(0))


def messages_label(message: Column) -> Column:
    return rule_label(message, MESSAGES_PATTERN)


def sysmonitor_label(message: Column) -> Column:
    return rule_label(message, SYSMONITOR_PATTERN)


def rules_table(spark: SparkSession, rules=DEFAULT_RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "log_name string, rule_name string, pattern string")


def label_with_rule_table(parsed: DataFrame, rules=DEFAULT_RULES, rule_name: str | None = "default") -> DataFrame:
    """Label every row by the rule set(s) of its ``log_name``.

    ``rules`` is the small fixed rule list ``(log_name, rule_name, pattern)``.
    Each pattern is a constant ``rlike`` (compiled once per task, codegen);
    with ``rule_name=None`` every rule set of the log is applied in the same
    pass, one output row per line and rule set (``inline`` of a struct array).
    """
    chosen = [r for r in rules if rule_name is None or r[1] == rule_name]
    per_rule = []
    for log_name, name, pattern in chosen:
        per_rule.append(F.when(F.col("log_name") == log_name,
                               F.struct(F.lit(name).alias("rule_name"), rule_label(F.col("message"), pattern)
                                        .alias("Label"))))
    arr = F.filter(F.array(*per_rule), lambda x: x.isNotNull())
    return parsed.select("*", F.inline(arr))
