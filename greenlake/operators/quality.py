"""Record quality: configured rules, pass rates, the gate, and its evidence.

Rules are plain dicts with code, type and fields. All rules become columns of one plan: two wide
aggregates at most, plus one shuffle for each uniqueness rule.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from greenlake.functions.text import blank
from greenlake.sources.scratch import scratch_path, written

DECIMAL = "decimal(38,10)"

# The quality dimension that each kind of rule measures.
DIMENSIONS = {"required": "completeness", "unique": "uniqueness", "range": "validity", "allowed": "validity", "field_order": "consistency"}


def _key(field: str, df: DataFrame) -> Column:
    return F.lower(F.trim(F.col(field))) if dict(df.dtypes)[field] == "string" else F.col(field)


def _decimal(value) -> Column:
    return F.trim(value.cast("string")).try_cast(DECIMAL)


def _fails(rule: dict, df: DataFrame) -> Column:
    kind = rule["type"]
    if kind == "required":
        return F.exists(F.array(*(blank(f) if f in df.columns else F.lit(True) for f in rule["fields"])), lambda x: x)
    if kind == "range":
        v = F.col(rule["field"])
        x = _decimal(v)
        bad = x.isNull()
        if rule.get("minimum") is not None:
            low = F.lit(str(rule["minimum"])).cast(DECIMAL)
            bad = bad | ((x < low) if rule.get("inclusive_minimum", True) else (x <= low))
        if rule.get("maximum") is not None:
            high = F.lit(str(rule["maximum"])).cast(DECIMAL)
            bad = bad | ((x > high) if rule.get("inclusive_maximum", True) else (x >= high))
        bad = F.coalesce(bad, F.lit(True))
        return bad & ~blank(v) if rule.get("allow_blank") else bad
    if kind == "allowed":
        values = rule["values"]
        if dict(df.dtypes)[rule["field"]] == "string":
            return ~F.coalesce(F.lower(F.trim(rule["field"])).isin([str(x).strip().lower() for x in values]), F.lit(False))
        return ~F.coalesce(F.col(rule["field"]).isin(list(values)), F.lit(False))
    if kind == "field_order":
        return F.coalesce(_decimal(F.col(rule["lower_field"])) > _decimal(F.col(rule["upper_field"])), F.lit(True))
    raise ValueError(f"Unsupported quality rule type: {kind}")


#: So many repeated keys go to every task; a key takes some 100 bytes.
FEW_REPEATS = 200_000


def _repeated(keyed: DataFrame, keys: list[str]) -> DataFrame:
    whole = F.expr(" and ".join(f"{k} is not null" for k in keys))
    return keyed.where(whole).groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*keys)


def _few_repeated(keyed: DataFrame, keys: list[str]) -> DataFrame | None:
    """The repeated keys of stored rows, or None where there may be too many for a broadcast.

    Keys are counted by their hash alone, which moves some ten bytes a row; whole keys are compared where a hash is repeated.
    """
    whole = F.expr(" and ".join(f"{k} is not null" for k in keys))
    hashes = keyed.where(whole).groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.count("*").alias("_n")).where("_n > 1").select("_hash")
    hashes = written(hashes, "repeated-hashes")
    if hashes.limit(FEW_REPEATS + 1).count() > FEW_REPEATS:
        return None
    return written(_repeated(keyed.join(F.broadcast(hashes), F.xxhash64(*keys) == F.col("_hash"), "left_semi"), keys), "repeated-keys")


def _mark(df: DataFrame, rules: Sequence[dict], store: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, bool]:
    """:func:`with_failures`, and whether its columns follow from stored rows without a shuffle.

    ``store`` is given the rows with the columns of all but uniqueness rules, so that counting and joining read what it returns and not the
    source twice.
    """
    out = df.withColumns({f"_fail_{i}": _fails(r, df) for i, r in enumerate(rules) if r["type"] != "unique"})
    shared = [(i, {f"_key_{i}_{j}": F.when(~blank(f), _key(f, df)) for j, f in enumerate(r["fields"])}) for i, r in enumerate(rules) if r["type"] == "unique"]
    out = store(out) if store and shared else out
    at_hand = bool(store and shared)
    for i, keys in shared:
        keyed = out.withColumns(keys)
        few = _few_repeated(keyed, list(keys)) if at_hand else None
        at_hand = few is not None
        twice = F.broadcast(few) if at_hand else _repeated(keyed, list(keys))
        out = keyed.join(twice.withColumn(f"_fail_{i}", F.lit(True)), list(keys), "left").withColumn(f"_fail_{i}", F.coalesce(f"_fail_{i}", F.lit(False))).drop(*keys)
    names = [f"_fail_{i}" for i in range(len(rules))]
    return out.withColumn("_failed", F.greatest(*names, F.lit(False), F.lit(False)) if names else F.lit(False)), at_hand


def with_failures(df: DataFrame, rules: Sequence[dict]) -> DataFrame:
    """``df`` with a boolean column ``_fail_i`` for each rule and ``_failed`` for any of them.

    A uniqueness rule fails every member of a group of equal keys; a key with a blank part is left out.
    Its counts are aggregated before they are joined back, so a very common key is never gathered.
    """
    return _mark(df, rules)[0]


def _counts(rules: Sequence[dict]) -> list[Column]:
    return [F.count("*").alias("assessed"), *(F.count_if(f"_fail_{i}").alias(f"f{i}") for i in range(len(rules))), F.count_if("_failed").alias("f_all")]


def _report(counts: DataFrame, rules: Sequence[dict], dataset: str, threshold: float) -> DataFrame:
    if not 0 <= threshold <= 100:
        raise ValueError("threshold must be between 0 and 100")
    rows = [F.struct(F.lit(r["code"]).alias("rule_code"), F.lit(r["type"]).alias("rule_type"), F.col(f"f{i}").alias("failed")) for i, r in enumerate(rules)]
    rows.append(F.struct(F.lit(None).cast("string").alias("rule_code"), F.lit("all").alias("rule_type"), F.col("f_all").alias("failed")))
    x = counts.select("assessed", F.inline(F.array(*rows)))
    rate = F.coalesce((F.col("assessed") - F.col("failed")) / F.nullif("assessed", F.lit(0)) * 100, F.lit(0.0))
    return x.select(
        F.lit(dataset).alias("dataset"), "rule_code", "rule_type", "assessed", (F.col("assessed") - F.col("failed")).alias("passed"), "failed",
        F.round(rate, 2).alias("pass_rate"), ((F.col("assessed") > 0) & (rate >= threshold)).alias("passed_gate"),
    )


def validate(df: DataFrame, rules: Sequence[dict], dataset: str, threshold: float = 95.0) -> DataFrame:
    """One row for each rule and one, with a null rule, for the records as a whole.

    Columns: dataset, rule_code, rule_type, assessed, passed, failed, pass_rate (two digits) and
    passed_gate, which compares the unrounded rate and is false for an empty table.
    """
    return _report(with_failures(df, rules).agg(*_counts(rules)), rules, dataset, threshold)


@dataclass(frozen=True)
class Judged:
    """Rows that were judged in one pass: ``marked`` has the columns of :func:`with_failures` and reads stored rows."""

    marked: DataFrame
    columns: list[str]
    report: DataFrame
    passed: bool

    def kept(self) -> DataFrame:
        """The passing records when the data set passes its gate, else none."""
        return self.marked.where(~F.col("_failed") if self.passed else F.lit(False)).select(*self.columns)


def judge(df: DataFrame, rules: Sequence[dict], dataset: str, threshold: float = 95.0) -> Judged:
    """Mark, count and store rows in one pass over ``df``; report, gate and kept rows then follow from what is stored.

    Rows with uniqueness rules are stored before these are judged. Few repeated keys are broadcast to the stored rows whenever they are read; with
    more, and without such rules, the marked rows are stored, and counts are observed by the tasks that write them; a task that is run
    again is counted once.
    """
    spark = df.sparkSession
    marked, at_hand = _mark(df, rules, lambda rows: written(rows, "rows"))
    if at_hand:
        got = marked.agg(*_counts(rules)).first().asDict()
    else:
        seen, path = Observation(), scratch_path(spark, "marked")
        marked.observe(seen, *_counts(rules)).write.parquet(path)
        got, marked = seen.get, spark.read.schema(marked.schema).parquet(path)
    names = ["assessed", *(f"f{i}" for i in range(len(rules))), "f_all"]
    counts = spark.range(0, 1, 1, 1).select(*(F.lit(got[n]).cast("bigint").alias(n) for n in names))
    report = _report(counts, rules, dataset, threshold)
    passed = got["assessed"] > 0 and (got["assessed"] - got["f_all"]) / got["assessed"] * 100 >= threshold
    return Judged(marked, df.columns, report, passed)


def gate(df: DataFrame, rules: Sequence[dict], threshold: float = 95.0) -> DataFrame:
    """The passing records when the data set passes its gate, else none."""
    return judge(df, rules, "", threshold).kept()


def evidence(df: DataFrame, rules: Sequence[dict], id_col: str, samples: int = 20) -> DataFrame:
    """For each rule: dimension, status, failures, and the ``samples`` smallest failing ids, comma-joined."""
    marked = with_failures(df, rules)
    failing = F.array_compact(F.array(*(F.when(F.col(f"_fail_{i}"), F.lit(r["code"])) for i, r in enumerate(rules))))
    x = marked.select(F.col(id_col).alias("id"), F.explode(failing).alias("rule_code"))
    # The smallest ids within slices first, so that a rule that everything fails stays spread out.
    w = Window.partitionBy("rule_code", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    few = x.withColumn("n", F.row_number().over(w)).where(F.col("n") <= samples)
    few = few.groupBy("rule_code").agg(F.slice(F.sort_array(F.collect_list("id")), 1, samples).alias("ids"))
    total = x.groupBy("rule_code").agg(F.count("*").alias("failed")).join(few, "rule_code")
    kinds = df.sparkSession.createDataFrame([(r["code"], DIMENSIONS[r["type"]]) for r in rules], "rule_code string, dimension string")
    return kinds.join(total, "rule_code", "left").select(
        "rule_code", "dimension", F.coalesce("failed", F.lit(0)).alias("failed"), F.when(F.coalesce("failed", F.lit(0)) == 0, "passed").otherwise("failed").alias("status"),
        F.coalesce(F.array_join(F.transform("ids", lambda x: x.cast("string")), ","), F.lit("")).alias("sample_ids"),
    )


def baseline_checks(df: DataFrame, key: Sequence[str], required: Sequence[str], value: str, low: float, high: float) -> DataFrame:
    """Checks of a built grid: here the overall rate is the least of the rules', and uniqueness counts extra copies only."""
    n = F.count("*")
    rates = df.agg(
        n.alias("records"), (F.count_if(~F.exists(F.array(*(F.col(c).isNull() for c in required)), lambda x: x)) / n * 100).alias("required_rate"),
        (F.count_if(F.coalesce(F.col(value).between(low, high), F.lit(False))) / n * 100).alias("range_rate"),
        (F.count_distinct(F.struct(*key)) / n * 100).alias("unique_rate"),
    )
    return rates.select("records", *(F.round(c, 2).alias(c) for c in ("required_rate", "range_rate", "unique_rate")), F.round(F.least("required_rate", "range_rate", "unique_rate"), 2).alias("overall_rate"))


def grid_alignment(base: DataFrame, other: DataFrame) -> DataFrame:
    """Share of ``base``'s bounding box that ``other``'s covers, at most 100."""

    def box(df, p):
        return df.agg(F.min("xmin").alias(p + "x0"), F.min("ymin").alias(p + "y0"), F.max("xmax").alias(p + "x1"), F.max("ymax").alias(p + "y1"))

    x = box(base, "a").join(F.broadcast(box(other, "b")), F.lit(True))
    wide = F.greatest(F.least("ax1", "bx1") - F.greatest("ax0", "bx0"), F.lit(0.0))
    tall = F.greatest(F.least("ay1", "by1") - F.greatest("ay0", "by0"), F.lit(0.0))
    area = (F.col("ax1") - F.col("ax0")) * (F.col("ay1") - F.col("ay0"))
    return x.select(F.least(F.lit(100.0), wide * tall / F.nullif(area, F.lit(0.0)) * 100).alias("overlap_pct"))


def roll_up(checks: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Counts by status and the overall status: FAIL before WARN before PASS."""
    c = lambda s: F.count_if(F.col("status") == s)
    return checks.groupBy(*group).agg(
        c("PASS").alias("n_pass"), c("WARN").alias("n_warn"), c("FAIL").alias("n_fail"),
        F.when(c("FAIL") > 0, "FAIL").when(c("WARN") > 0, "WARN").otherwise("PASS").alias("status"),
    )


def compare_expected(actual: DataFrame, expected: DataFrame, key: Sequence[str], values: Sequence[str], tolerance: float = 0.001) -> DataFrame:
    """Each expected case with its failures: the names of values beyond the tolerance, or ``missing``."""
    a = actual.select(*key, *(F.col(v).alias("_" + v) for v in values), F.lit(True).alias("_there"))
    wrong = [F.when(~F.coalesce(F.abs(F.col("_" + v) - F.col(v)) <= tolerance, F.col("_" + v).isNull() & F.col(v).isNull()), F.lit(v)) for v in values]
    failures = F.when(F.col("_there").isNull(), F.array(F.lit("missing"))).otherwise(F.array_compact(F.array(*wrong)))
    x = expected.join(a, list(key), "left").withColumn("_f", failures)
    return x.select(*key, F.array_join("_f", ",").alias("failures"), (F.size("_f") == 0).alias("passed"))
