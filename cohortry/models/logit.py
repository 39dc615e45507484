"""Logistic regression without grouping, on rows collapsed to covariate patterns."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.numeric import interval_text, scientific
from cohortry.functions.tails import normal_two_sided, p_value
from cohortry.models.design import Factor, Number, Term, complete, design_columns
from cohortry.session import stored

Z95 = 1.959963984540054


INTERCEPT = "(intercept)"
OK, SEPARATED, NO_ROWS, NOT_ESTIMABLE = "ok", "separated", "no rows", "not estimable"
# A standard error of this many units of the term's own spread has no likelihood behind it.
FLAT = 100.0


def patterns(df: DataFrame, outcome: Column, terms: Sequence[Term]) -> DataFrame:
    """One row per pattern of the terms' own columns: rows and rows with the outcome."""
    rows = df.filter(complete(terms) & outcome.isNotNull()).select(
        outcome.cast("int").alias("_y"), *[F.col(c) for c in dict.fromkeys(t.column for t in terms)]
    )
    names = [c for c in rows.columns if c != "_y"]
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_events"))


def separation(pat: DataFrame, terms: Sequence[Term]) -> tuple[dict[tuple[int, object], str], DataFrame, int, int]:
    """Which factor levels have rows with one outcome only (or none); the patterns without them, their rows and those with the outcome.

    Such a level's estimate is infinite and its rows add nothing to the likelihood of the rest, so they leave, until every level
    that is left has both outcomes. One aggregation a round, at most as many rounds as levels.
    """
    found: dict[tuple[int, object], str] = {}
    levels = [(i, v) for i, t in enumerate(terms) if isinstance(t, Factor) for v in t.levels]
    while True:
        left = [k for k in levels if k not in found]
        here = {k: F.col(terms[k[0]].column) == F.lit(k[1]) for k in left}
        counts = pat.agg(
            F.sum("_n"),
            F.sum("_events"),
            *[F.sum(F.when(c, F.col(x))) for c in here.values() for x in ("_n", "_events")],
        ).first()
        n, events, own = counts[0] or 0, counts[1] or 0, counts[2:]
        gone = {k: (own[2 * i] or 0, own[2 * i + 1] or 0) for i, k in enumerate(left)}
        gone = {k: NO_ROWS if not m else SEPARATED for k, (m, e) in gone.items() if e in (0, m)}
        if found and 0 in (n, events, n - events):
            # Nothing with both outcomes is left.
            return found | {k: gone.get(k, SEPARATED) for k in left}, pat, n, events
        if not gone:
            return found, pat, n, events
        found |= gone
        pat = pat.filter(~reduce(lambda a, b: a | b, [here[k] for k in gone]))


def ordered_apart(pat: DataFrame, numbers: Sequence[Number]) -> list[Number]:
    """Numbers whose values with the outcome all lie on one side of those without."""
    if not numbers:
        return []
    yes, no = F.col("_events") > 0, F.col("_events") < F.col("_n")
    ends = [f(F.when(side, F.col(x.column).cast("double"))) for x in numbers for side in (yes, no) for f in (F.min, F.max)]
    seen = pat.agg(*ends).first()
    apart = []
    for i, x in enumerate(numbers):
        low_yes, high_yes, low_no, high_no = seen[4 * i : 4 * i + 4]
        # One value only is no separation but a column that does not vary.
        if None not in (low_yes, low_no) and (high_yes <= low_no or high_no <= low_yes) and min(low_yes, low_no) < max(high_yes, high_no):
            apart.append(x)
    return apart


def logit(df: DataFrame, outcome: Column, terms: Sequence[Term]) -> DataFrame:
    """(term, estimate, std_error, status, z, conf_low, conf_high, p_value) on the log-odds scale.

    A term whose maximum lies at infinity has NULL estimates and the status ``separated``, a level without rows ``no rows``;
    the others are estimated as if these rows were not there, which is their limit. Without a finite intercept (all rows
    alike, or a separated reference level) the intercept and the factor's other levels are ``separated`` too. What is separated by
    a combination of terms only shows in standard errors without bound and is ``not estimable``.
    """
    names = [n for n, _ in design_columns(terms)]
    spark = df.sparkSession
    if not names:
        total = df.filter(outcome.isNotNull()).agg(F.count_if(outcome).alias("a"), F.count_if(~outcome).alias("b"))
        a, b = (F.nullif(F.col(c).cast("double"), F.lit(0.0)) for c in "ab")
        status = F.when(a.isNotNull() & b.isNotNull(), OK).when(a.isNull() & b.isNull(), NO_ROWS).otherwise(SEPARATED)
        return wald(total.select(F.lit(INTERCEPT).alias("term"), F.ln(a / b).alias("estimate"), F.sqrt(1 / a + 1 / b).alias("std_error"), status.alias("status")))

    found, pat, n, events = separation(stored(patterns(df, outcome, terms), "patterns"), terms)
    status = {n: OK for n in [*names, INTERCEPT]}
    kept: list[Term] = []
    for i, t in enumerate(terms):
        if isinstance(t, Number):
            kept.append(t)
            continue
        base = t.reference()
        left = tuple(v for v in t.levels if (i, v) not in found)
        for v in t.levels:
            if v != base:
                status[f"{t.column}={v}"] = found.get((i, v)) or found.get((i, base), OK)
        if (i, base) in found:
            status[INTERCEPT] = found[(i, base)]
        if len(left) > 1:
            kept.append(Factor(t.column, left, left.index(base) + 1 if base in left else 1))
    apart = ordered_apart(pat, [t for t in kept if isinstance(t, Number)]) if 0 < events < n else []
    if apart or not 0 < events < n:
        # One number splits the outcomes, or all rows that are left are alike: nothing is finite.
        reason = SEPARATED if n else NO_ROWS
        status = {name: reason if s == OK else s for name, s in status.items()}
    fitted = {}
    if OK in status.values():
        fitted = _fit(pat, kept)
        status = {name: fitted[name][2] if s == OK else s for name, s in status.items()}
    rows = [(name, *(fitted[name][:2] if s == OK else (None, None)), s) for name, s in status.items()]
    return wald(spark.createDataFrame(rows, "term string, estimate double, std_error double, status string"))


def _fit(pat: DataFrame, terms: Sequence[Term]) -> dict[str, tuple[float, float, str]]:
    """Estimate, standard error and status by term."""
    columns = design_columns(terms)
    names = [n for n, _ in columns]
    if not names:
        n, events = pat.agg(F.sum("_n"), F.sum("_events")).first()
        return {INTERCEPT: (math.log(events / (n - events)), math.sqrt(1 / events + 1 / (n - events)), OK)}
    # Column names of a design may hold any text; the assembler needs plain ones.
    design = pat.select("_n", "_events", *[c.alias(f"x{i}") for i, (_, c) in enumerate(columns)])
    weighted = design.groupBy(*[f"x{i}" for i in range(len(names))]).agg(F.sum("_n").alias("_n"), F.sum("_events").alias("_events"))
    weighted = weighted.withColumn("_rate", F.col("_events") / F.col("_n"))
    vectors = VectorAssembler(inputCols=[f"x{i}" for i in range(len(names))], outputCol="features").transform(weighted)
    model = GeneralizedLinearRegression(
        family="binomial", link="logit", labelCol="_rate", weightCol="_n", regParam=0.0, tol=1e-10, maxIter=50
    ).fit(vectors)
    share = {i: F.sum(F.col("_n") * F.col(f"x{i}")) / F.sum("_n") for i in range(len(names))}
    square = {i: F.sum(F.col("_n") * F.col(f"x{i}") * F.col(f"x{i}")) / F.sum("_n") for i in range(len(names))}
    moments = weighted.agg(*share.values(), *square.values()).first()
    spread = [math.sqrt(max(s - m * m, 0.0)) for m, s in zip(moments[: len(names)], moments[len(names) :])]
    errors = [float(e) for e in model.summary.coefficientStandardErrors]
    estimates = [*map(float, model.coefficients), float(model.intercept)]
    flat = [not e * s < FLAT for e, s in zip(errors, [*spread, 1.0])]
    return {
        name: (b, e, NOT_ESTIMABLE if f else OK) for name, b, e, f in zip([*names, INTERCEPT], estimates, errors, flat)
    }


def ratio_table(
    df: DataFrame, outcome: Column, factors: Sequence[Factor], numbers: Sequence[Number] = ()
) -> DataFrame:
    """Crude odds ratio of every level against the reference, and per unit of every number: (variable, level, …).

    All levels of all factors are counted in one aggregation; a number is a model of its own.
    """
    wide = df.agg(
        *[
            F.count_if((F.col(f.column) == F.lit(v)) & (outcome if side else ~outcome)).alias(f"{i}_{j}_{side}")
            for i, f in enumerate(factors)
            for j, v in enumerate(f.levels)
            for side in (0, 1)
        ]
    ) if factors else None
    parts = []
    if wide is not None:
        lines = []
        for i, f in enumerate(factors):
            base = f.levels.index(f.reference())
            for j, v in enumerate(f.levels):
                cells = [F.nullif(F.col(c).cast("double"), F.lit(0.0)) for c in (f"{i}_{j}_1", f"{i}_{j}_0", f"{i}_{base}_1", f"{i}_{base}_0")]
                a, b, c, d = cells
                log_or = F.when(F.lit(j == base), F.lit(0.0)).otherwise(F.ln(a) - F.ln(b) - F.ln(c) + F.ln(d))
                se = F.when(F.lit(j != base), F.sqrt(1 / a + 1 / b + 1 / c + 1 / d))
                lines.append(
                    F.struct(
                        F.lit(f.column).alias("variable"),
                        F.lit(str(v)).alias("level"),
                        log_or.alias("estimate"),
                        se.alias("std_error"),
                    )
                )
        parts.append(wald(wide.select(F.inline(F.array(*lines)))))
    for number in numbers:
        fitted = logit(df, outcome, [number]).filter(F.col("term") == number.column).drop("status")
        parts.append(fitted.withColumnRenamed("term", "variable").withColumn("level", F.lit(None).cast("string")))
    out = reduce(lambda x, y: x.unionByName(y), parts)
    return out.withColumn("odds_ratio", F.exp("estimate"))


def wald(rows: DataFrame) -> DataFrame:
    """z, two-sided p and the 95 % interval of estimate and std_error."""
    e, s = F.col("estimate"), F.col("std_error")
    out = rows.withColumns({"z": F.try_divide(e, s), "conf_low": e - Z95 * s, "conf_high": e + Z95 * s})
    return out.withColumn("p_value", p_value(normal_two_sided, "z"))


def or_table(results: DataFrame, digits: int = 4) -> DataFrame:
    """Printed form: odds ratio, interval text, its own standard error, p in scientific notation."""
    e = F.col("estimate")
    return results.select(
        "term",
        F.round(F.exp(e), digits).alias("estimate"),
        interval_text(F.exp("conf_low"), F.exp("conf_high")).alias("conf_int"),
        F.round(F.exp(e) * F.col("std_error"), digits).alias("std_error"),
        scientific("p_value").alias("p_value"),
    )
