"""Least-squares fits and error metrics from grouped sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from limnospark.functions.numbers import coefficients_json, predict
from limnospark.operators.choose import first_row
from limnospark.operators.groups import HOT_MIN_ROWS, join_group_table


def finite_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows in which both values are numbers; null, NaN and infinity take no part in a fit."""
    limit = F.lit(float("inf"))  # NaN is larger than any number
    return df.where((F.abs(F.col(x).cast("double")) < limit) & (F.abs(F.col(y).cast("double")) < limit))


def linear_fit(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Slope and intercept of y on x per group; a constant x gives slope 0 through the mean of y."""
    flat = (F.count(F.lit(1)) < 2) | (F.var_pop(x) == 0)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.when(flat, F.lit(0.0)).otherwise(F.regr_slope(y, x)).alias("slope"),
        F.when(flat, F.avg(y)).otherwise(F.regr_intercept(y, x)).alias("intercept"),
        F.avg(y).alias("mean_y"),
    )


def fitted_pairs(
    df: DataFrame, keys: Sequence[str], x: str, y: str, salt_on: Sequence[str], min_rows: int = HOT_MIN_ROWS
) -> DataFrame:
    """Rows with `predicted` and `residual` of their group's line."""
    fits = linear_fit(df, keys, x, y)
    return (
        join_group_table(df, fits, keys, "n", salt_on, min_rows)
        .withColumn("predicted", F.col("slope") * F.col(x) + F.col("intercept"))
        .withColumn("residual", F.col(y) - F.col("predicted"))
    )


def pair_metrics(fitted: DataFrame, keys: Sequence[str], x: str, y: str, extra: Sequence[Column] = ()) -> DataFrame:
    """Agreement of x and y, and of the fitted line and y, one row per group."""
    n = F.count(F.lit(1))
    gap, rest = F.col(y) - F.col(x), F.col("residual")
    ss_tot = F.sum(F.pow(F.col(y) - F.col("mean_y"), F.lit(2)))
    sums = fitted.groupBy(*keys).agg(
        n.alias("n"),
        F.first("slope").alias("slope"),
        F.first("intercept").alias("intercept"),
        F.covar_pop(x, y).alias("__cov"),
        F.stddev_pop(x).alias("__sx"),
        F.stddev_pop(y).alias("__sy"),
        F.sqrt(F.avg(gap * gap)).alias("rmse_direct"),
        F.sqrt(F.avg(rest * rest)).alias("rmse_regression"),
        F.avg(y).alias("mean_y"),
        F.avg(F.abs(rest)).alias("mae"),
        (F.avg(F.when(F.col(y) != 0, F.abs(rest / F.col(y)))) * 100.0).alias("mape"),
        F.sum(-rest).alias("__sum_bias"),
        F.sum(y).alias("__sum_y"),
        F.sum(rest * rest).alias("__ss_res"),
        ss_tot.alias("__ss_tot"),
        *extra,
    )
    share = 1.0 - F.try_divide(F.col("__ss_res"), F.col("__ss_tot"))
    return sums.withColumns({
        "r2": F.when(F.col("n") >= 2, F.coalesce(share, F.when(F.col("__ss_res") == 0, 1.0).otherwise(0.0))),
        "pearson": F.when(F.col("n") >= 2, F.try_divide(F.col("__cov"), F.col("__sx") * F.col("__sy"))),
        "nrmse_direct": F.try_divide(F.col("rmse_direct"), F.col("mean_y")),
        "pbias": F.try_divide(F.col("__sum_bias") * 100.0, F.col("__sum_y")),
        "nse": share,
    }).drop("__cov", "__sx", "__sy", "__sum_bias", "__sum_y", "__ss_res", "__ss_tot")


def curve_fits(df: DataFrame, keys: Sequence[str], x: str, y: str, min_points: int = 3) -> DataFrame:
    """poly1, poly2 and power-law least squares, one row per group with all its models.

    Rows without two finite values are left out. Everything comes from one aggregation of built-in central moments, which merge across map
    tasks. The quadratic is solved around the mean of x and expanded back.
    Columns: keys, `n_points`, `models` (array of model, a, b, c, mean_y).
    """
    lx = F.when((F.col(x) > 0) & (F.col(y) > 0), F.ln(F.col(x)))
    ly = F.when((F.col(x) > 0) & (F.col(y) > 0), F.ln(F.col(y)))
    m = (
        finite_pairs(df, x, y).groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_points"),
            F.avg(x).alias("mx"), F.avg(y).alias("my"), F.var_pop(x).alias("m2"),
            F.skewness(x).alias("skew"), F.kurtosis(x).alias("kurt"),
            F.covar_pop(x, y).alias("cuv"), F.covar_pop(F.col(x) * F.col(x), F.col(y)).alias("cxxy"),
            F.count(lx).alias("np"), F.avg(lx).alias("mlx"), F.avg(ly).alias("mly"), F.var_pop(lx).alias("vlx"),
            F.covar_pop(lx, ly).alias("clxy"),
            F.avg(F.when(F.col(x) > 0, F.col(y))).alias("my_positive"),
        )
        .where(F.col("n_points") >= min_points)
    )
    m = m.withColumns({
        "m3": F.col("skew") * F.pow("m2", F.lit(1.5)),
        "spread": (F.col("kurt") + 2.0) * F.col("m2") * F.col("m2"),  # m4 - m2^2
        "cu2v": F.col("cxxy") - 2.0 * F.col("mx") * F.col("cuv"),
        # Lines from the moments that are there, since each regression aggregate would carry seven more numbers per group.
        "slope": F.try_divide(F.col("cuv"), F.col("m2")), "lslope": F.try_divide(F.col("clxy"), F.col("vlx")),
    }).withColumns({
        "shift": F.col("my") - F.col("slope") * F.col("mx"), "lshift": F.col("mly") - F.col("lslope") * F.col("mlx"),
    }).withColumn("det", F.col("m2") * F.col("spread") - F.col("m3") * F.col("m3"))
    # Fewer than three distinct x leave the quadratic without a unique solution.
    solvable = F.col("det") > 1e-10 * F.col("m2") * (F.col("spread") + F.col("m2") * F.col("m2"))
    m = m.withColumns({
        "p": F.when(solvable, (F.col("cuv") * F.col("spread") - F.col("cu2v") * F.col("m3")) / F.col("det")),
        "q": F.when(solvable, (F.col("m2") * F.col("cu2v") - F.col("m3") * F.col("cuv")) / F.col("det")),
    })

    def line(slope: str, shift: str, variance: str, mean_x: str, mean_y: str) -> tuple[Column, Column]:
        # A constant, non-zero x gets the minimum-norm solution a least-squares solver returns.
        flat = (F.col(variance) == 0) & (F.col(mean_x) != 0)
        return (
            F.when(flat, F.col(mean_y) / (2.0 * F.col(mean_x))).otherwise(F.col(slope)),
            F.when(flat, F.col(mean_y) / 2.0).otherwise(F.col(shift)),
        )

    def model(name: str, a: Column, b: Column, c: Column, mean_y: str) -> Column:
        return F.when(
            a.isNotNull(),
            F.struct(F.lit(name).alias("model"), a.alias("a"), b.alias("b"), c.alias("c"),
                     F.col(mean_y).alias("mean_y")),
        )

    none = F.lit(None).cast("double")
    a1, b1 = line("slope", "shift", "m2", "mx", "my")
    exponent, log_factor = line("lslope", "lshift", "vlx", "mlx", "mly")
    enough = F.col("np") >= 3
    quadratic_b = F.col("p") - 2.0 * F.col("q") * F.col("mx")
    quadratic_c = F.col("my") - F.col("p") * F.col("mx") + F.col("q") * (F.col("mx") * F.col("mx") - F.col("m2"))
    models = F.array_compact(F.array(
        model("poly1", a1, b1, none, "my"),
        model("poly2", F.col("q"), quadratic_b, quadratic_c, "my"),
        model("power", F.when(enough, F.exp(log_factor)), exponent, none, "my_positive"),
    ))
    return m.select(*keys, "n_points", models.alias("models"))


def fit_rows(fits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per group and model with its coefficients, also as JSON text."""
    rows = fits.select(*keys, "n_points", F.inline("models"))
    return rows.select(
        *keys, "model", "n_points", "a", "b", "c", coefficients_json(F.col("a"), F.col("b"), F.col("c")).alias("coefficients")
    )


def curve_metrics(
    df: DataFrame, fits: DataFrame, keys: Sequence[str], x: str, y: str, min_rows: int = HOT_MIN_ROWS
) -> DataFrame:
    """Error metrics per group and model.

    Equal (x, y) rows are counted first; the distinct rows of a hot group are then spread over
    salts for the join with the fits.
    """
    copies = finite_pairs(df, x, y).groupBy(*keys, x, y).agg(F.count(F.lit(1)).cast("double").alias("w"))
    scored = join_group_table(
        copies, fits.withColumn("__size", F.col("n_points")), keys, "__size", [x, y], min_rows
    ).select(*keys, "n_points", x, y, "w", F.inline("models"))
    scored = scored.withColumn(
        "p", predict(F.col("model"), F.col(x), F.col("a"), F.col("b"), F.col("c"))
    ).where(F.col("p").isNotNull())
    w, gap = F.col("w"), F.col("p") - F.col(y)
    sums = scored.groupBy(*keys, "model", "n_points").agg(
        F.sum(w).alias("n"), F.sum(w * gap * gap).alias("ss_res"),
        F.sum(w * F.pow(F.col(y) - F.col("mean_y"), F.lit(2))).alias("ss_tot"),
        F.sum(w * F.abs(gap)).alias("abs_sum"), F.sum(w * gap).alias("gap_sum"), F.sum(w * F.col(y)).alias("y_sum"),
    )
    r2 = 1.0 - F.try_divide(F.col("ss_res"), F.col("ss_tot"))
    rmse = F.sqrt(F.col("ss_res") / F.col("n"))
    return sums.select(
        *keys, "model", "n_points",
        r2.alias("r2"), rmse.alias("rmse"), (F.col("abs_sum") / F.col("n")).alias("mae"),
        F.try_divide(rmse, F.col("y_sum") / F.col("n")).alias("nrmse"),
        (F.col("gap_sum") / F.col("n")).alias("bias"),
        F.try_divide(F.col("gap_sum") * 100.0, F.col("y_sum")).alias("pbias_pct"),
        r2.alias("nse"),
    )


def best_models(metrics: DataFrame, keys: Sequence[str], criterion: str = "r2") -> DataFrame:
    """Best model of each group by one metric; ties go by model name."""
    column = F.col(criterion)
    lower_is_better = criterion in ("rmse", "mae", "nrmse")
    order = column.asc_nulls_last() if lower_is_better else column.desc_nulls_last()
    return first_row(metrics.where(column.isNotNull()), keys, [order, F.col("model")])


def curve_points(
    best: DataFrame, fits: DataFrame, pairs: DataFrame, keys: Sequence[str], x: str, steps: int = 80
) -> DataFrame:
    """The best curve of each group on an even grid over its range of x."""
    span = pairs.where(F.abs(F.col(x).cast("double")) < float("inf")).groupBy(*keys).agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(F.lit(1)).alias("rows"))
    # A single x value gets a band of five percent around it.
    band = F.when(F.col("lo") == F.col("hi"), F.when(F.col("lo") != 0, F.abs("lo") * 0.05).otherwise(0.05)).otherwise(0.0)
    span = span.where("rows >= 2").select(*keys, (F.col("lo") - band).alias("lo"), (F.col("hi") + band).alias("hi"))
    curves = best.select(*keys, "model").join(fits.select(*keys, "model", "a", "b", "c"), [*keys, "model"]).join(span, list(keys))
    grid = curves.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))).withColumn(
        "x", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("step") / (steps - 1)
    )
    return grid.withColumn("y", predict(F.col("model"), F.col("x"), F.col("a"), F.col("b"), F.col("c"))).select(
        *keys, "model", "step", "x", "y"
    )
