"""Finite test, the two roundings in use, and sums and moments that are exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INF = float("inf")
# Doubles below this keep nine decimals in a decimal(28,9), whose sum Spark types
# as decimal(38,9).  Larger ones are whole numbers and add up in two limbs.
_EXACT_LIMIT, _LIMBS_LIMIT = 1e18, 1e36
_LIMB_DIGITS = 18
# Values below this have exact moments: their squares add up as decimal(38,0).
_MOMENT_LIMIT = 1e12


def is_finite(c: Column) -> Column:
    """False for null, NaN and infinities (NaN sorts above infinity)."""
    return F.coalesce(F.abs(c) < F.lit(_INF), F.lit(False))


def round_half_away(c: Column, digits: int) -> Column:
    """Round a double half away from zero, after scaling it in binary.

    The scaled double decides, as in the source system.  Spark's own ``round``
    decides on the decimal text of the value and gives other cents near a half.
    """
    scale = float(10**digits)
    scaled = c * F.lit(scale)
    nearest = F.rint(scaled)
    half = F.abs(scaled - nearest) == F.lit(0.5)
    rounded = F.when(half, scaled + F.signum(scaled) * F.lit(0.5)).otherwise(nearest)
    return F.when(F.abs(scaled) < F.lit(_INF), rounded / F.lit(scale)).otherwise(c)


def round_half_even(c: Column, digits: int) -> Column:
    """Round a double half to even after scaling, as array libraries do."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def to_cents(c: Column) -> Column:
    """Amount with two decimals, half up; null when it is missing or not finite."""
    return F.when(is_finite(c), c.try_cast("decimal(38,2)"))


def same_cents(a: Column, b: Column) -> Column:
    """Two amounts agree to the cent; a missing amount agrees with nothing."""
    return F.coalesce(to_cents(a) == to_cents(b), F.lit(False))


def exact_sum(c: Column) -> Column:
    """Sum of doubles that does not depend on the order of the rows.

    Adding doubles in shuffle order moves the last digits from run to run, and at
    10^12 rows that reaches the cents.  Values add up as decimals with nine places; what
    they have above 10^18 adds up as a second limb, so that cents beside 10^20 are kept.
    Only values from 10^36 on, NaN and infinities are added as doubles.
    """
    size = F.abs(c)
    ordinary = size < F.lit(_EXACT_LIMIT)
    whole = F.when(size < F.lit(_LIMBS_LIMIT), c.try_cast("decimal(38,0)"))
    limb = F.lit(10**_LIMB_DIGITS).cast("decimal(19,0)")
    rest = (whole % limb).cast("decimal(18,0)")
    low = F.sum(F.when(ordinary, c.try_cast("decimal(28,9)")).otherwise(rest.cast("decimal(28,9)")))
    high = F.sum(F.when(~ordinary, ((whole - rest) / limb).cast("decimal(18,0)")))
    huge = F.sum(F.when(~(size < F.lit(_LIMBS_LIMIT)), c))

    def total(limbs: Column) -> Column:
        high, low, huge = limbs["high"], limbs["low"], limbs["huge"]
        exact = F.when(high.isNull(), low.cast("double")).otherwise(_from_limbs(high, low))
        return F.when(huge.isNull(), exact).otherwise(huge + F.coalesce(exact, F.lit(0.0)))

    # As a function of one value the sums are named once, not wherever they are used.
    limbs = F.struct(high.alias("high"), low.alias("low"), huge.alias("huge"))
    return F.transform(F.array(limbs), total)[0]


def _from_limbs(high: Column, low: Column) -> Column:
    """``high`` times 10^18 plus ``low``, rounded once, by way of its digits."""
    limb = F.lit(10**_LIMB_DIGITS).cast("decimal(19,0)")
    within = (low % limb).cast("decimal(27,9)")
    whole = high + ((low - within) / limb).cast("decimal(28,0)")
    # Both parts get one sign.
    one = F.lit(1).cast("decimal(1,0)")
    shift = F.when((whole > 0) & (within < 0), one).when((whole < 0) & (within > 0), -one)
    shift = F.coalesce(shift, one - one)
    whole, within = whole - shift, (within + shift * limb).cast("decimal(27,9)")
    width = _LIMB_DIGITS + 1 + 9
    digits = F.lpad(F.abs(within).cast("string"), width, "0")
    return F.when(whole == 0, within.cast("double")).otherwise(
        F.concat(whole.cast("decimal(38,0)").cast("string"), digits).cast("double")
    )


def exact_moments(df: DataFrame, value: Column, **others: Column) -> DataFrame:
    """One row: ``mean`` and population ``stddev``, the same bits in any order of the rows,
    and further aggregates.

    A value, to nine decimals, is a whole part and a fraction; sums of these, of their
    squares and of their product are exact decimals.  From them the squares around the
    mean follow without cancellation, in decimals as well.  Null is left out.  Where a
    value is 10^12 or more, or not finite, both are the usual ones.
    """
    number = value.cast("double")
    x = number.try_cast("decimal(21,9)")
    whole = F.floor(x).cast("decimal(13,0)")
    part = (x - whole).cast("decimal(9,9)")
    sums = df.agg(
        *(c.alias(name) for name, c in others.items()),
        F.count(number).alias("_n"),
        F.max(F.abs(number)).alias("_most"),
        F.avg(number).alias("_mean"), F.stddev_pop(number).alias("_stddev"),
        F.sum(whole).alias("_a"), F.sum(part).alias("_b"),
        F.sum(whole * whole).alias("_aa"), F.sum(whole * part).alias("_ab"),
        F.sum(part * part).alias("_bb"),
    )
    a, b, n = F.col("_a"), F.col("_b"), F.col("_n")
    usual = F.coalesce(F.col("_most") >= F.lit(_MOMENT_LIMIT), F.lit(True))
    near = sums.withColumns({
        "_usual": usual, "_rows": n.cast("decimal(15,0)"),
        "mean": F.when(~usual, (a + b).cast("double") / n),
    }).withColumn("_near", F.col("mean").cast("decimal(21,9)"))
    near = near.withColumn("_base", F.floor("_near").cast("decimal(13,0)")).withColumn(
        "_rest", (F.col("_near") - F.col("_base")).cast("decimal(9,9)")
    )
    rows, base, rest = F.col("_rows"), F.col("_base"), F.col("_rest")
    # Squares of the whole parts, products, and squares of the fractions around the mean.
    around = near.withColumns({
        "_u": F.col("_aa") - base * (a * 2 - rows * base),
        "_v": F.col("_ab") - base * b - rest * a + (rows * base).cast("decimal(27,0)") * rest,
        "_w": F.col("_bb") - rest * (b * 2 - rows * rest),
        "_left": ((a + b) - rows * F.col("_near")).cast("double"),
    })
    u, v, w, left = (F.col(c) for c in ("_u", "_v", "_w", "_left"))
    exact = (u.try_cast("decimal(19,0)") + v.try_cast("decimal(28,9)") * 2
             + w.try_cast("decimal(38,18)")).cast("double")
    squares = F.coalesce(exact, u.cast("double") + v.cast("double") * 2 + w.cast("double"))
    variance = (squares - left * left / n) / n
    return around.select(
        *others,
        F.when(F.col("_usual"), F.col("_mean")).otherwise(F.col("mean")).alias("mean"),
        F.when(F.col("_usual"), F.col("_stddev"))
        .otherwise(F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("stddev"),
    )


def exact_text(amount: Column) -> Column:
    """An amount as it is, not rounded to cents, with two decimals at least.

    The nine decimals that amounts add up with are shown, less the zeros at the end, so
    that no deviation below a cent is hidden.
    """
    full = amount.cast("decimal(38,9)").cast("string")
    return F.regexp_replace(full, r"(\.[0-9]{2}[0-9]*?)0+$", "$1")
