"""Scalar expressions: conditional logs, power transforms and their inverses, normal quantiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOXCOX_LAMBDA = 0.15  # fixed value of the published workflow


def log_where(value: Column, flag: Column) -> Column:
    """Log where the flag is set, the value itself elsewhere."""
    return F.when(flag, F.log(value)).otherwise(value)


def flag(cond: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.when(cond, 1).otherwise(0)


def boxcox1p(x: Column, lam: float | Column) -> Column:
    lam = F.lit(lam) if isinstance(lam, (int, float)) else lam
    return F.when(lam == 0, F.log1p(x)).otherwise((F.pow(1 + x, lam) - 1) / lam)


def inv_boxcox1p(z: Column, lam: float | Column) -> Column:
    lam = F.lit(lam) if isinstance(lam, (int, float)) else lam
    return F.when(lam == 0, F.expm1(z)).otherwise(F.pow(lam * z + 1, 1 / lam) - 1)


def yeo_johnson(x: Column, lam: float | Column) -> Column:
    """Yeo-Johnson power transform (Yeo and Johnson, 2000)."""
    lam = F.lit(float(lam)) if isinstance(lam, (int, float)) else lam
    upper = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    rest = 2 - lam
    lower = F.when(F.abs(rest) < 1e-12, -F.log1p(-x)).otherwise(-(F.pow(1 - x, rest) - 1) / rest)
    return F.when(x >= 0, upper).when(x < 0, lower)


def inv_yeo_johnson(z: Column, lam: float | Column) -> Column:
    lam = F.lit(float(lam)) if isinstance(lam, (int, float)) else lam
    upper = F.when(F.abs(lam) < 1e-12, F.expm1(z)).otherwise(F.pow(lam * z + 1, 1 / lam) - 1)
    rest = 2 - lam
    lower = F.when(F.abs(rest) < 1e-12, 1 - F.exp(-z)).otherwise(1 - F.pow(1 - rest * z, 1 / rest))
    return F.when(z >= 0, upper).when(z < 0, lower)


TARGET_TRANSFORMS = {
    # name -> (forward, inverse); `log` is log1p with its true inverse
    "log": (F.log1p, F.expm1),
    "boxcox": (lambda y: boxcox1p(y, BOXCOX_LAMBDA), lambda z: inv_boxcox1p(z, BOXCOX_LAMBDA)),
    "none": (lambda y: y, lambda z: z),
}


def target_pair(method: str, lam: float | None = None):
    """Forward and inverse expression of a target transform; Yeo-Johnson needs its fitted lambda."""
    if method == "yeojohnson":
        if lam is None:
            raise ValueError("yeojohnson needs a fitted lambda")
        return (lambda y: yeo_johnson(y, lam)), (lambda z: inv_yeo_johnson(z, lam))
    if method not in TARGET_TRANSFORMS:
        raise ValueError(f"unknown target transform {method!r}")
    return TARGET_TRANSFORMS[method]


# Rational approximations of the normal distribution function (Hart, 1968) and of its
# inverse (Wichura, 1988), highest power first.
_HART = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
_HART_BELOW = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831,
               793.826512519948, 440.413735824752)
_CENTRE = (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4, 1.3731693765509461125e4,
           1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080)
_CENTRE_BELOW = (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4, 5.3941960214247511077e3,
                 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0)
_MIDDLE = (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258, 3.64784832476320460504,
           5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734)
_MIDDLE_BELOW = (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
                 6.89767334985100004550e-1, 1.67638483018380384940, 2.05319162663775882187, 1.0)
_TAIL = (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2, 2.96560571828504891230e-1,
         1.78482653991729133580, 5.46378491116411436990, 6.65790464350110377720)
_TAIL_BELOW = (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
               1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0)


def polynomial(powers, x: Column) -> Column:
    """Value of a polynomial, highest power first."""
    out = F.lit(float(powers[0]))
    for p in powers[1:]:
        out = out * x + F.lit(float(p))
    return out


def normal_cdf(z: Column | str) -> Column:
    """Standard normal distribution function, to about 15 digits; generated code, no Python."""
    z = F.col(z) if isinstance(z, str) else z
    x = F.abs(z)
    bell = F.exp(-x * x / 2)
    far = x
    for i in (0.65, 4, 3, 2, 1):
        far = x + (F.lit(0.65) if i == 0.65 else F.lit(float(i)) / far)
    upper = F.when(x < 7.07106781186547, bell * polynomial(_HART, x) / polynomial(_HART_BELOW, x)).otherwise(bell / far / 2.506628274631)
    return F.when(F.isnan(z), None).when(z > 0, 1 - upper).otherwise(upper)


def with_normal_quantile(df: DataFrame, p: Column, out: str) -> DataFrame:
    """`df` with the inverse of the standard normal distribution at p, to about 15 digits; null outside (0, 1).

    What the polynomials share is a projection of its own: as one expression it would be written out for each power.
    """
    q, near, r, far = (F.col(c) for c in ("__q", "__near", "__r", "__far"))
    staged = df.withColumn("__p", p).withColumn("__q", F.col("__p") - 0.5)
    staged = staged.withColumns({"__near": 0.180625 - q * q, "__r": F.sqrt(-F.log(F.least(F.col("__p"), 1 - F.col("__p")))) - 1.6})
    staged = staged.withColumn("__far", F.col("__r") - 3.4)
    tail = F.when(far <= 0, polynomial(_MIDDLE, r) / polynomial(_MIDDLE_BELOW, r)).otherwise(polynomial(_TAIL, far) / polynomial(_TAIL_BELOW, far))
    staged = staged.withColumn("__tail", tail)
    value = (F.when(F.abs(q) <= 0.425, q * polynomial(_CENTRE, near) / polynomial(_CENTRE_BELOW, near))
             .when(q < 0, -F.col("__tail")).otherwise(F.col("__tail")))
    return staged.withColumn(out, F.when((F.col("__p") > 0) & (F.col("__p") < 1), value)).drop("__p", "__q", "__near", "__r", "__far", "__tail")


def digamma(x: Column | str) -> Column:
    """Derivative of the logarithm of the gamma function for x >= 1, to about 12 digits."""
    x = F.col(x) if isinstance(x, str) else x
    z = x + 8
    w = 1 / (z * z)
    series = F.log(z) - 1 / (2 * z) - w * (1 / 12 - w * (1 / 120 - w * (1 / 252 - w * (1 / 240 - w / 132))))
    return series - sum((1 / (x + i) for i in range(1, 8)), 1 / x)
