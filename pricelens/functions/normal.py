"""Standard normal CDF, log-CDF and inverse CDF as native Spark expressions.

Spark SQL has no ``erf``; these stay inside whole-stage codegen instead of a
Python UDF.  Both are published approximations:

* complementary error function, Chebyshev fit with fractional error below
  1.2e-7 everywhere (Numerical Recipes, ``erfcc``); written in log space so
  the far tails do not underflow;
* inverse normal CDF by Wichura's algorithm AS241 (Applied Statistics 37,
  1988), the same rational approximation Python's ``statistics`` uses.
"""

from __future__ import annotations

import math

import numpy as np

from pyspark.sql import Column
from pyspark.sql import functions as F

# Erfc Chebyshev coefficients (highest power last).
_ERFC_COEF = [
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
]

# Coefficients of Wichura's AS241 (PPND16), highest power
# first, for the central region (|p - 0.5| <= 0.425), the intermediate tail
# (r <= 5) and the far tail.
_CENTRAL_NUM = [2.5090809287301226727e+3, 3.3430575583588128105e+4, 6.7265770927008700853e+4,
                4.5921953931549871457e+4, 1.3731693765509461125e+4, 1.9715909503065514427e+3,
                1.3314166789178437745e+2, 3.3871328727963666080e+0]
_CENTRAL_DEN = [5.2264952788528545610e+3, 2.8729085735721942674e+4, 3.9307895800092710610e+4,
                2.1213794301586595867e+4, 5.3941960214247511077e+3, 6.8718700749205790830e+2,
                4.2313330701600911252e+1, 1.0]
_MID_NUM = [7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1,
            1.27045825245236838258e+0, 3.64784832476320460504e+0, 5.76949722146069140550e+0,
            4.63033784615654529590e+0, 1.42343711074968357734e+0]
_MID_DEN = [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
            1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e+0,
            2.05319162663775882187e+0, 1.0]
_FAR_NUM = [2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3,
            2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e+0,
            5.46378491116411436990e+0, 6.65790464350110377720e+0]
_FAR_DEN = [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5,
            7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
            5.99832206555887937690e-1, 1.0]

_SQRT1_2 = 1.0 / math.sqrt(2.0)


def _horner(coefs, x: Column) -> Column:
    acc = F.lit(coefs[-1])
    for k in reversed(coefs[:-1]):
        acc = acc * x + F.lit(k)
    return acc


def _log_erfc_nonneg(u: Column) -> Column:
    """ln(erfc(u)) for u >= 0."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * u)
    return F.log(t) - u * u + _horner(_ERFC_COEF, t)


def log_ndtr(z: Column) -> Column:
    """ln Φ(z), accurate in both tails."""
    u_neg = -z * F.lit(_SQRT1_2)  # >= 0 when z <= 0
    lower = F.lit(math.log(0.5)) + _log_erfc_nonneg(u_neg)
    upper = F.log1p(F.lit(-0.5) * F.exp(_log_erfc_nonneg(z * F.lit(_SQRT1_2))))
    return F.when(z < 0, lower).otherwise(upper)


def log_ndtr_upper(z: Column) -> Column:
    """ln(1 - Φ(z))."""
    return log_ndtr(-z)


def ndtr(z: Column) -> Column:
    """Φ(z)."""
    return F.exp(log_ndtr(z))


def ndtri(p: Column) -> Column:
    """Φ⁻¹(p) for 0 < p < 1 (AS241, about 1e-16 relative)."""
    def poly(coefs_high_first, x):
        return _horner(list(reversed(coefs_high_first)), x)

    q = p - F.lit(0.5)
    r_c = F.lit(0.180625) - q * q
    central = q * poly(_CENTRAL_NUM, r_c) / poly(_CENTRAL_DEN, r_c)
    r = F.sqrt(-F.log(F.when(q <= 0, p).otherwise(F.lit(1.0) - p)))
    mid = poly(_MID_NUM, r - F.lit(1.6)) / poly(_MID_DEN, r - F.lit(1.6))
    far = poly(_FAR_NUM, r - F.lit(5.0)) / poly(_FAR_DEN, r - F.lit(5.0))
    tail = F.when(r <= 5.0, mid).otherwise(far)
    return F.when(F.abs(q) <= 0.425, central).otherwise(F.when(q < 0, -tail).otherwise(tail))


def ndtri_array(p: np.ndarray) -> np.ndarray:
    """Φ⁻¹ of an array with 0 < p < 1 (AS241), for Arrow functions: as a column
    expression its polynomials overflow a generated method."""
    q = p - 0.5
    r = 0.180625 - q * q
    out = q * np.polyval(_CENTRAL_NUM, r) / np.polyval(_CENTRAL_DEN, r)
    tail = np.abs(q) > 0.425
    r = np.sqrt(-np.log(np.where(q[tail] <= 0, p[tail], 1.0 - p[tail])))
    mid = np.polyval(_MID_NUM, r - 1.6) / np.polyval(_MID_DEN, r - 1.6)
    far = np.polyval(_FAR_NUM, r - 5.0) / np.polyval(_FAR_DEN, r - 5.0)
    out[tail] = np.sign(q[tail]) * np.where(r <= 5.0, mid, far)
    return out


# -- staged forms -----------------------------------------------------------
# Horner evaluation repeats its argument once per coefficient; when the
# argument is itself a large expression, the inlined tree grows until the
# generated Java no longer compiles.  The staged forms below put every
# intermediate in its own projected column (projections that reference a
# non-trivial alias several times are not collapsed by the optimizer), so
# each polynomial is evaluated on a plain column reference.

def with_log_ndtr_pair(df, z: Column, lower: str, upper: str, tmp: str = "_nd"):
    """Add ``lower`` = ln Φ(z) and ``upper`` = ln(1 - Φ(z))."""
    az, t, le, zz = f"{tmp}_u", f"{tmp}_t", f"{tmp}_le", f"{tmp}_z"
    out = df.withColumn(zz, z)
    out = out.withColumn(az, F.abs(F.col(zz)) * F.lit(_SQRT1_2))
    out = out.withColumn(t, F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * F.col(az)))
    out = out.withColumn(le, F.log(F.col(t)) - F.col(az) * F.col(az) + _horner(_ERFC_COEF, F.col(t)))
    small = F.lit(math.log(0.5)) + F.col(le)                   # ln Φ(-|z|)
    big = F.log1p(F.lit(-0.5) * F.exp(F.col(le)))              # ln Φ(|z|)
    out = out.withColumn(lower, F.when(F.col(zz) < 0, small).otherwise(big))
    out = out.withColumn(upper, F.when(F.col(zz) > 0, small).otherwise(big))
    return out.drop(az, t, le, zz)
