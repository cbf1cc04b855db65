"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME = "transit_time_days"
COST = "shipping_cost_usd"
METRICS = (TIME, COST)
DIGITS = 6


def r6(c) -> Column:
    """Round a floating output to the comparison precision (6 digits).

    Written as round(x * 1e6) / 1e6 (half away from zero on the scaled
    double), the same IEEE steps SQL engines take, so exact ties round alike.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") * F.lit(1e6)) / F.lit(1e6)


def r9(c) -> Column:
    """Rounding for order statistics (percentiles, fences): 9 digits.

    Order statistics of values with <= 6 decimals, interpolated at quarter
    positions, have <= 8-9 decimals, so 9-digit rounding never meets an exact
    tie; they carry no summation drift, so the extra digits are stable.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") * F.lit(1e9)) / F.lit(1e9)


def exact_avg(c) -> Column:
    """Mean from an exact DECIMAL(38,7) sum (cost values carry <= 7 decimals).

    The sum is exact and its conversion and the division are each correctly
    rounded, so every engine produces the same double (exact ties included).
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast("decimal(38,7)")).cast("double") / F.count(c)


def counted_avg(c, n, near) -> Column:
    """Mean over rows that stand for ``n`` equal ones each, taken from the distances to a value ``near`` it."""
    c, n, near = (F.col(x) if isinstance(x, str) else x for x in (c, n, near))
    return F.max(near) + F.sum(n * (c - near)) / F.sum(F.when(c.isNotNull(), n))


def counted_squares(c, n, mean) -> Column:
    """Sum of squares around the mean over rows that stand for ``n`` equal ones each; ``mean`` is close to
    it, so nothing cancels."""
    c, n, mean = (F.col(x) if isinstance(x, str) else x for x in (c, n, mean))
    d = c - mean
    left = F.sum(n * d * d) - F.sum(n * d) * F.sum(n * d) / F.sum(F.when(c.isNotNull(), n))
    return F.greatest(left, F.lit(0.0))


def cnt(c=None) -> Column:
    """count(*) or count(col) as BIGINT."""
    return (F.count(F.lit(1)) if c is None else F.count(c)).cast("long")


def sorted_list(c) -> Column:
    """Sorted distinct values of a small-domain column as 'a,b,c' (bounded set)."""
    return F.array_join(F.transform(F.array_sort(F.collect_set(c)), lambda v: v.cast("string")), ",")


# ------------------------------------------------- normal distribution as SQL text
# Rational approximations of the normal quantile (Wichura 1988, AS 241) and of the
# upper tail (Hill 1973, AS 66).
PROBIT_MID = ([3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
               4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3],
              [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4,
               3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3])
PROBIT_TAIL = ([1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
                1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4],
               [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1,
                1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9])
TAIL_NEAR = (0.398942280444, 0.39990348504, 5.75885480458, -29.8213557807, 2.62433121679, 48.6959930692, 5.92885724438)
TAIL_FAR = (0.398942280385, [(-3.8052e-8, 1.00000615302), (3.98064794e-4, 1.98615381364), (-0.151679116635, 5.29330324926),
                             (4.8385912808, -15.1508972451), (0.742380924027, 30.789933034)], 3.99019417011)


def polynomial(coefficients, x: str) -> str:
    """SQL text of c0 + c1 x + c2 x^2 ... (Horner)."""
    out = f"{float(coefficients[-1])!r}e0" if "e" not in repr(float(coefficients[-1])) else repr(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        c = repr(float(c))
        out = f"({c if 'e' in c else c + 'e0'} + {x} * {out})"
    return out


def normal_quantile(p: str) -> str:
    """SQL text of the normal quantile of ``p`` (a column name), to about 16 digits for 1e-10 < p < 1 - 1e-10."""
    q = f"({p} - 0.5e0)"
    mid, tail = f"(0.180625e0 - {q} * {q})", f"(sqrt(-ln(least({p}, 1e0 - {p}))) - 1.6e0)"
    return (f"CASE WHEN abs({q}) <= 0.425e0 THEN {q} * {polynomial(PROBIT_MID[0], mid)} / {polynomial(PROBIT_MID[1], mid)} "
            f"ELSE sign({q}) * {polynomial(PROBIT_TAIL[0], tail)} / {polynomial(PROBIT_TAIL[1], tail)} END")


def normal_upper(z: str) -> str:
    """SQL text of the probability above ``z`` (a column name), to 3e-8."""
    x, num = f"abs({z})", lambda v: f"({v!r})" if "e" in repr(v) else f"({v!r}e0)"
    p, q, a1, b1, a2, b2, a3 = map(num, TAIL_NEAR)
    y = f"(0.5e0 * {z} * {z})"
    near = f"0.5e0 - {x} * ({p} - {q} * {y} / ({y} + {a1} + {b1} / ({y} + {a2} + {b2} / ({y} + {a3}))))"
    r, steps, last = TAIL_FAR
    far = f"({x} + {num(last)})"
    for c, d in reversed(steps):
        far = f"({x} + {num(c)} + {num(d)} / {far})"
    up = f"CASE WHEN {x} <= 1.28e0 THEN {near} ELSE {num(r)} * exp(-{y}) / {far} END"
    return f"CASE WHEN {z} >= 0 THEN {up} ELSE 1e0 - ({up}) END"
