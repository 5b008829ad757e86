"""Distribution functions that Spark does not have, as SQL text built from SQL text."""

from __future__ import annotations

import math

from skyfold.functions.curves import bound

# Numerator and denominator of Hart's rational form of the normal
# tail, highest power first (Hart 1968, as given by West 2005).
NORMAL_TOP = (
    0.0352624965998911,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
)
NORMAL_BOTTOM = (
    0.0883883476483184,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
)
NORMAL_SWITCH = 7.07106781186547


def number(value: float) -> str:
    """A double literal."""
    return f"{value!r}D"


def _horner(x: str, coefficients: tuple[float, ...]) -> str:
    value = number(coefficients[0])
    for c in coefficients[1:]:
        value = f"({value}*{x} + {number(c)})"
    return value


def normal_tail(x: str) -> str:
    """P(Z > x) for x >= 0, to about 1e-15."""
    density = f"exp(-{x}*{x}/2D)"
    near = f"{density}*{_horner(x, NORMAL_TOP)}/{_horner(x, NORMAL_BOTTOM)}"
    # Beyond the switch a continued fraction converges in a few terms.
    fraction = f"({x} + 0.65D)"
    for k in (4, 3, 2, 1):
        fraction = f"({x} + {k}D/{fraction})"
    far = f"{density}/{fraction}/{number(math.sqrt(2.0 * math.pi))}"
    return f"if({x} < {number(NORMAL_SWITCH)}, {near}, {far})"


def log_normal_cdf(x: str) -> str:
    """ln P(Z <= x), kept accurate in both tails."""
    tail = normal_tail(f"abs({x})")
    return f"if({x} < 0, ln({tail}), log1p(-({tail})))"


# Lanczos coefficients for g = 7, nine terms.
LANCZOS = (
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
)


def log_gamma(a: str) -> str:
    """ln Gamma(a) for a >= 0.5."""
    series = " + ".join(
        [number(LANCZOS[0]), *(f"({number(c)})/({a} + {i}D)" for i, c in enumerate(LANCZOS[1:]))]
    )
    base = f"({a} + 6.5D)"
    return f"({number(0.5 * math.log(2.0 * math.pi))} + ({a} - 0.5D)*ln{base} - {base} + ln({series}))"


def regularized_gamma(a: str, x: str) -> str:
    """P(a, x), the lower regularized incomplete gamma function.

    Below a + 1 the power series is folded, above it the continued fraction of
    the upper tail, from the innermost level outwards.  Both take 10*sqrt(a) + 60
    terms, so the number of terms follows the number of epochs and no curve is
    cut short.
    """
    terms = "sequence(1, int(sqrt(ga)*10) + 60)"
    front = f"exp(ga*ln(gx) - gx - {log_gamma('ga')})"
    series = (
        f"aggregate({terms}, struct(1/ga as term, 1/ga as sum), "
        "(s, k) -> struct(s.term*gx/(ga + k) as term, s.sum + s.term*gx/(ga + k) as sum), s -> s.sum)"
    )
    fraction = (
        f"aggregate(reverse({terms}), gx + 2*(int(sqrt(ga)*10) + 60) + 1 - ga, "
        "(s, k) -> gx + (2*k - 1) - ga + k*(ga - k)/s)"
    )
    value = f"case when gx <= 0 then 0D when gx < ga + 1 then {front}*{series} else 1 - {front}/{fraction} end"
    return bound("ga", a, bound("gx", x, value))


def chi_square_cdf(x: str, degrees: str) -> str:
    return regularized_gamma(f"({degrees}/2D)", f"({x}/2D)")
