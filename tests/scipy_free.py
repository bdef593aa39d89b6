"""Student's t tail by the finite series for whole degrees of freedom."""

import math


def two_sided_t(t: float, df: int) -> float:
    theta = math.atan2(abs(t), math.sqrt(df))
    s, c = math.sin(theta), math.cos(theta)
    if df > 1000:  # close to normal: use the expansion in 1/df to second order
        z = abs(t)
        phi = math.exp(-z * z / 2) / math.sqrt(2 * math.pi)
        g1 = (z ** 3 + z) / 4
        g2 = (3 * z ** 7 - 7 * z ** 5 - 5 * z ** 3 - 3 * z) / 96  # of 5 z^5 + 16 z^3 + 3 z for quantiles
        return math.erfc(z / math.sqrt(2)) + 2 * phi * (g1 / df + g2 / df ** 2)
    if df % 2:
        term, total = c, c if df > 1 else 0.0
        for k in range(3, df - 1, 2):
            term *= c * c * (k - 1) / k
            total += term
        inside = 2 / math.pi * (theta + s * total)
    else:
        term, total = 1.0, 1.0
        for k in range(2, df - 1, 2):
            term *= c * c * (k - 1) / k
            total += term
        inside = s * total
    return 1 - inside
