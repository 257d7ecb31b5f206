"""Kinematic scalar functions (K1-K13) as Spark Column expressions.

Every function takes and returns ``Column`` objects, so it stays inside
whole-stage code generation; nothing here runs Python per row.
Divisions are guarded with ``when`` because ANSI mode raises on x/0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from collidex.config import PI_APPROX

__all__ = [
    "p4", "four_vector", "energy", "p4_pt", "p_mag", "cos_theta", "p4_eta",
    "p4_phi", "wrap_phi", "delta_r", "sign3", "transverse_mass", "point_size",
    "met_size", "pixel_x", "pixel_y", "grid_shape", "r6",
]


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


# Offset of the 1e-6 comparison grid. Inputs with at most 7 decimals (the
# fixture's prices and angles) sit at least 2e-8 away from a cell edge, so
# last-bit differences between math libraries never change the cell.
R6_OFFSET = 0.5234567


def r6(x) -> Column:
    """Quantize to the 1e-6 grid with plain IEEE steps; drops a -0.0.

    floor(x*1e6 + 0.5234567)/1e6: any engine doing the same double
    arithmetic gives the same bits (used for cross-engine checks).
    """
    return F.floor(_c(x) * F.lit(1e6) + F.lit(R6_OFFSET)) / F.lit(1e6) + F.lit(0.0)


def r3(x) -> Column:
    """As :func:`r6` on the 1e-3 grid, for sums of many terms."""
    return F.floor(_c(x) * F.lit(1e3) + F.lit(R6_OFFSET)) / F.lit(1e3) + F.lit(0.0)


def four_vector(pt, eta, phi, m=0.0) -> dict[str, Column]:
    """K1: px, py, pz, e from (pt, eta, phi, m); pt is taken as |pt|."""
    pt, eta, phi, m = _c(pt), _c(eta), _c(phi), _c(m)
    apt = F.abs(pt)
    px = apt * F.cos(phi)
    py = apt * F.sin(phi)
    pz = apt * F.sinh(eta)
    return {"px": px, "py": py, "pz": pz, "e": energy(px, py, pz, m)}


def p4(pt, eta, phi, m=0.0) -> Column:
    """K1 as a struct<px, py, pz, e>."""
    v = four_vector(pt, eta, phi, m)
    return F.struct(*[c.alias(k) for k, c in v.items()])


def energy(px, py, pz, m=0.0) -> Column:
    """K2: sqrt(p^2 + m^2) for m >= 0, else sqrt(max(p^2 - m^2, 0))."""
    px, py, pz, m = _c(px), _c(py), _c(pz), _c(m)
    p2 = px * px + py * py + pz * pz
    return F.when(m >= 0, F.sqrt(p2 + m * m)).otherwise(
        F.sqrt(F.greatest(p2 - m * m, F.lit(0.0))))


def p4_pt(px, py) -> Column:
    """K3: transverse momentum."""
    px, py = _c(px), _c(py)
    return F.sqrt(px * px + py * py)


def p_mag(px, py, pz) -> Column:
    """K4: |p|."""
    px, py, pz = _c(px), _c(py), _c(pz)
    return F.sqrt(px * px + py * py + pz * pz)


def cos_theta(px, py, pz) -> Column:
    """K4: pz/|p|, 1.0 when |p| is 0."""
    mag = p_mag(px, py, pz)
    return F.when(mag == 0, F.lit(1.0)).otherwise(_c(pz) / mag)


def p4_eta(px, py, pz) -> Column:
    """K5: pseudorapidity from momentum; 0 if pz = 0, NULL when undefined."""
    c = cos_theta(px, py, pz)
    return (F.when(c * c < 1, F.lit(-0.5) * F.ln((F.lit(1.0) - c) / (F.lit(1.0) + c)))
            .when(_c(pz) == 0, F.lit(0.0)))


def p4_phi(px, py) -> Column:
    """K6: azimuth in (-pi, pi]."""
    return F.atan2(_c(py), _c(px))


def wrap_phi(x, pi_approx: float = PI_APPROX) -> Column:
    """K7: bring x into [-pi_approx, pi_approx) by steps of 2*pi_approx.

    Two explicit steps reproduce step-wise subtraction exactly for
    |x| < 5*pi_approx; larger inputs use the closed form.
    """
    x = _c(x)
    two = 2 * pi_approx

    def step(v):
        return (F.when(v >= pi_approx, v - F.lit(two))
                .when(v < -pi_approx, v + F.lit(two)).otherwise(v))

    closed = x - F.lit(two) * F.floor((x + F.lit(pi_approx)) / F.lit(two))
    return F.when(F.abs(x) < 5 * pi_approx, step(step(x))).otherwise(closed)


def delta_r(eta1, phi1, eta2, phi2, pi_approx: float = PI_APPROX) -> Column:
    """K8: sqrt(deta^2 + dphi^2) with dphi = wrap_phi(phi1 - phi2)."""
    deta = _c(eta1) - _c(eta2)
    dphi = wrap_phi(_c(phi1) - _c(phi2), pi_approx)
    return F.sqrt(deta * deta + dphi * dphi)


def sign3(v) -> Column:
    """K9: -1.0 / 0.0 / 1.0."""
    v = _c(v)
    return F.when(v < 0, F.lit(-1.0)).when(v == 0, F.lit(0.0)).otherwise(F.lit(1.0))


def transverse_mass(met, phi_met, pt, phi) -> Column:
    """2*MET*pt*(1 - cos(phi - phi_met)); no square root (as defined)."""
    return (F.lit(2.0) * _c(met) * _c(pt)
            * (F.lit(1.0) - F.cos(_c(phi) - _c(phi_met))))


def point_size(pt) -> Column:
    """Marker size of a particle, min(ln(max(pt, 1.001))/5, 10)."""
    return F.least(F.ln(F.greatest(_c(pt), F.lit(1.001))) / F.lit(5.0), F.lit(10.0))


def met_size(met) -> Column:
    """Marker size of missing energy; MET <= 0 gives the floor 0.001."""
    met = _c(met)
    return F.when(met > 0, F.least(F.greatest(F.ln(met) / F.lit(5.0), F.lit(0.001)),
                                   F.lit(10.0))).otherwise(F.lit(0.001))


def grid_shape(res: int = 100, max_eta: float = 5.0) -> tuple[int, int, float, float]:
    """(n_eta, n_phi, eta step, phi step) of the event image raster."""
    neta = int(max_eta * res)
    nphi = int(math.pi * res)
    return neta, nphi, 2.0 * max_eta / neta, 2.0 * math.pi / nphi


def pixel_x(eta, res: int = 100, max_eta: float = 5.0) -> Column:
    """Fractional eta pixel coordinate."""
    _, _, eeta, _ = grid_shape(res, max_eta)
    return (_c(eta) + F.lit(float(max_eta))) / F.lit(eeta)


def pixel_y(phi, res: int = 100, max_eta: float = 5.0) -> Column:
    """Fractional phi pixel coordinate (true pi here)."""
    _, _, _, ephi = grid_shape(res, max_eta)
    return (_c(phi) + F.lit(math.pi)) / F.lit(ephi)
