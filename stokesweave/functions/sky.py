"""Spherical geometry as native column expressions (all angles in degrees)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stokesweave.functions.numeric import as_col

# J2000 orientation of the Galactic frame (published IAU values): RA and Dec of
# the north Galactic pole, and the Galactic longitude of the celestial pole.
GALACTIC_POLE_RA = 192.85948
GALACTIC_POLE_DEC = 27.12825
CELESTIAL_POLE_L = 122.93192


def wrap360(angle: Column) -> Column:
    return F.pmod(angle, F.lit(360.0))


def wrap180(angle: Column) -> Column:
    """Wrap into [-180, 180)."""
    return F.pmod(angle + 180.0, F.lit(360.0)) - 180.0


def sep_deg(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle separation (haversine form, accurate for small angles)."""
    ra1, dec1, ra2, dec2 = map(as_col, (ra1, dec1, ra2, dec2))
    half_dec = F.sin(F.radians(dec2 - dec1) / 2.0)
    half_ra = F.sin(F.radians(ra2 - ra1) / 2.0)
    hav = half_dec * half_dec + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * half_ra * half_ra
    return F.degrees(2.0 * F.asin(F.sqrt(F.least(F.lit(1.0), hav))))


def position_angle(ra1, dec1, ra2, dec2) -> Column:
    """Bearing of point 2 seen from point 1, east of north, in [0, 360)."""
    ra1, dec1, ra2, dec2 = map(as_col, (ra1, dec1, ra2, dec2))
    dra = F.radians(ra2 - ra1)
    east = F.sin(dra) * F.cos(F.radians(dec2))
    north = F.cos(F.radians(dec1)) * F.sin(F.radians(dec2)) - F.sin(F.radians(dec1)) * F.cos(
        F.radians(dec2)
    ) * F.cos(dra)
    return wrap360(F.degrees(F.atan2(east, north)))


def offset_by(ra, dec, angle, sep) -> tuple[Column, Column]:
    """Destination (ra, dec) after moving ``sep`` along bearing ``angle``."""
    ra, dec, angle, sep = map(as_col, (ra, dec, angle, sep))
    d, pa, s = F.radians(dec), F.radians(angle), F.radians(sep)
    sin_out = F.sin(d) * F.cos(s) + F.cos(d) * F.sin(s) * F.cos(pa)
    sin_out = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sin_out))
    dra = F.atan2(F.sin(pa) * F.sin(s) * F.cos(d), F.cos(s) - F.sin(d) * sin_out)
    return wrap360(ra + F.degrees(dra)), F.degrees(F.asin(sin_out))


def lm_rotated(sep, angle, pol_axis) -> tuple[Column, Column]:
    """Tile offsets (l, m) in the footprint frame, rotated by 45 deg + pol_axis."""
    sep, angle, pol_axis = map(as_col, (sep, angle, pol_axis))
    turned = F.radians(angle - (pol_axis + 45.0))
    return sep * F.sin(turned), sep * F.cos(turned)


def to_galactic(ra, dec) -> tuple[Column, Column]:
    """Galactic (l, b) of an ICRS position."""
    ra, dec = as_col(ra), as_col(dec)
    d, dra, pole = F.radians(dec), F.radians(ra - GALACTIC_POLE_RA), F.radians(F.lit(GALACTIC_POLE_DEC))
    sin_b = F.sin(d) * F.sin(pole) + F.cos(d) * F.cos(pole) * F.cos(dra)
    lon = CELESTIAL_POLE_L - F.degrees(
        F.atan2(F.cos(d) * F.sin(dra), F.sin(d) * F.cos(pole) - F.cos(d) * F.sin(pole) * F.cos(dra))
    )
    return wrap360(lon), F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sin_b))))


def _toward_zero(c: Column) -> Column:
    return F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)).cast("double")


def sexagesimal(value: Column) -> tuple[Column, Column, Column]:
    """Whole units, minutes and seconds of a decimal value, truncating toward zero."""
    whole = _toward_zero(value)
    minutes = (value - whole) * 60.0
    whole_minutes = _toward_zero(minutes)
    return whole, whole_minutes, (minutes - whole_minutes) * 60.0


def hms(ra) -> tuple[Column, Column, Column]:
    """Hours, minutes, seconds of a right ascension in degrees."""
    return sexagesimal(as_col(ra) * F.lit(24.0 / 360.0))


def dms(dec) -> tuple[Column, Column, Column]:
    """Degrees, arcminutes, arcseconds; minutes and seconds carry the sign."""
    return sexagesimal(as_col(dec))


def coord_strings(ra, dec) -> tuple[Column, Column]:
    """``hh:mm:ss.sss`` and ``dd:mm:ss.ss`` text."""
    h, hm, hs = hms(ra)
    d, dm, ds = dms(dec)
    return (
        F.format_string("%02.0f:%02.0f:%06.3f", h, hm, hs),
        F.format_string("%02.0f:%02.0f:%05.2f", d, F.abs(dm), F.abs(ds)),
    )


def sin_plane(ra, dec, ra0, dec0) -> tuple[Column, Column]:
    """Orthographic (SIN) plane offsets in degrees; NULL beyond the horizon."""
    ra, dec, ra0, dec0 = map(as_col, (ra, dec, ra0, dec0))
    d, d0, dra = F.radians(dec), F.radians(dec0), F.radians(ra - ra0)
    visible = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(dra) >= 0
    east = F.degrees(F.cos(d) * F.sin(dra))
    north = F.degrees(F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(dra))
    return F.when(visible, east), F.when(visible, north)


def sin_project(ra, dec, ra0, dec0, npix: int = 512, map_size: float = 8.0) -> tuple[Column, Column]:
    """0-based pixel coordinates on an npix x npix SIN map of ``map_size`` degrees.

    The reference pixel is npix/2 counted from one and both axes grow with the
    coordinate (x is mirrored for display later).
    """
    cdelt = map_size / npix
    east, north = sin_plane(ra, dec, ra0, dec0)
    origin = npix / 2 - 1.0
    return east / cdelt + origin, north / cdelt + origin


def sin_deproject(x, y, ra0, dec0, npix: int = 512, map_size: float = 8.0) -> tuple[Column, Column]:
    """Inverse of :func:`sin_project`; NULL outside the sphere's disc."""
    x, y, ra0, dec0 = map(as_col, (x, y, ra0, dec0))
    cdelt = map_size / npix
    east, north = F.radians((x - (npix / 2 - 1.0)) * cdelt), F.radians((y - (npix / 2 - 1.0)) * cdelt)
    rho2 = east * east + north * north
    inside = rho2 <= 1.0
    cos_c = F.sqrt(F.greatest(F.lit(0.0), 1.0 - rho2))
    d0 = F.radians(dec0)
    dec = F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos_c * F.sin(d0) + north * F.cos(d0)))))
    ra = wrap360(ra0 + F.degrees(F.atan2(east, F.cos(d0) * cos_c - north * F.sin(d0))))
    return F.when(inside, ra), F.when(inside, dec)
