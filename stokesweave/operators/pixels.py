"""Image cubes as long tables: (source, beam, stokes, chan, y, x, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stokesweave.functions.numeric import as_col, finite, ratio
from stokesweave.functions.sky import offset_by, position_angle, sep_deg, sin_plane
from stokesweave.operators.clipping import clip_limits
from stokesweave.operators.keyed import HOT_ROWS, skew_join, small_side, with_scalars
from stokesweave.operators.orderstats import grouped_median, mad_std

TILE = 64


def cutout(
    pixels: DataFrame,
    boxes: DataFrame,
    keys: Sequence[str] = (),
    tile: int = TILE,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Pixels inside each box (x_lo <= x < x_hi, y_lo <= y < y_hi).

    A band join as an equi-join: boxes are repeated over the tiles they touch,
    pixels belong to one tile.  ``keys`` are shared columns such as the field.
    """
    keys = list(keys)

    def tiles(lo: str, hi: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(lo) / tile), F.floor((F.col(hi) - 1) / tile)))

    probe = (
        boxes.where((F.col("x_hi") > F.col("x_lo")) & (F.col("y_hi") > F.col("y_lo")))
        .withColumn("_tx", tiles("x_lo", "x_hi"))
        .withColumn("_ty", tiles("y_lo", "y_hi"))
    )
    home = pixels.withColumn("_tx", F.floor(F.col("x") / tile)).withColumn("_ty", F.floor(F.col("y") / tile))
    inside = (
        (F.col("x") >= F.col("x_lo"))
        & (F.col("x") < F.col("x_hi"))
        & (F.col("y") >= F.col("y_lo"))
        & (F.col("y") < F.col("y_hi"))
    )
    return skew_join(probe, home, [*keys, "_tx", "_ty"], inside, hot_rows).drop("_tx", "_ty")


#: columns of an image's place on the sky, as its header has them; reference pixels count from one
WCS = ("ra0", "dec0", "crpix_x", "crpix_y", "cdelt_x", "cdelt_y", "nx", "ny")


def sky_to_pixel(ra, dec) -> tuple[Column, Column]:
    """Fractional pixel, counted from zero, of a position on the SIN image of the row's ``WCS`` columns; NULL beyond its horizon."""
    east, north = sin_plane(ra, dec, "ra0", "dec0")
    return east / F.col("cdelt_x") + F.col("crpix_x") - 1.0, north / F.col("cdelt_y") + F.col("crpix_y") - 1.0


def pixel_boxes(boxes: DataFrame, images: DataFrame, on: str | Sequence[str], beam: str = "beam_maj", pad: float = 3.0) -> DataFrame:
    """Pixel box of every source's sky box (``dec_low, dec_high, ra_left, ra_right``) on each image joined by ``on``.

    The corners move out by ``pad`` beams along the diagonals and are projected; the box runs from the floor of the least to the ceiling of
    the greatest of all four, since near a pole the left corners need not be on the left.  It ends at the image; boxes with a
    corner beyond the image's horizon, or without a pixel in the image, have no row.  Returns the columns of both tables and ``x_lo, x_hi, y_lo,
    y_hi`` as :func:`cutout` takes them.
    """
    out_by = F.col(beam) * F.lit(pad) * F.sqrt(F.lit(2.0))
    joined = boxes.join(images, on)
    corners = [("ra_right", "dec_high", -45.0), ("ra_left", "dec_low", 135.0), ("ra_left", "dec_high", 45.0), ("ra_right", "dec_low", -135.0)]
    sky = F.array(*[F.struct(F.col(ra).alias("ra"), F.col(dec).alias("dec"), F.lit(angle).alias("angle")) for ra, dec, angle in corners])

    def pixel(c: Column) -> Column:
        x, y = sky_to_pixel(*offset_by(c["ra"], c["dec"], c["angle"], out_by))
        return F.struct(x.alias("x"), y.alias("y"))

    placed = joined.withColumn("_c", F.transform(sky, pixel))
    seen = placed.where(~F.exists("_c", lambda c: c["x"].isNull() | c["y"].isNull()))
    ends = {}
    for a, n in (("x", "nx"), ("y", "ny")):
        along = F.col(f"_c.{a}")  # of all corners
        ends[f"{a}_lo"] = F.greatest(F.floor(F.array_min(along)), F.lit(0)).cast("int")
        ends[f"{a}_hi"] = F.least(F.ceil(F.array_max(along)), F.col(n)).cast("int")
    return seen.withColumns(ends).where("x_lo < x_hi AND y_lo < y_hi").drop("_c")


def pixel_lookup(pixels: DataFrame, coords: DataFrame, on: Sequence[str] = ("source_id",)) -> DataFrame:
    """Pixel rows (a spectrum) nearest to each coordinate.

    ``coords`` carries fractional pixel positions ``px`` and ``py``; ties go to
    the even pixel as in numerical rounding.
    """
    at = coords.withColumns({"x": F.rint("px").cast("int"), "y": F.rint("py").cast("int")})
    return at.join(pixels, [*on, "y", "x"])


def annulus(pixels: DataFrame, pix_per_beam: float | Column, nx: int | Column, ny: int | Column) -> DataFrame:
    """Finite pixels between 1.5 and 5 beam widths from the image centre."""
    beam = pix_per_beam if isinstance(pix_per_beam, Column) else F.lit(float(pix_per_beam))
    cx, cy = (F.floor((n if isinstance(n, Column) else F.lit(n)) / 2) for n in (nx, ny))
    r = F.hypot(F.col("x") - cx, F.col("y") - cy)
    return pixels.where((r > 1.5 * beam) & (r < 5.0 * beam) & finite("value"))


def annulus_noise(
    pixels: DataFrame,
    keys: Sequence[str],
    pix_per_beam: float | Column,
    nx: int | Column,
    ny: int | Column,
    sigma: float = 3.0,
    clip: bool = True,
) -> DataFrame:
    """Background (mean) and noise (population deviation) in the annulus.

    With ``clip`` the sample is first clipped at ``sigma`` deviations about its
    mean until nothing changes; groups of any size are handled.
    """
    keys = list(keys)
    ring = annulus(pixels, pix_per_beam, nx, ny)
    if clip:
        lim = clip_limits(ring, keys, "value", sigma, "mean", "std").select(
            *keys, F.col("lo").alias("_lo"), F.col("hi").alias("_hi")
        )
        ring = ring.join(lim, keys).where(F.col("value").between(F.col("_lo"), F.col("_hi")))
    return ring.groupBy(*keys).agg(
        F.avg("value").alias("background"), F.stddev_pop("value").alias("noise"), F.count(F.lit(1)).alias("n")
    )


def channel_rms(pixels: DataFrame, keys: Sequence[str] = ("stokes", "chan")) -> DataFrame:
    """Robust noise of every channel plane, ignoring missing pixels."""
    return mad_std(pixels, keys, "value", few_groups=False).select(*keys, F.col("mad_std").alias("rms"))


def channel_weights(rms: DataFrame, col: str = "rms") -> DataFrame:
    """Inverse-variance weight; NULL for a plane without noise estimate."""
    return rms.withColumn("weight", ratio(F.lit(1.0), F.col(col) * F.col(col)))


def coadd(
    pixels: DataFrame,
    keys: Sequence[str] = ("source_id", "stokes", "chan", "y", "x"),
    value: str = "value",
    weight: str = "weight",
) -> DataFrame:
    """Weighted mosaic of all beams or fields on a common grid."""
    ok = finite(value) & finite(weight)
    w = F.when(ok, F.col(weight))
    sums = pixels.groupBy(*keys).agg(F.sum(w * F.col(value)).alias("_wv"), F.sum(w).alias("weight"))
    return sums.select(*keys, ratio("_wv", "weight").alias("value"), "weight")


def holography_pixel(
    sources: DataFrame, beams: DataFrame, inc_x: float, inc_y: float, ref_x: float, ref_y: float, on: str = "beam"
) -> DataFrame:
    """Source offset from its beam centre and the holography pixel it falls on.

    ``beams`` carries ``beam_ra`` and ``beam_dec``; pixel sizes are in radians.
    """
    j = sources.join(small_side(beams), on)
    off = sep_deg("beam_ra", "beam_dec", "ra", "dec")
    ang = position_angle("beam_ra", "beam_dec", "ra", "dec")
    x = F.rint(F.sin(F.radians(off)) * F.sin(F.radians(ang)) / inc_x + ref_x).cast("int")
    y = F.rint(F.sin(F.radians(off)) * F.cos(F.radians(ang)) / inc_y + ref_y).cast("int")
    return j.withColumns({"offset": off, "angle": ang, "hx": x, "hy": y})


def holography_lookup(located: DataFrame, holography: DataFrame, on: str = "beam") -> DataFrame:
    """Join the model leakage at each source's holography pixel.

    ``holography`` is long: (beam, stokes, chan, y, x, value).
    """
    model = holography.select(
        on, "stokes", "chan", F.col("y").alias("hy"), F.col("x").alias("hx"), F.col("value").alias("leakage")
    )
    return located.join(small_side(model), [on, "hy", "hx"])


def compare_leakage(measured: DataFrame, model: DataFrame, on: Sequence[str]) -> DataFrame:
    """Measured and model Q/I, U/I side by side with their differences."""
    m = measured.select(*on, ratio("q", "i").alias("q_image"), ratio("u", "i").alias("u_image"))
    h = model.select(*on, F.col("q").alias("q_holo"), F.col("u").alias("u_holo"))
    return m.join(h, list(on)).withColumns(
        {"dq": F.col("q_image") - F.col("q_holo"), "du": F.col("u_image") - F.col("u_holo")}
    )


def remove_leakage(pixels: DataFrame, leakage: DataFrame, on: Sequence[str] = ("beam", "stokes", "chan")) -> DataFrame:
    """Subtract I times leakage from the polarised planes before co-adding.

    ``pixels`` carries ``stokes_i`` beside ``value``; planes without a leakage
    entry are left alone.
    """
    j = pixels.join(leakage.select(*on, "leakage"), list(on), "left")
    return j.withColumn("value", F.col("value") - F.coalesce(F.col("stokes_i") * F.col("leakage"), F.lit(0.0))).select(
        pixels.columns
    )


def same_angle_check(headers: DataFrame, source: str = "source_id", angle: str = "pol_angle", tol: float = 1e-6) -> DataFrame:
    """TRUE per source when all its beams share the polarisation angle."""
    return headers.groupBy(source).agg(((F.max(angle) - F.min(angle)) <= tol).alias("same_angle"))


def stack_stokes(*planes: tuple[str, DataFrame]) -> DataFrame:
    """Separate Stokes cubes as one table with a ``stokes`` column."""
    parts = [df.withColumn("stokes", F.lit(name)) for name, df in planes]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stokes_complete(pixels: DataFrame, keys: Sequence[str], wanted: Sequence[str] = ("i", "q", "u")) -> DataFrame:
    """Cubes with the flag whether every wanted Stokes is present.

    The set of Stokes names has at most a handful of members.
    """
    have = pixels.where(F.col("stokes").isin(list(wanted))).groupBy(*keys).agg(F.collect_set("stokes").alias("_s"))
    return have.select(*keys, (F.size("_s") == len(wanted)).alias("complete"))


def require_complete(pixels: DataFrame, keys: Sequence[str], wanted: Sequence[str] = ("i", "q", "u")) -> DataFrame:
    """The cubes themselves, or an error naming how many lack a Stokes plane."""
    missing = stokes_complete(pixels, keys, wanted).where(~F.col("complete")).count()
    if missing:
        raise ValueError(f"{missing} cubes lack a Stokes plane")
    return pixels


AXES = ("chan", "stokes", "y", "x")


def swap_cube_axes(pixels: DataFrame) -> DataFrame:
    """Frequency before Stokes: in a long table only the column order changes."""
    rest = [c for c in pixels.columns if c not in (*AXES, "value")]
    return pixels.select(*rest, *[a for a in AXES if a in pixels.columns], "value")


def build_cube(images: DataFrame, channels: DataFrame, keys: Sequence[str], chan: str = "chan") -> DataFrame:
    """Stack channel images into a cube; channels without an image are blank.

    ``channels`` lists the wanted channels.  Blank planes get one row per pixel
    position of the key (positions are taken from the images present).
    """
    keys = list(keys)
    grid = images.select(*keys, "y", "x").distinct()
    have = images.select(*keys, chan).distinct()
    listed = channels.select(chan).distinct().agg(F.sort_array(F.collect_list(chan)).alias("_all"))
    planes = have.groupBy(*keys).agg(F.collect_set(chan).alias("_have"))
    blank = (
        with_scalars(planes, listed)
        .select(*keys, F.explode(F.array_except("_all", "_have")).alias(chan))
        .join(grid, keys)
    )
    value = images.schema["value"].dataType
    return images.select(*keys, chan, "y", "x", "value").unionByName(
        blank.withColumn("value", F.lit(None).cast(value)).select(*keys, chan, "y", "x", "value")
    )


def merge_image_lists(images: DataFrame, keys: Sequence[str] = ("pol",), path: str = "path") -> DataFrame:
    """Concatenated image list per polarisation (and auxiliary kind)."""
    return images.groupBy(*keys).agg(F.sort_array(F.collect_list(path)).alias("images"))


def require_one_set(images: DataFrame, columns: Sequence[str] = ("ms", "prefix")) -> DataFrame:
    """The images themselves, or an error when they stem from different sets."""
    row = images.agg(*[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]).first()
    for c in columns:
        if row[f"lo_{c}"] != row[f"hi_{c}"]:
            raise ValueError(f"images differ in {c}")
    return images


def pair_weights(images: DataFrame, weights: DataFrame, on: Sequence[str] = ("source_id", "beam", "stokes")) -> DataFrame:
    """Image and weight path per beam; a missing partner shows as NULL."""
    return images.join(weights, list(on), "full_outer")


def require_paired(pairs: DataFrame, image: str = "image", weight: str = "weight_image") -> DataFrame:
    unpaired = pairs.where(F.col(image).isNull() | F.col(weight).isNull()).limit(1).count()
    if unpaired:
        raise ValueError("images and weights do not match one to one")
    return pairs


def extract_spectrum(
    pixels: DataFrame,
    coords: DataFrame,
    noise: DataFrame,
    on: Sequence[str] = ("source_id",),
    ident: str = "cat_id",
) -> DataFrame:
    """Spectrum of every component from its source's cubelet: long (ident, stokes, chan)."""
    return finish_spectrum(pixel_lookup(pixels, coords, on), noise, on, ident)


def finish_spectrum(at: DataFrame, noise: DataFrame, on: Sequence[str] = ("source_id",), ident: str = "cat_id") -> DataFrame:
    """Looked-up pixels as background-free spectra with noise.

    Zeros become missing, noise missing in a channel takes the median of the
    cube's channels, and noise and background are blanked with the data.
    """
    keys = [*on, "stokes"]
    mid = grouped_median(noise, keys, "noise", "_mid", bounded=True).drop("n")
    filled = noise.join(mid, keys, "left").withColumn(
        "noise", F.when(finite("noise"), F.col("noise")).otherwise(F.col("_mid"))
    )
    joined = at.join(filled.select(*keys, "chan", "noise", "background"), [*keys, "chan"], "left")
    nan = F.lit(float("nan"))
    good = finite("value") & (F.col("value") != 0)
    return joined.select(
        *on,
        ident,
        "stokes",
        "chan",
        F.when(good, F.col("value") - F.col("background")).otherwise(nan).alias("value"),
        F.when(good, F.col("noise")).otherwise(nan).alias("rms"),
        F.when(good, F.col("background")).otherwise(nan).alias("bkg"),
    )


def shared_noise(noise: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Noise for pixel synthesis: the larger of Q and U noise per channel."""
    return noise.where(F.col("stokes").isin("q", "u")).groupBy(*keys, "chan").agg(F.max("noise").alias("dqu"))


def nearest_pixel(value) -> Column:
    return F.rint(as_col(value)).cast("int")
