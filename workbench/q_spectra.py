"""Spectra, Faraday and pixel queries."""

from pyspark.sql import functions as F

from stokesweave.operators import faraday, pixels, powerlaw, spectra
from stokesweave.plans import spectra as spectra_plan
from workbench.q_statistics import s_clipped
from workbench.registry import check, r6, s6, s_pa, s_sep
from workbench.views import table, view

PHI = [float(i) for i in range(-100, 101, 5)]
FREQS = [800e6 + 9e6 * i for i in range(32)]


def _holes(spark, d):
    """Spectra with blanked channels: exact zeros and missing noise."""
    s = view(spark, d, "fx_spectra")
    k = F.col("cat_id") + F.col("chan")
    return s.withColumns(
        {
            "q": F.when(k % 7 == 0, F.lit(0.0)).otherwise(F.col("q")),
            "u": F.when(k % 11 == 0, F.lit(0.0)).otherwise(F.col("u")),
            "dq": F.when(k % 5 == 0, F.lit(float("nan"))).otherwise(F.col("dq")),
        }
    )


HOLES = """h AS (SELECT cat_id, chan, freq, i, di, du, bi, bq, bu, CASE WHEN (cat_id+chan)%7=0 THEN NULL ELSE q END AS q,
    CASE WHEN (cat_id+chan)%11=0 THEN NULL ELSE u END AS u, CASE WHEN (cat_id+chan)%5=0 THEN NULL ELSE dq END AS dq FROM fx_spectra)"""


def _null(c):
    return F.nanvl(F.col(c), F.lit(None)).alias(c)


@check(
    "zero_to_nan",
    f"""WITH {HOLES} SELECT cat_id, chan, q, u, CASE WHEN q IS NULL THEN NULL ELSE dq END AS dq,
    CASE WHEN u IS NULL THEN NULL ELSE bu END AS bu FROM h""",
)
def _(spark, d):
    return spectra.blank_zeros(_holes(spark, d)).select("cat_id", "chan", *[_null(c) for c in ("q", "u", "dq", "bu")])


@check(
    "spectrum_status",
    f"""WITH {HOLES} SELECT cat_id, COUNT(i) AS n_i, COUNT(q) AS n_q, COUNT(u) AS n_u, COUNT(i)>=1 AND COUNT(q)>=2 AND COUNT(u)>=2 AS ok
    FROM h GROUP BY cat_id""",
)
def _(spark, d):
    return spectra.spectrum_status(spectra.blank_zeros(_holes(spark, d)), ["cat_id"])


@check(
    "fill_rms_median",
    f"""WITH {HOLES}, m AS (SELECT cat_id, MEDIAN(dq) AS md FROM h GROUP BY cat_id)
    SELECT h.cat_id, chan, {s6('COALESCE(dq, md)')} AS dq FROM h JOIN m ON h.cat_id=m.cat_id""",
)
def _(spark, d):
    return spectra.fill_rms_median(_holes(spark, d), ["cat_id"], "dq").select("cat_id", "chan", r6("dq"))


def _clip_sql():
    parts, prev = ["t0 AS (SELECT cat_id, chan, s, v FROM (SELECT cat_id, chan, 'i' AS s, di AS v FROM fx_spectra "
                   "UNION ALL SELECT cat_id, chan, 'q', dq FROM fx_spectra UNION ALL SELECT cat_id, chan, 'u', du FROM fx_spectra))"], "t0"
    for i in (1, 2):
        parts.append(
            f"m{i} AS (SELECT cat_id, s, MEDIAN(v) AS md FROM {prev} GROUP BY cat_id, s),"
            f"d{i} AS (SELECT t.cat_id, t.s, MIN(m.md) AS md, 1.482602218505602*MEDIAN(ABS(t.v-m.md)) AS sd FROM {prev} t "
            f"JOIN m{i} m ON t.cat_id=m.cat_id AND t.s=m.s GROUP BY t.cat_id, t.s),"
            f"t{i} AS (SELECT t.* FROM {prev} t JOIN d{i} d ON t.cat_id=d.cat_id AND t.s=d.s "
            f"WHERE t.v BETWEEN d.md-1.2*d.sd AND d.md+1.2*d.sd)"
        )
        prev = f"t{i}"
    return (
        f"WITH {', '.join(parts)}, bad AS (SELECT DISTINCT t0.cat_id, t0.chan FROM t0 JOIN d2 d ON t0.cat_id=d.cat_id AND t0.s=d.s "
        "WHERE NOT (t0.v BETWEEN d.md-1.2*d.sd AND d.md+1.2*d.sd)) "
        "SELECT f.cat_id, f.chan, CASE WHEN bad.cat_id IS NULL THEN f.q END AS q, bad.cat_id IS NOT NULL AS clipped "
        "FROM fx_spectra f LEFT JOIN bad ON f.cat_id=bad.cat_id AND f.chan=bad.chan"
    )


@check("clip_channels", _clip_sql())
def _(spark, d):
    out = spectra.clip_channels(view(spark, d, "fx_spectra"), ["cat_id"], sigma=1.2, maxiters=2)
    return out.select("cat_id", "chan", _null("q"), "clipped")


@check(
    "band_noise",
    f"""WITH {HOLES} SELECT cat_id, {s6('AVG(dq)')} AS dq, {s6('AVG(dq)/SQRT(COUNT(dq))')} AS dq_full_band, {s6('AVG(bq)')} AS bq_full_band,
    {s6('AVG(du)/SQRT(COUNT(du))')} AS du_full_band FROM h GROUP BY cat_id""",
)
def _(spark, d):
    out = spectra.band_noise(_holes(spark, d), ["cat_id"])
    return out.select("cat_id", *[r6(c) for c in ("dq", "dq_full_band", "bq_full_band", "du_full_band")])


@check(
    "band_average",
    f"""SELECT cat_id, {s6('AVG(freq)')} AS freq, {s6('SUM(i)')} AS i, {s6('SUM(q)/SUM(i)')} AS q_frac, {s6('SUM(u)/SUM(i)')} AS u_frac,
    {s6('SQRT(POWER(SUM(q)/SUM(i),2)+POWER(SUM(u)/SUM(i),2))')} AS p_frac FROM fx_spectra WHERE chan>=4 AND chan<20 GROUP BY cat_id""",
)
def _(spark, d):
    out = spectra.band_average(view(spark, d, "fx_spectra"), ["cat_id"], 4, 20)
    return out.select("cat_id", *[r6(c) for c in ("freq", "i", "q_frac", "u_frac", "p_frac")])


@check(
    "band_chunks",
    f"""SELECT cat_id, CAST(FLOOR(chan/8) AS INT) AS chunk, {s6('AVG(freq)')} AS freq, {s6('SUM(q)/SUM(i)')} AS q_frac
    FROM fx_spectra GROUP BY cat_id, FLOOR(chan/8)""",
)
def _(spark, d):
    out = spectra.band_chunks(view(spark, d, "fx_spectra"), ["cat_id"], [(0, 8), (8, 16), (16, 24), (24, 32)])
    return out.select("cat_id", "chunk", r6("freq"), r6("q_frac"))


@check("channel_width", "SELECT cat_id, MAX(CASE WHEN chan=1 THEN freq END)-MAX(CASE WHEN chan=0 THEN freq END) AS channel_width FROM fx_spectra GROUP BY cat_id")
def _(spark, d):
    return spectra.channel_width(view(spark, d, "fx_spectra"), ["cat_id"])


@check("linear_axis", "SELECT DISTINCT chan, freq FROM fx_spectra")
def _(spark, d):
    from stokesweave.functions.spectral import linear_axis

    bands = view(spark, d, "fx_spectra").select("cat_id").distinct()
    axis = bands.select(F.posexplode(linear_axis(800e6, 1.0, 9e6, 32)).alias("chan", "freq"))
    return axis.distinct()


@check("align_stokes", "SELECT cat_id, chan, i, q, u FROM fx_spectra")
def _(spark, d):
    s = view(spark, d, "fx_spectra")
    long_form = s.unpivot(["cat_id", "chan"], ["i", "q", "u"], "stokes", "value")
    return spectra.align_stokes(long_form, ["cat_id"])


AIC = "n*LN(ssr/n)+CASE WHEN n/2.0>=40 THEN 4.0 ELSE 4.0*n/(n-3.0) END"


@check(
    "chi_squared",
    f"""WITH s AS (SELECT cat_id, CAST(COUNT(*) AS BIGINT) AS n, SUM(POWER((i-q)/di,2)) AS chi, SUM(POWER(i-q,2)) AS ssr FROM fx_spectra GROUP BY cat_id)
    SELECT cat_id, n, {s6('chi', 3)} AS chi_sq, {s6('chi/(n-2)', 4)} AS chi_sq_red, {s6(AIC)} AS aic FROM s""",
)
def _(spark, d):
    out = spectra.chi_squared(view(spark, d, "fx_spectra"), ["cat_id"], "i", "q", "di", 2)
    return out.select("cat_id", "n", r6("chi_sq", digits=3), r6("chi_sq_red", digits=4), r6("aic"))


@check(
    "occam_aic",
    """WITH m AS (SELECT vec_id AS cat_id, i AS n_terms, v*10 AS aic FROM fx_exploded WHERE i<3),
    b AS (SELECT cat_id, MIN(aic) AS best FROM m GROUP BY cat_id),
    w AS (SELECT m.cat_id, m.n_terms AS bn, m.aic FROM m JOIN b ON m.cat_id=b.cat_id AND m.aic=b.best),
    k AS (SELECT m.cat_id, MIN(m.n_terms) AS n FROM m JOIN w ON m.cat_id=w.cat_id WHERE m.n_terms=w.bn OR (m.n_terms<w.bn AND m.aic-w.aic<2) GROUP BY m.cat_id)
    SELECT m.cat_id, m.n_terms, m.aic FROM m JOIN k ON m.cat_id=k.cat_id AND m.n_terms=k.n""",
)
def _(spark, d):
    m = view(spark, d, "fx_exploded").where("i < 3").select(F.col("vec_id").alias("cat_id"), F.col("i").alias("n_terms"), (F.col("v") * 10).alias("aic"))
    return spectra.occam_aic(m, ["cat_id"])


@check("normality")
def _(spark, d):
    return spectra.normality(view(spark, d, "fx_exploded"), ["vec_id"], "v")


# --- Faraday -----------------------------------------------------------------------


def _rm_sql(weight, re, im, phis, extra=""):
    vals = ",".join(f"({p!r})" for p in phis)
    return f"""WITH phi AS (SELECT CAST(c AS DOUBLE) AS phi FROM (VALUES {vals}) t(c)),
    s AS (SELECT cat_id, lambda_sq AS l2, {weight} AS w, {re} AS qq, {im} AS uu FROM fx_spectra),
    l AS (SELECT cat_id, SUM(w*l2)/SUM(w) AS l0 FROM s GROUP BY cat_id),
    f AS (SELECT s.cat_id, phi, MIN(l0) AS l0,
      SUM(w*(qq*COS(2*phi*(l2-l0))+uu*SIN(2*phi*(l2-l0))))/SUM(w) AS re, SUM(w*(uu*COS(2*phi*(l2-l0))-qq*SIN(2*phi*(l2-l0))))/SUM(w) AS im
      FROM s JOIN l ON s.cat_id=l.cat_id, phi GROUP BY s.cat_id, phi)
    {extra or f"SELECT cat_id, phi, {s6('re')} AS re, {s6('im')} AS im FROM f"}"""


VARIANCE = "1.0/(dqu*dqu)"


@check("rm_synthesis", _rm_sql(VARIANCE, "q", "u", PHI))
def rm_synthesis(spark, d):
    out = faraday.rm_synthesis(view(spark, d, "fx_spectra"), PHI)
    return out.select("cat_id", "phi", r6("re"), r6("im"))


@check("rm_synthesis_uniform", _rm_sql("1.0", "q/i", "u/i", PHI))
def _(spark, d):
    out = faraday.rm_synthesis(view(spark, d, "fx_spectra"), PHI, weight="uniform", model="i")
    return out.select("cat_id", "phi", r6("re"), r6("im"))


@check("rmsf", _rm_sql(VARIANCE, "1.0", "0.0", faraday.double_grid(PHI)))
def _(spark, d):
    return faraday.rmsf(view(spark, d, "fx_spectra"), PHI).select("cat_id", "phi", r6("re"), r6("im"))


@check(
    "synthesis_scalars",
    f"""WITH s AS (SELECT cat_id, lambda_sq AS l2, dqu, {VARIANCE} AS w FROM fx_spectra)
    SELECT cat_id, COUNT(*) AS n_chan, {s6('SUM(w*l2)/SUM(w)')} AS lambda0_sq, {s6('SQRT(SUM(w*w*dqu*dqu))/SUM(w)')} AS fdf_noise,
      {s6('3.8/(MAX(l2)-MIN(l2))')} AS rmsf_fwhm, {s6('299792458.0/SQRT(SUM(w*l2)/SUM(w))', 2)} AS freq0 FROM s GROUP BY cat_id""",
)
def _(spark, d):
    out = faraday.synthesis_scalars(view(spark, d, "fx_spectra"))
    return out.select("cat_id", "n_chan", r6("lambda0_sq"), r6("fdf_noise"), r6("rmsf_fwhm"), r6("freq0", digits=2))


@check(
    "peak3",
    _rm_sql(
        VARIANCE,
        "q",
        "u",
        PHI,
        f""", a AS (SELECT *, SQRT(re*re+im*im) AS amp FROM f),
    n AS (SELECT *, LAG(amp) OVER w AS lo, LEAD(amp) OVER w AS up FROM a WINDOW w AS (PARTITION BY cat_id ORDER BY phi)),
    k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cat_id ORDER BY amp DESC, phi) AS rn FROM n)
    SELECT cat_id, phi, {s6('amp')} AS amp, {s6('phi+COALESCE(5.0*0.5*(lo-up)/(lo-2*amp+up),0)')} AS phi_fit FROM k WHERE rn=1""",
    ),
)
def _(spark, d):
    out = faraday.peak3(faraday.rm_synthesis(view(spark, d, "fx_spectra"), PHI).drop("lambda0_sq"))
    return out.select("cat_id", "phi", r6("amp"), r6("phi_fit"))


@check(
    "fdf_peak",
    _rm_sql(
        VARIANCE,
        "q",
        "u",
        PHI,
        f""", a AS (SELECT *, SQRT(re*re+im*im) AS amp FROM f),
    n AS (SELECT *, LAG(amp) OVER w AS lo, LEAD(amp) OVER w AS up, LAG(re) OVER w AS rlo, LEAD(re) OVER w AS rup,
      LAG(im) OVER w AS ilo, LEAD(im) OVER w AS iup FROM a WINDOW w AS (PARTITION BY cat_id ORDER BY phi)),
    k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cat_id ORDER BY amp DESC, phi) AS rn FROM n),
    t AS (SELECT *, COALESCE(0.5*(lo-up)/(lo-2*amp+up),0) AS s FROM k WHERE rn=1),
    z AS (SELECT cat_id, SQRT(SUM(w*w*dqu*dqu))/SUM(w) AS nz, 3.8/(MAX(lambda_sq)-MIN(lambda_sq)) AS fw FROM
      (SELECT *, 1.0/(dqu*dqu) AS w FROM fx_spectra) GROUP BY cat_id),
    y AS (SELECT t.cat_id, l0, nz, fw, phi+5.0*s AS rm, COALESCE(amp+0.5*(up-lo)*s+0.5*(lo-2*amp+up)*s*s, amp) AS a,
      COALESCE(re+0.5*(rup-rlo)*s+0.5*(rlo-2*re+rup)*s*s, re) AS r, COALESCE(im+0.5*(iup-ilo)*s+0.5*(ilo-2*im+iup)*s*s, im) AS i
      FROM t JOIN z ON t.cat_id=z.cat_id)
    SELECT cat_id, {s6('rm')} AS rm, {s6('fw*0.5*nz/a')} AS rm_err,
      {s6('CASE WHEN a/nz > 5 THEN SQRT(a*a-2.3*nz*nz) ELSE a END')} AS polint, {s6('a/nz', 4)} AS snr_polint, {s6('r')} AS stokes_q,
      {s6('i')} AS stokes_u FROM y""",
    ),
)
def _(spark, d):
    out = faraday.spectrum_peaks(view(spark, d, "fx_spectra"), PHI)
    return out.select("cat_id", r6("rm"), r6("rm_err"), r6("polint"), r6("snr_polint", digits=4), r6("stokes_q"), r6("stokes_u"))


def _half_turn(expr: str) -> str:
    return f"(({expr})-180.0*FLOOR(({expr})/180.0))"


def _measurements_sql(phi: list[float], step: float) -> str:
    """All columns of the peak measurements, from the synthesis up."""
    chi, var0 = "DEGREES(0.5*ATAN2(i,r))", "n*nz*nz/(4.0*(n-2)*a*a)*((n-1.0)/n+l0*l0/vl)"
    return _rm_sql(
        VARIANCE,
        "q",
        "u",
        phi,
        f""", a AS (SELECT *, SQRT(re*re+im*im) AS amp FROM f),
    n AS (SELECT *, LAG(amp) OVER w AS lo, LEAD(amp) OVER w AS up, LAG(re) OVER w AS rlo, LEAD(re) OVER w AS rup,
      LAG(im) OVER w AS ilo, LEAD(im) OVER w AS iup FROM a WINDOW w AS (PARTITION BY cat_id ORDER BY phi)),
    k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cat_id ORDER BY amp DESC, phi) AS rn FROM n),
    t AS (SELECT *, COALESCE(0.5*(lo-up)/(lo-2*amp+up),0) AS s FROM k WHERE rn=1),
    z AS (SELECT cat_id, SUM(w*lambda_sq)/SUM(w) AS l0, SQRT(SUM(w*w*dqu*dqu))/SUM(w) AS nz, 3.8/(MAX(lambda_sq)-MIN(lambda_sq)) AS fw,
      VAR_POP(lambda_sq) AS vl, COUNT(*) AS n, MIN(lambda_sq) AS l1, MAX(lambda_sq) AS l2 FROM (SELECT *, {VARIANCE} AS w FROM fx_spectra) GROUP BY cat_id),
    y AS (SELECT t.cat_id, z.l0, nz, fw, vl, z.n, l1, l2, phi+{step!r}*s AS rm, COALESCE(amp+0.5*(up-lo)*s+0.5*(lo-2*amp+up)*s*s, amp) AS a,
      COALESCE(re+0.5*(rup-rlo)*s+0.5*(rlo-2*re+rup)*s*s, re) AS r, COALESCE(im+0.5*(iup-ilo)*s+0.5*(ilo-2*im+iup)*s*s, im) AS i
      FROM t JOIN z ON t.cat_id=z.cat_id)
    SELECT cat_id, {s6('rm', 5)} AS rm, {s6('fw*0.5*nz/a')} AS rm_err, {s6('CASE WHEN a/nz > 5 THEN SQRT(a*a-2.3*nz*nz) ELSE a END')} AS polint,
      {s6('nz')} AS polint_err, {s6('r')} AS stokes_q, {s6('i')} AS stokes_u, {s6(_half_turn(chi), 4)} AS polangle, {s6('DEGREES(0.5*nz/a)')} AS polangle_err,
      {s6(_half_turn(f'{_half_turn(chi)}-DEGREES(rm*l0)'), 3)} AS derot_polangle, {s6(f'DEGREES(SQRT({var0}))')} AS derot_polangle_err, {s6('a/nz', 4)} AS snr_polint,
      {s6('nz')} AS fdf_noise_th, {s6('fw')} AS rmsf_fwhm, {s6('l0')} AS refwave_sq_pol, {s6('299792458.0/SQRT(l0)', 2)} AS reffreq_pol,
      {s6('299792458.0/SQRT(l2)', 2)} AS minfreq, {s6('299792458.0/SQRT(l1)', 2)} AS maxfreq, n AS nchan FROM y""",
    )


def _measured(spark, d, phi):
    out = faraday.spectrum_peaks(view(spark, d, "fx_spectra"), phi)
    digits = {"rm": 5, "polangle": 4, "derot_polangle": 3, "snr_polint": 4, "reffreq_pol": 2, "minfreq": 2, "maxfreq": 2}
    return out.select(*[F.col(c) if c in ("cat_id", "nchan") else r6(c, digits=digits.get(c, 6)) for c in out.columns])


@check("peak_measurements", _measurements_sql(PHI, 5.0))
def _(spark, d):
    return _measured(spark, d, PHI)


FINE_PHI = faraday.regular_grid(500.0, 0.5)  # 2001 depths


@check("peak_measurements_fine", _measurements_sql(FINE_PHI, 0.5))
def _(spark, d):
    return _measured(spark, d, FINE_PHI)


@check(
    "phi_grid",
    f"""WITH g AS (SELECT 3.8/(MAX(lambda_sq)-MIN(lambda_sq))/5 AS step FROM fx_spectra),
    phi AS (SELECT (range-ROUND(400.0/step))*step AS phi FROM RANGE(1000), g WHERE range <= 2*ROUND(400.0/step)),
    s AS (SELECT cat_id, lambda_sq AS l2, 1.0/(dqu*dqu) AS w, q, u FROM fx_spectra),
    l AS (SELECT cat_id, SUM(w*l2)/SUM(w) AS l0 FROM s GROUP BY cat_id)
    SELECT s.cat_id, {s6('phi')} AS phi, {s6('SUM(w*(q*COS(2*phi*(l2-l0))+u*SIN(2*phi*(l2-l0))))/SUM(w)')} AS re
    FROM s JOIN l ON s.cat_id=l.cat_id, phi GROUP BY s.cat_id, phi""",
)
def _(spark, d):
    s = view(spark, d, "fx_spectra")
    out = faraday.rm_synthesis(s, faraday.phi_grid(s, phi_max=400.0))
    return out.select("cat_id", r6("phi"), r6("re"))


def _cleaned(spark, d):
    return faraday.clean_spectra(view(spark, d, "fx_spectra"), PHI, cutoff=-3.0, max_iter=10_000)


@check("rm_clean")
def _(spark, d):
    return _cleaned(spark, d).select("cat_id", "n_iter", "cutoff_used", "ok", F.size("phi").alias("n_phi"))


@check("clean_component_width")
def _(spark, d):
    return faraday.cc_moment2(faraday.clean_components(_cleaned(spark, d)))


@check(
    "cc_moment2",
    f"""WITH c AS (SELECT vec_id, CAST(i AS DOUBLE) AS phi, ABS(v) AS a FROM fx_exploded),
    s AS (SELECT vec_id, SUM(a*phi)/SUM(a) AS m1, SUM(a*phi*phi)/SUM(a) AS m2 FROM c GROUP BY vec_id)
    SELECT vec_id, {s6('m1')} AS mom1, {s6('SQRT(m2-m1*m1)')} AS mom2 FROM s""",
)
def _(spark, d):
    c = view(spark, d, "fx_exploded").select("vec_id", F.col("i").cast("double").alias("phi"), F.col("v").alias("re"), F.lit(0.0).alias("im"))
    return faraday.cc_moment2(c, ["vec_id"]).select("vec_id", r6("mom1"), r6("mom2"))


_PIX_PHI = [float(p) for p in range(-60, 61, 20)]
_VALS = ",".join(f"({p!r})" for p in _PIX_PHI)


def _pixel_spectra(spark, d):
    """Each image is a source: pixel spectra over its labels' channels."""
    p = view(spark, d, "fx_pixels")
    plane = p.groupBy("source_id", "stokes", "chan", "y", "x").agg(F.avg("value").alias("value"))
    noise = plane.groupBy("source_id", "stokes", "chan").agg(F.stddev_pop("value").alias("noise"))
    freqs = plane.select("chan").distinct().select("chan", (F.lit(8e8) + F.col("chan") * 36e6).alias("freq"))
    return spectra_plan.pixel_spectra(plane, noise, freqs)


PIXEL_CTE = """pl AS (SELECT source_id, stokes, chan, y, x, AVG(value) AS v FROM fx_pixels WHERE stokes<>'i' GROUP BY source_id, stokes, chan, y, x),
    nz AS (SELECT source_id, chan, MAX(sd) AS dqu FROM (SELECT source_id, stokes, chan, STDDEV_POP(v) AS sd FROM pl GROUP BY source_id, stokes, chan)
      GROUP BY source_id, chan),
    px AS (SELECT q.source_id, q.y, q.x, q.chan, q.v AS q, u.v AS u, n.dqu, POWER(299792458.0/(8e8+q.chan*36e6),2) AS l2
      FROM pl q JOIN pl u ON q.source_id=u.source_id AND q.chan=u.chan AND q.y=u.y AND q.x=u.x AND q.stokes='q' AND u.stokes='u'
      JOIN nz n ON q.source_id=n.source_id AND q.chan=n.chan)"""


@check(
    "rm_synthesis_pixels",
    f"""WITH {PIXEL_CTE}, phi AS (SELECT CAST(c AS DOUBLE) AS phi FROM (VALUES {_VALS}) t(c)),
    l AS (SELECT source_id, y, x, SUM(l2/(dqu*dqu))/SUM(1/(dqu*dqu)) AS l0 FROM px GROUP BY source_id, y, x)
    SELECT px.source_id, px.y, px.x, phi,
      {s6('SUM((q*COS(2*phi*(l2-l0))+u*SIN(2*phi*(l2-l0)))/(dqu*dqu))/SUM(1/(dqu*dqu))')} AS re,
      {s6('SUM((u*COS(2*phi*(l2-l0))-q*SIN(2*phi*(l2-l0)))/(dqu*dqu))/SUM(1/(dqu*dqu))')} AS im
    FROM px JOIN l ON px.source_id=l.source_id AND px.y=l.y AND px.x=l.x, phi GROUP BY px.source_id, px.y, px.x, phi""",
)
def _(spark, d):
    out = spectra_plan.pixel_synthesis(_pixel_spectra(spark, d), _PIX_PHI)
    return out.select("source_id", "y", "x", "phi", r6("re"), r6("im"))


@check("rm_clean_pixels")
def _(spark, d):
    out = spectra_plan.pixel_clean(_pixel_spectra(spark, d), _PIX_PHI, cutoff=-3.0, max_iter=10_000)
    return out.select("source_id", "y", "x", "n_iter", "ok")


@check(
    "faraday_modulation",
    f"""WITH c AS (SELECT CAST(range AS INT) AS chan, POWER(299792458.0/(8e8+9e6*range),2) AS l2 FROM RANGE(32))
    SELECT i.source_id, c.chan, {s6('AVG(COS(2*rm*l2))')} AS re, {s6('AVG(SIN(2*rm*l2))')} AS im FROM fx_iono i, c GROUP BY i.source_id, c.chan""",
)
def _(spark, d):
    out = faraday.faraday_modulation(view(spark, d, "fx_iono"), FREQS)
    return out.select("source_id", "chan", r6("re"), r6("im"))


# every observation has its own start, length and one of two bands; readings are the events' values over the observations' days
_WINDOWS = """SELECT CAST(o.sbid AS BIGINT) AS sbid, o.sbid%10 AS source_id, 58600.0+CAST(o.sbid%100 AS DOUBLE)/10.0 AS start, o.scan_tint/600.0 AS length, CAST(o.sbid%2 AS INT) AS band
    FROM fx_obs o"""
_READINGS = "SELECT source_id, 58600.0+CAST(event_id%1200 AS DOUBLE)/100.0 AS t, rm FROM fx_iono"
_BANDS = "SELECT CAST(b.range AS INT) AS band, CAST(c.range AS INT) AS chan, 8e8+1e8*b.range+9e6*c.range AS freq FROM RANGE(2) b, RANGE(32) c"


@check(
    "window_modulation",
    f"""WITH w AS (SELECT DISTINCT * FROM ({_WINDOWS})), r AS ({_READINGS}), b AS ({_BANDS})
    SELECT w.sbid, w.source_id, b.chan, {s6('AVG(COS(2*r.rm*POWER(299792458.0/b.freq,2)))')} AS re, {s6('AVG(SIN(2*r.rm*POWER(299792458.0/b.freq,2)))')} AS im, COUNT(*) AS n
    FROM w JOIN r ON w.source_id=r.source_id AND r.t BETWEEN w.start AND w.start+w.length JOIN b ON w.band=b.band GROUP BY w.sbid, w.source_id, b.chan""",
)
def _(spark, d):
    windows = spark.sql(_WINDOWS.replace("fx_obs", "{o}"), o=view(spark, d, "fx_obs"))
    readings = spark.sql(_READINGS.replace("fx_iono", "{i}"), i=view(spark, d, "fx_iono"))
    bands = spark.sql(_BANDS.replace(".range", ".id"))
    out = faraday.window_modulation(readings, windows, bands)
    return out.select("sbid", "source_id", "chan", r6("re"), r6("im"), "n")


@check(
    "derotate",
    f"""WITH c AS (SELECT CAST(range AS INT) AS chan, POWER(299792458.0/(8e8+9e6*range),2) AS l2 FROM RANGE(32)),
    t AS (SELECT i.source_id, c.chan, AVG(COS(2*rm*l2)) AS re, AVG(SIN(2*rm*l2)) AS im FROM fx_iono i, c GROUP BY i.source_id, c.chan)
    SELECT s.cat_id, s.chan, {s6('(q*re+u*im)/(re*re+im*im)')} AS q, {s6('(u*re-q*im)/(re*re+im*im)')} AS u
    FROM fx_spectra s JOIN t ON CAST(s.source_id AS BIGINT)=t.source_id AND s.chan=t.chan""",
)
def _(spark, d):
    theta = faraday.faraday_modulation(view(spark, d, "fx_iono"), FREQS).withColumn("source_id", F.col("source_id").cast("int"))
    out = spectra.derotate(view(spark, d, "fx_spectra"), theta, ["source_id", "chan"])
    return out.select("cat_id", "chan", r6("q"), r6("u"))


@check("fit_power_law")
def _(spark, d):
    fit = powerlaw.fit_power_law(view(spark, d, "fx_spectra"))
    return fit.select("cat_id", "best_n", "chi_sq_red", "is_negative", "is_not_normal", "is_close_to_zero", "ok")


@check("spectral_measurements")
def _(spark, d):
    s = view(spark, d, "fx_spectra").drop("source_id", "lambda_sq", "dqu")
    out = spectra_plan.spectral_measurements(s, PHI, cutoff=-3.0, max_iter=10_000)
    return out.select("cat_id", "rmsynth1d", "rmclean1d", "rm", "polint", "rm_width", "best_n")


# --- pixels ----------------------------------------------------------------------------


@check(
    "coadd",
    f"""SELECT source_id, y, x, {s6('SUM(weight*value)/SUM(weight)')} AS value, SUM(weight) AS weight FROM fx_pixels GROUP BY source_id, y, x""",
)
def _(spark, d):
    out = pixels.coadd(view(spark, d, "fx_pixels"), ["source_id", "y", "x"])
    return out.select("source_id", "y", "x", r6("value"), "weight")


@check(
    "channel_weights",
    f"""WITH m AS (SELECT stokes, chan, MEDIAN(value) AS md FROM fx_pixels GROUP BY stokes, chan),
    r AS (SELECT p.stokes, p.chan, MEDIAN(ABS(p.value-m.md))*1.482602218505602 AS rms FROM fx_pixels p JOIN m ON p.stokes=m.stokes AND p.chan=m.chan
      GROUP BY p.stokes, p.chan)
    SELECT stokes, chan, {s6('rms')} AS rms, {s6('1/(rms*rms)', 4)} AS weight FROM r""",
)
def _(spark, d):
    out = pixels.channel_weights(pixels.channel_rms(view(spark, d, "fx_pixels")))
    return out.select("stokes", "chan", r6("rms"), r6("weight", digits=4))


@check(
    "annulus_noise",
    f"""SELECT source_id, stokes, chan, {s6('AVG(value)')} AS background, {s6('STDDEV_POP(value)')} AS noise, COUNT(*) AS n FROM fx_pixels
    WHERE SQRT(POWER(x-4,2)+POWER(y-4,2)) > 1.5*0.8 AND SQRT(POWER(x-4,2)+POWER(y-4,2)) < 4.0 GROUP BY source_id, stokes, chan""",
)
def _(spark, d):
    out = pixels.annulus_noise(view(spark, d, "fx_pixels"), ["source_id", "stokes", "chan"], 0.8, 8, 8, clip=False)
    return out.select("source_id", "stokes", "chan", r6("background"), r6("noise"), "n")


_RING = "(SELECT * FROM fx_pixels WHERE SQRT(POWER(x-4,2)+POWER(y-4,2)) > 1.5*0.8 AND SQRT(POWER(x-4,2)+POWER(y-4,2)) < 4.0)"


@check(
    "annulus_noise_clipped",
    f"""WITH RECURSIVE {s_clipped(_RING, 'source_id stokes chan', 'value', 2.0, 'mean', 'std', 25)}
    SELECT p.source_id, p.stokes, p.chan, {s6('AVG(value)')} AS background, {s6('STDDEV_POP(value)')} AS noise, COUNT(*) AS n
    FROM {_RING} p JOIN l ON p.source_id=l.source_id AND p.stokes=l.stokes AND p.chan=l.chan WHERE value BETWEEN lo AND hi GROUP BY ALL""",
)
def _(spark, d):
    out = pixels.annulus_noise(view(spark, d, "fx_pixels"), ["source_id", "stokes", "chan"], 0.8, 8, 8, sigma=2.0)
    return out.select("source_id", "stokes", "chan", r6("background"), r6("noise"), "n")


def _boxes(spark, d):
    f = view(spark, d, "fx_fields")
    k = F.col("sbid") - 8000
    return f.select(
        "field_name",
        (k % 5).cast("int").alias("x_lo"),
        (k % 5 + 3).cast("int").alias("x_hi"),
        (k % 4).cast("int").alias("y_lo"),
        (k % 4 + 2).cast("int").alias("y_hi"),
    )


@check(
    "cutout",
    """SELECT f.field_name, p.beam, p.y, p.x, p.value FROM fx_fields f, fx_pixels p
    WHERE p.x >= (f.sbid-8000)%5 AND p.x < (f.sbid-8000)%5+3 AND p.y >= (f.sbid-8000)%4 AND p.y < (f.sbid-8000)%4+2""",
)
def _(spark, d):
    out = pixels.cutout(view(spark, d, "fx_pixels"), _boxes(spark, d), tile=4)
    return out.select("field_name", "beam", "y", "x", "value")


@check(
    "pixel_lookup",
    """WITH c AS (SELECT label AS source_id, vec_id AS cat_id, (vec_id%70)/10.0+0.05 AS px, (vec_id%60)/10.0+0.05 AS py FROM embeddings)
    SELECT c.cat_id, p.beam, p.stokes, p.chan, p.value FROM c JOIN fx_pixels p ON c.source_id=p.source_id AND p.x=ROUND(px) AND p.y=ROUND(py)""",
)
def _(spark, d):
    v = F.col("vec_id")
    coords = table(spark, d, "embeddings").select(
        F.col("label").alias("source_id"), v.alias("cat_id"), ((v % 70) / 10.0 + 0.05).alias("px"), ((v % 60) / 10.0 + 0.05).alias("py")
    )
    return pixels.pixel_lookup(view(spark, d, "fx_pixels"), coords).select("cat_id", "beam", "stokes", "chan", "value")


@check(
    "extract_spectrum",
    f"""WITH n AS (SELECT source_id, stokes, chan, AVG(value) AS bkg, STDDEV_POP(value) AS rms FROM fx_pixels GROUP BY source_id, stokes, chan)
    SELECT p.source_id, p.beam AS cat_id, p.stokes, p.chan, {s6('p.value-n.bkg')} AS value, {s6('n.rms')} AS rms, {s6('n.bkg')} AS bkg
    FROM fx_pixels p JOIN n ON p.source_id=n.source_id AND p.stokes=n.stokes AND p.chan=n.chan WHERE p.x=3 AND p.y=4 AND p.value<>0""",
)
def _(spark, d):
    p = view(spark, d, "fx_pixels")
    noise = p.groupBy("source_id", "stokes", "chan").agg(F.avg("value").alias("background"), F.stddev_pop("value").alias("noise"))
    coords = p.select("source_id", "beam").distinct().select("source_id", F.col("beam").alias("cat_id"), F.lit(3.2).alias("px"), F.lit(3.9).alias("py"))
    cube = p.withColumnRenamed("beam", "cat_id")
    at = pixels.pixel_lookup(cube, coords, ["source_id", "cat_id"])
    out = pixels.finish_spectrum(at, noise, ["source_id"], "cat_id")
    return out.select("source_id", "cat_id", "stokes", "chan", r6("value"), r6("rms"), r6("bkg"))


HOLO = f"""h AS (SELECT c.cat_id, b.beam_id, b.ra AS bra, b.dec AS bdec, c.ra, c.dec FROM fx_components c JOIN fx_beam_inf b ON c.suppkey=b.beam_id)"""


@check(
    "holography_pixel",
    f"""WITH {HOLO} SELECT cat_id, {s6(s_sep('bra','bdec','ra','dec'))} AS off, {s6(s_pa('bra','bdec','ra','dec'))} AS ang FROM h""",
)
def _(spark, d):
    beams = view(spark, d, "fx_beam_inf").select(F.col("beam_id").alias("suppkey"), F.col("ra").alias("beam_ra"), F.col("dec").alias("beam_dec"))
    out = pixels.holography_pixel(view(spark, d, "fx_components"), beams, 0.05, 0.05, 16, 16, on="suppkey")
    return out.select("cat_id", r6("offset", "off"), r6("angle", "ang"))


@check(
    "holography_lookup",
    f"""WITH {HOLO}, o AS (SELECT cat_id, beam_id, RADIANS({s_sep('bra','bdec','ra','dec')}) AS s, RADIANS({s_pa('bra','bdec','ra','dec')}) AS a FROM h),
    m AS (SELECT cat_id, ROUND(SIN(s)*SIN(a)/0.3+4) AS hx, ROUND(SIN(s)*COS(a)/0.3+4) AS hy, beam_id%10 AS source_id FROM o)
    SELECT m.cat_id, p.beam, p.value AS leakage FROM m JOIN fx_pixels p ON m.source_id=p.source_id AND m.hx=p.x AND m.hy=p.y WHERE p.chan=0 AND p.stokes='q'""",
)
def _(spark, d):
    beams = view(spark, d, "fx_beam_inf").select(F.col("beam_id").alias("suppkey"), F.col("ra").alias("beam_ra"), F.col("dec").alias("beam_dec"))
    at = pixels.holography_pixel(view(spark, d, "fx_components"), beams, 0.3, 0.3, 4, 4, on="suppkey")
    at = at.withColumn("source_id", (F.col("suppkey") % 10).cast("int"))
    p = view(spark, d, "fx_pixels").where("chan = 0 and stokes = 'q'")
    model = p.select("source_id", "stokes", F.col("beam").alias("chan"), "y", "x", "value")
    return pixels.holography_lookup(at, model, on="source_id").select("cat_id", F.col("chan").alias("beam"), "leakage")


@check(
    "compare_leakage",
    f"""SELECT cat_id, chan, {s6('q/i')} AS q_image, {s6('u/i')} AS u_image, {s6('q/i-bq')} AS dq, {s6('u/i-bu')} AS du FROM fx_spectra""",
)
def _(spark, d):
    s = view(spark, d, "fx_spectra")
    model = s.select("cat_id", "chan", F.col("bq").alias("q"), F.col("bu").alias("u"))
    out = pixels.compare_leakage(s, model, ["cat_id", "chan"])
    return out.select("cat_id", "chan", r6("q_image"), r6("u_image"), r6("dq"), r6("du"))


@check(
    "remove_leakage",
    f"""SELECT p.beam, p.y, p.x, {s6("p.value-CASE WHEN p.stokes='i' THEN 0 ELSE p.weight*0.01*(p.chan+1) END")} AS value FROM fx_pixels p""",
)
def _(spark, d):
    p = view(spark, d, "fx_pixels").withColumn("stokes_i", F.col("weight"))
    leak = p.where("stokes <> 'i'").select("beam", "stokes", "chan", (0.01 * (F.col("chan") + 1)).alias("leakage")).distinct()
    return pixels.remove_leakage(p, leak).select("beam", "y", "x", r6("value"))


@check("same_angle_check", "SELECT source_id, MAX(weight)-MIN(weight) <= 0.000001 AS same_angle FROM fx_pixels GROUP BY source_id")
def _(spark, d):
    return pixels.same_angle_check(view(spark, d, "fx_pixels"), angle="weight")


@check(
    "stack_stokes",
    """SELECT source_id, chan, COUNT(DISTINCT stokes)=3 AS complete FROM fx_pixels GROUP BY source_id, chan""",
)
def _(spark, d):
    p = view(spark, d, "fx_pixels")
    cube = pixels.stack_stokes(*[(s, p.where(F.col("stokes") == s).drop("stokes")) for s in "iqu"])
    return pixels.stokes_complete(cube, ["source_id", "chan"])


@check(
    "swap_cube_axes",
    "SELECT beam, chan, stokes, y, x, value FROM fx_pixels",
)
def _(spark, d):
    return pixels.swap_cube_axes(view(spark, d, "fx_pixels").drop("source_id", "weight"))


@check(
    "build_cube",
    """WITH im AS (SELECT source_id, chan, y, x, MAX(value) AS value FROM fx_pixels WHERE stokes='i' GROUP BY source_id, chan, y, x),
    g AS (SELECT DISTINCT source_id, y, x FROM im), c AS (SELECT CAST(range AS INT) AS chan FROM RANGE(12)),
    f AS (SELECT g.source_id, c.chan, g.y, g.x FROM g, c)
    SELECT f.source_id, f.chan, f.y, f.x, im.value FROM f LEFT JOIN im ON f.source_id=im.source_id AND f.chan=im.chan AND f.y=im.y AND f.x=im.x""",
)
def _(spark, d):
    p = view(spark, d, "fx_pixels").where("stokes = 'i'")
    images = p.groupBy("source_id", "chan", "y", "x").agg(F.max("value").alias("value"))
    channels = p.select(F.explode(F.sequence(F.lit(0), F.lit(11))).alias("chan")).distinct()
    return pixels.build_cube(images, channels, ["source_id"])


@check(
    "merge_image_lists",
    """SELECT stokes AS pol, STRING_AGG(CONCAT('b', CAST(beam AS VARCHAR)), ';' ORDER BY CONCAT('b', CAST(beam AS VARCHAR))) AS images
    FROM (SELECT DISTINCT stokes, beam FROM fx_pixels) GROUP BY stokes""",
)
def _(spark, d):
    lists = view(spark, d, "fx_pixels").select(F.col("stokes").alias("pol"), F.concat(F.lit("b"), F.col("beam").cast("string")).alias("path")).distinct()
    out = pixels.merge_image_lists(lists)
    return out.select("pol", F.array_join("images", ";").alias("images"))


@check(
    "beam_weights_pairing",
    """WITH i AS (SELECT c_custkey AS k, c_name AS image FROM customer WHERE c_acctbal > 0),
    w AS (SELECT c_custkey AS k, c_mktsegment AS weight_image FROM customer WHERE c_nationkey > 3)
    SELECT COALESCE(i.k, w.k) AS k, i.image, w.weight_image FROM i FULL OUTER JOIN w ON i.k=w.k""",
)
def _(spark, d):
    c = table(spark, d, "customer")
    images = c.where("c_acctbal > 0").selectExpr("c_custkey k", "c_name image")
    weights = c.where("c_nationkey > 3").selectExpr("c_custkey k", "c_mktsegment weight_image")
    return pixels.pair_weights(images, weights, ["k"])
