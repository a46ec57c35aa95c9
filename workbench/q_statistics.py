"""Robust statistics, leakage, maps and catalogue flag queries."""

from pyspark.sql import functions as F

from stokesweave.functions import numeric, spectral
from stokesweave.operators import clipping, complexity, leakage, maps, orderstats, outliers, release
from workbench.registry import check, r6, s6
from workbench.views import table, view

MAD = "1.482602218505602"


@check(
    "binned_percentiles",
    f"""WITH e AS (SELECT MIN(beamdist) AS lo, MAX(beamdist) AS hi FROM fx_cat),
    b AS (SELECT CAST(FLOOR((c.beamdist-e.lo)/((e.hi-e.lo)/16)) AS INT) AS bin, e.lo, (e.hi-e.lo)/16 AS w, c.fracpol FROM fx_cat c, e
      WHERE c.beamdist < e.hi)
    SELECT bin, {s6('MIN(lo+(bin+0.5)*w)')} AS centre, COUNT(*) AS n, {s6('QUANTILE_CONT(fracpol,0.023)')} AS s2_lo,
      {s6('QUANTILE_CONT(fracpol,0.16)')} AS s1_lo, {s6('QUANTILE_CONT(fracpol,0.5)')} AS med,
      {s6('QUANTILE_CONT(fracpol,0.84)')} AS s1_up, {s6('QUANTILE_CONT(fracpol,0.976)')} AS s2_up FROM b GROUP BY bin""",
)
def _(spark, d):
    out = leakage.binned_percentiles(view(spark, d, "fx_cat"), "beamdist", "fracpol", 16)
    return out.select("bin", r6("centre"), "n", *[r6(c) for c in leakage.LEVELS])


@check(
    "grouped_quantiles",
    f"""SELECT l_returnflag, COUNT(*) AS n, {s6('QUANTILE_CONT(l_extendedprice,0.16)')} AS lo,
    {s6('QUANTILE_CONT(l_extendedprice,0.5)')} AS mid, {s6('QUANTILE_CONT(l_extendedprice,0.84)')} AS up
    FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, d):
    q = {"lo": 0.16, "mid": 0.5, "up": 0.84}
    out = orderstats.grouped_quantiles(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", q)
    return out.select("l_returnflag", "n", *[r6(c) for c in q])


@check(
    "mad_std",
    f"""WITH m AS (SELECT stokes, chan, MEDIAN(value) AS md FROM fx_pixels GROUP BY stokes, chan)
    SELECT p.stokes, p.chan, COUNT(*) AS n, {s6('MIN(m.md)')} AS median, {s6(f'MEDIAN(ABS(p.value-m.md))*{MAD}')} AS mad_std
    FROM fx_pixels p JOIN m ON p.stokes=m.stokes AND p.chan=m.chan GROUP BY p.stokes, p.chan""",
)
def _(spark, d):
    out = orderstats.mad_std(view(spark, d, "fx_pixels"), ["stokes", "chan"], "value")
    return out.select("stokes", "chan", "n", r6("median"), r6("mad_std"))


def _trim(src, key, val):
    return f"""r AS (SELECT {key} AS k, {val} AS v, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {val}) AS rn,
      COUNT(*) OVER (PARTITION BY {key}) AS n FROM {src})"""


@check(
    "trimmed_mean",
    f"""WITH {_trim('fx_pixels', 'source_id', 'value')} SELECT k AS source_id, MIN(n) AS n, {s6('AVG(v)')} AS trimmed_mean FROM r
    WHERE rn > FLOOR(n*0.2) AND rn <= n-FLOOR(n*0.2) GROUP BY k""",
)
def _(spark, d):
    out = orderstats.trimmed_mean(view(spark, d, "fx_pixels"), ["source_id"], "value", 0.2)
    return out.select("source_id", "n", r6("trimmed_mean"))


@check(
    "sigma_clip_pass",
    f"""WITH m AS (SELECT source_id, MEDIAN(value) AS md, COUNT(*) AS n FROM fx_pixels GROUP BY source_id),
    s AS (SELECT p.source_id, MEDIAN(ABS(p.value-m.md))*{MAD} AS sd FROM fx_pixels p JOIN m ON p.source_id=m.source_id GROUP BY p.source_id)
    SELECT p.source_id, {s6('MIN(m.md)')} AS median, {s6('MIN(s.sd)')} AS mad_std, MIN(m.n) AS n_before,
      COUNT(*) FILTER (WHERE ABS(p.value-m.md) <= 2*s.sd) AS n_after
    FROM fx_pixels p JOIN m ON p.source_id=m.source_id JOIN s ON p.source_id=s.source_id GROUP BY p.source_id""",
)
def _(spark, d):
    out = clipping.clip_pass(view(spark, d, "fx_pixels"), ["source_id"], "value", 2.0)
    return out.select("source_id", r6("median"), r6("mad_std"), "n_before", "n_after")


def _sql_passes(n, centre, scale, sigma):
    """Fixed number of clip passes as chained CTEs."""
    prev, parts = "t0", ["t0 AS (SELECT l_suppkey AS k, l_extendedprice*l_extendedprice AS v FROM lineitem)"]
    for i in range(1, n + 1):
        parts.append(
            f"s{i} AS (SELECT k, {centre}(v) AS c, {scale}(v) AS s FROM {prev} GROUP BY k),"
            f"t{i} AS (SELECT t.k, t.v FROM {prev} t JOIN s{i} ON t.k=s{i}.k WHERE t.v BETWEEN c-{sigma}*s AND c+{sigma}*s)"
        )
        prev = f"t{i}"
    return ", ".join(parts), prev


_parts, _last = _sql_passes(3, "AVG", "STDDEV_POP", 1.5)


@check("sigma_clip_fixed", f"WITH {_parts} SELECT k AS l_suppkey, COUNT(*) AS n_kept FROM {_last} GROUP BY k")
def _(spark, d):
    rows = table(spark, d, "lineitem").withColumn("v", F.col("l_extendedprice") * F.col("l_extendedprice"))
    lim = clipping.clip_limits(rows, ["l_suppkey"], "v", 1.5, "mean", "std", maxiters=3)
    return lim.select("l_suppkey", "n_kept")


def s_clipped(source: str, keys: str, value: str, sigma: float, centre: str, scale: str, passes: int = 60) -> str:
    """CTEs ``k`` and ``l``: clipping pass by pass until nothing can change, and the limits of what is left by key.

    ``source`` has the columns ``keys``, at least one of them, and the value; ``mad`` is the normal-consistent deviation.
    """
    mid = f"{'MEDIAN' if centre == 'median' else 'AVG'}(v)"
    per = ",".join(keys.split())
    spread = "1.482602218505602*MEDIAN(ABS(v-med)) OVER w" if scale == "mad" else "STDDEV_POP(v) OVER w"
    whole = "1.482602218505602*MEDIAN(ABS(v-med))" if scale == "mad" else "STDDEV_POP(v)"
    return f"""k AS (SELECT {per}, {value} AS v, 0 AS pass FROM {source}
      UNION ALL SELECT {per}, v, pass+1 FROM (SELECT *, {spread} AS s FROM (SELECT *, {mid} OVER w AS m, MEDIAN(v) OVER w AS med FROM k WHERE pass < {passes}
        WINDOW w AS (PARTITION BY {per})) WINDOW w AS (PARTITION BY {per})) WHERE v BETWEEN m-{sigma}*s AND m+{sigma}*s),
    l AS (SELECT {per}, ANY_VALUE(m) AS centre, {whole} AS scale, ANY_VALUE(m)-{sigma}*{whole} AS lo, ANY_VALUE(m)+{sigma}*{whole} AS hi, COUNT(*) AS n_kept
      FROM (SELECT *, {mid} OVER w AS m, MEDIAN(v) OVER w AS med FROM k WHERE pass={passes} WINDOW w AS (PARTITION BY {per})) GROUP BY {per})"""


_CONVERGED = s_clipped("(SELECT l_returnflag, l_extendedprice*l_extendedprice AS x FROM lineitem)", "l_returnflag", "x", 1.9, "median", "std", 250)


@check(
    "sigma_clip_converged",
    f"WITH RECURSIVE {_CONVERGED} SELECT l_returnflag, {s6('centre', 2)} AS centre, {s6('scale', 2)} AS scale, {s6('lo', 2)} AS lo, {s6('hi', 2)} AS hi, n_kept FROM l",
)
def _(spark, d):
    rows = table(spark, d, "lineitem").withColumn("v", F.col("l_extendedprice") * F.col("l_extendedprice"))
    out = clipping.clip_limits(rows, ["l_returnflag"], "v", 1.9, "median", "std", small_group=18000)
    return out.select("l_returnflag", *[r6(c, digits=2) for c in ("centre", "scale", "lo", "hi")], "n_kept")


# the tree by rows, a level per step: gaps first, then medians; then clipping to the end
OUTLIERS_SQL = """WITH RECURSIVE g AS MATERIALIZED (SELECT cat_id, rm, LEAST(CAST(FLOOR((ra-360.0*FLOOR(ra/360.0))/360.0*1048576) AS BIGINT), 1048575) AS ix,
      LEAST(CAST(FLOOR((SIN(RADIANS(dec))+1.0)/2.0*1048576) AS BIGINT), 1048575) AS iy FROM fx_cat WHERE NOT si_flag AND isfinite(rm)),
    t AS (SELECT cat_id, rm, ix, iy, '' AS node, FALSE AS leaf FROM g
      UNION ALL SELECT cat_id, rm, ix, iy,
        CASE WHEN axis IS NULL THEN node WHEN CASE WHEN axis='x' THEN ix ELSE iy END > edge THEN node||'1' ELSE node||'0' END, axis IS NULL
      FROM (SELECT *, CASE WHEN xg IS NOT NULL THEN 'x' WHEN yg IS NOT NULL THEN 'y' WHEN n>=60 AND (x1>x0 OR y1>y0) THEN CASE WHEN lx THEN 'x' ELSE 'y' END END AS axis,
          COALESCE(xg, yg, CASE WHEN lx THEN LEAST(xm, x1-1) ELSE LEAST(ym, y1-1) END) AS edge
        FROM (SELECT *, ((x1-x0)*360.0*(1.0-(CAST(y1+y0 AS DOUBLE)/1048576-1.0)*(CAST(y1+y0 AS DOUBLE)/1048576-1.0)) >= (y1-y0)*(360.0/PI()) AND x1>x0) OR y1=y0 AS lx,
            CASE WHEN xs > GREATEST(xv-x0, x1-xv-xs, 1) THEN xv END AS xg, CASE WHEN ys > GREATEST(yv-y0, y1-yv-ys, 1) THEN yv END AS yg
          FROM (SELECT *, MIN(CASE WHEN sx=xs THEN ix END) OVER w AS xv, MIN(CASE WHEN sy=ys THEN iy END) OVER w AS yv,
              MIN(CASE WHEN rx>=(n+1)//2 THEN ix END) OVER w AS xm, MIN(CASE WHEN ry>=(n+1)//2 THEN iy END) OVER w AS ym
            FROM (SELECT *, MAX(sx) OVER w AS xs, MAX(sy) OVER w AS ys FROM (SELECT *, COUNT(*) OVER w AS n, MIN(ix) OVER w AS x0, MAX(ix) OVER w AS x1, MIN(iy) OVER w AS y0,
                MAX(iy) OVER w AS y1, LEAD(ix) OVER (PARTITION BY node ORDER BY ix) - ix AS sx, LEAD(iy) OVER (PARTITION BY node ORDER BY iy) - iy AS sy,
                ROW_NUMBER() OVER (PARTITION BY node ORDER BY ix) AS rx, ROW_NUMBER() OVER (PARTITION BY node ORDER BY iy) AS ry
              FROM t WHERE NOT leaf WINDOW w AS (PARTITION BY node)) WINDOW w AS (PARTITION BY node)) WINDOW w AS (PARTITION BY node))))),
    k AS (SELECT cat_id, rm, node, 0 AS pass FROM t WHERE leaf
      UNION ALL SELECT cat_id, rm, node, pass+1 FROM (SELECT *, MEDIAN(rm) OVER w AS m, STDDEV_POP(rm) OVER w AS s FROM k WHERE pass < 40 WINDOW w AS (PARTITION BY node))
      WHERE rm BETWEEN m-3.0*s AND m+3.0*s),
    l AS (SELECT node, MEDIAN(rm) AS m, STDDEV_POP(rm) AS s FROM k WHERE pass=40 GROUP BY node),
    b AS (SELECT t.cat_id FROM t JOIN l ON t.node=l.node WHERE t.leaf AND NOT (t.rm BETWEEN l.m-3.0*l.s AND l.m+3.0*l.s))
    SELECT c.field_name, b.cat_id IS NOT NULL AS local_rm_flag, COUNT(*) AS n FROM fx_cat c LEFT JOIN b ON c.cat_id=b.cat_id GROUP BY ALL"""


@check("local_outliers", OUTLIERS_SQL)
def _(spark, d):
    cat = view(spark, d, "fx_cat").withColumn("good", ~F.col("si_flag"))
    return outliers.local_outliers(cat, "good").groupBy("field_name", "local_rm_flag").agg(F.count("*").alias("n"))


@check("fit_envelope")
def _(spark, d):
    cat = view(spark, d, "fx_cat")
    coef = leakage.fit_envelope(cat, 16, 4, signal="snr_polint", noise="beam_maj")
    return cat.select("cat_id", spectral.eval_poly("beamdist", coef).alias("leakage"))


@check("map_centre", f"SELECT {s6('AVG(ra)')} AS ra0, {s6('AVG(dec)')} AS dec0 FROM fx_components")
def _(spark, d):
    return maps.map_centre(view(spark, d, "fx_components")).select(r6("ra0"), r6("dec0"))


BINNED = f"""WITH m AS (SELECT AVG(ra) AS ra0, AVG(dec) AS dec0 FROM fx_cat),
    t AS (SELECT rm AS value, RADIANS(dec) AS d, RADIANS(ra-ra0) AS a, RADIANS(dec0) AS d0 FROM fx_cat, m),
    p AS (SELECT value, DEGREES(COS(d)*SIN(a))/(8.0/512)+255.0 AS x, DEGREES(COS(d0)*SIN(d)-SIN(d0)*COS(d)*COS(a))/(8.0/512)+255.0 AS y
      FROM t WHERE SIN(d0)*SIN(d)+COS(d0)*COS(d)*COS(a) >= 0),
    e AS (SELECT MIN(x) AS x0, MAX(x) AS x1, MIN(y) AS y0, MAX(y) AS y1 FROM p),
    c AS (SELECT value, CAST(LEAST(FLOOR((x-x0)/((x1-x0)/15)),14) AS INT) AS bx, CAST(LEAST(FLOOR((y-y0)/((y1-y0)/15)),14) AS INT) AS cy
      FROM p, e),
    g AS (SELECT CAST(a.range AS INT) AS bx, CAST(b.range AS INT) AS cy FROM RANGE(15) a, RANGE(15) b),
    k AS (SELECT bx, cy, MEDIAN(value) AS v, COUNT(*) AS n FROM c GROUP BY bx, cy)
    SELECT g.cy AS y_bin, 14-g.bx AS x_bin, {s6('k.v')} AS value, COALESCE(k.n,0) AS n FROM g LEFT JOIN k ON g.bx=k.bx AND g.cy=k.cy"""


@check("binned_map_unclipped", BINNED)
def _(spark, d):
    return maps.binned_map(view(spark, d, "fx_cat"), "rm", clip=False).select("y_bin", "x_bin", r6("value"), "n")


_CELLS = BINNED.index("k AS (")


@check(
    "binned_map",
    f"""WITH RECURSIVE {BINNED[5:_CELLS]}{s_clipped('c', 'bx cy', 'value', 3.0, 'median', 'mad')},
    r AS (SELECT c.bx, c.cy, MEDIAN(value) AS v, COUNT(*) AS n FROM c JOIN l ON c.bx=l.bx AND c.cy=l.cy WHERE value BETWEEN lo AND hi GROUP BY ALL)
    SELECT g.cy AS y_bin, 14-g.bx AS x_bin, {s6('r.v')} AS value, COALESCE(r.n,0) AS n FROM g LEFT JOIN r ON g.bx=r.bx AND g.cy=r.cy""",
)
def _(spark, d):
    return maps.binned_map(view(spark, d, "fx_cat"), "rm").select("y_bin", "x_bin", r6("value"), "n")


@check("gridded_map")
def _(spark, d):
    return maps.gridded_map(view(spark, d, "fx_cat"), "rm", "cat_id", npix=512, map_size=100.0)


@check(
    "map_summary",
    f"""SELECT COUNT(rm) AS n, {s6('MEDIAN(rm)')} AS median, {s6('MEDIAN(ABS(rm))')} AS absmed, {s6('STDDEV_POP(rm)')} AS std,
    {s6('MIN(rm)')} AS min FROM fx_cat""",
)
def _(spark, d):
    out = maps.map_summary(view(spark, d, "fx_cat"), "rm")
    return out.select("n", *[r6(c) for c in ("median", "absmed", "std", "min")])


LEAK_POINTS = """pts AS (SELECT cat_id, ra AS x, dec AS y, fracpol AS q, tax AS u FROM fx_cat)"""


@check(
    "aperture_join",
    f"""WITH {LEAK_POINTS} SELECT f.field_name, CAST(COUNT(*) AS BIGINT) AS n, {s6('AVG(SQRT(POWER(p.x-f.ra,2)+POWER(p.y-f.dec,2)))')} AS mean_dist
    FROM fx_fields f, pts p WHERE SQRT(POWER(p.x-f.ra,2)+POWER(p.y-f.dec,2)) < 10 GROUP BY f.field_name""",
)
def _(spark, d):
    nodes = view(spark, d, "fx_fields").select("field_name", F.col("ra").alias("x"), F.col("dec").alias("y"))
    pts = view(spark, d, "fx_cat").select("cat_id", F.col("ra").alias("x"), F.col("dec").alias("y"))
    pairs = leakage.aperture_join(nodes, pts, 10.0, ["field_name"])
    return pairs.groupBy("field_name").agg(F.count("*").alias("n"), r6(F.avg("dist"), "mean_dist"))


def _leak_sql(col):
    return f"""SELECT k, MIN(n) AS n, AVG(v) AS {col} FROM (SELECT node AS k, {col} AS v,
      ROW_NUMBER() OVER (PARTITION BY node ORDER BY {col}) AS rn, COUNT(*) OVER (PARTITION BY node) AS n FROM ap)
      WHERE rn > FLOOR(n*0.2) AND rn <= n-FLOOR(n*0.2) GROUP BY k"""


@check(
    "leakage_map",
    f"""WITH {LEAK_POINTS}, b AS (SELECT MIN(x) AS x0, MAX(x) AS x1, MIN(y) AS y0, MAX(y) AS y1 FROM pts),
    g AS (SELECT CAST(i.range*CEIL((y1+12.0-y0)/12.0)+j.range AS BIGINT) AS node, x0+i.range*12.0 AS gx, y0+j.range*12.0 AS gy
      FROM b, RANGE(40) i, RANGE(40) j WHERE i.range < CEIL((x1+12.0-x0)/12.0) AND j.range < CEIL((y1+12.0-y0)/12.0)),
    ap AS (SELECT node, q, u, SQRT(q*q+u*u) AS p FROM g, pts WHERE SQRT(POWER(pts.x-gx,2)+POWER(pts.y-gy,2)) < 5.0),
    tq AS ({_leak_sql('q')}), tu AS ({_leak_sql('u')}), tp AS ({_leak_sql('p')})
    SELECT g.node AS node_id, {s6('gx')} AS x, {s6('gy')} AS y, COALESCE(tq.n,0) AS n,
      {s6('CASE WHEN tq.n >= 5 THEN tq.q END')} AS q, {s6('CASE WHEN tq.n >= 5 THEN tu.u END')} AS u,
      {s6('CASE WHEN tq.n >= 5 THEN tp.p END')} AS p
    FROM g LEFT JOIN tq ON g.node=tq.k LEFT JOIN tu ON g.node=tu.k LEFT JOIN tp ON g.node=tp.k""",
)
def _(spark, d):
    pts = view(spark, d, "fx_cat").select(F.col("ra").alias("x"), F.col("dec").alias("y"), F.col("fracpol").alias("q"), F.col("tax").alias("u"))
    out = leakage.leakage_map(pts, 5.0, step=12.0)
    return out.select("node_id", r6("x"), r6("y"), "n", r6("q"), r6("u"), r6("p"))


@check("leakage_map_quarter_radius")
def _(spark, d):
    pts = view(spark, d, "fx_cat").select(F.col("ra").alias("x"), F.col("dec").alias("y"), F.col("fracpol").alias("q"), F.col("tax").alias("u"))
    out = leakage.leakage_map(pts, 5.0)
    return out.select("node_id", r6("x"), r6("y"), "n", r6("q"), r6("u"), r6("p"))


# --- flags and scalar columns --------------------------------------------------


@check(
    "quality_flags",
    """WITH f AS (SELECT cat_id, snr_polint < 8 AS snr_flag, fracpol < 0.01*beamdist AS leakage_flag,
      nchan < 150 AS channel_flag, si_flag, snr_polint, rm > 10*rm_err AS complex_flag FROM fx_cat)
    SELECT cat_id, snr_flag, leakage_flag, complex_flag, NOT si_flag AND NOT channel_flag AS good_i,
      NOT si_flag AND NOT channel_flag AND NOT leakage_flag AND snr_polint > 5 AS good_l,
      NOT si_flag AND NOT channel_flag AND NOT leakage_flag AND snr_polint > 5 AND NOT snr_flag AS good_rm FROM f""",
)
def _(spark, d):
    cat = view(spark, d, "fx_cat").withColumns(
        {
            "snr_flag": spectral.snr_flag("snr_polint"),
            "leakage_flag": spectral.leakage_flag("fracpol", spectral.eval_poly("beamdist", [0.0, 0.01])),
            "channel_flag": F.col("nchan") < 150,
            "complex_flag": spectral.complex_sigma_add_flag("rm", "rm_err"),
        }
    )
    good = spectral.good_rm(stokes_i_flag="si_flag")
    return cat.select("cat_id", "snr_flag", "leakage_flag", "complex_flag", *[c.alias(n) for n, c in good.items()])


@check(
    "quality_subset",
    """SELECT cat_id, rm FROM fx_cat WHERE NOT (snr_polint < 8) AND NOT (fracpol < 0.01*beamdist) AND NOT (nchan < 150)
    AND NOT si_flag AND NOT (lstatus = 'O')""",
)
def _(spark, d):
    cat = view(spark, d, "fx_cat").withColumns(
        {
            "snr_flag": spectral.snr_flag("snr_polint"),
            "leakage_flag": F.col("fracpol") < 0.01 * F.col("beamdist"),
            "channel_flag": F.col("nchan") < 150,
            "stokesI_fit_flag": F.col("si_flag"),
            "local_rm_flag": F.col("lstatus") == "O",
        }
    )
    return cat.where(spectral.quality_cut()).select("cat_id", "rm")


@check(
    "hi_snr",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_tax > 0 AND l_quantity/l_tax > 300",
)
def _(spark, d):
    li = table(spark, d, "lineitem")
    return li.where(spectral.hi_snr("l_quantity", "l_tax", 300)).select("l_orderkey", "l_linenumber", "l_extendedprice")


@check(
    "finite_only",
    "SELECT cat_id, snr_polint/rm AS ratio FROM fx_cat WHERE rm <> 0 AND fracpol/NULLIF(tax,0) IS NOT NULL",
)
def _(spark, d):
    inf = F.when(F.col("rm") == 0, F.lit(float("inf"))).otherwise(numeric.ratio("snr_polint", "rm"))
    nan = F.coalesce(numeric.ratio("fracpol", "tax"), F.lit(float("nan")))
    cat = view(spark, d, "fx_cat").withColumns({"ratio": inf, "other": nan})
    return cat.where(spectral.finite_pair("ratio", "other")).select("cat_id", "ratio")


@check(
    "inf_to_nan",
    "SELECT cat_id, CASE WHEN tax = 0 THEN NULL ELSE fracpol/tax END AS ratio, rm FROM fx_cat",
)
def _(spark, d):
    ratio = F.when(F.col("tax") == 0, F.lit(float("inf"))).otherwise(numeric.ratio("fracpol", "tax"))
    return numeric.inf_to_nan(view(spark, d, "fx_cat").select("cat_id", ratio.alias("ratio"), "rm")).select(
        "cat_id", F.nanvl("ratio", F.lit(None)).alias("ratio"), "rm"
    )


@check(
    "fit_status_flags",
    """SELECT p_partkey, p_size*4 >= 128 AS is_negative, p_size*4 >= 64 AS is_close_to_zero, p_size*4 >= 16 AS is_not_finite,
    p_size*4 >= 5 AS is_not_normal, p_size*4 >= 128 OR p_size*4 >= 64 OR p_size*4 >= 16 AS any_flag FROM part""",
)
def _(spark, d):
    flags = spectral.fit_status_flags(F.col("p_size") * 4)
    return table(spark, d, "part").select(
        "p_partkey",
        *[c.alias(n) for n, c in flags.items()],
        spectral.stokes_i_fit_flag(flags["is_negative"], flags["is_close_to_zero"], flags["is_not_finite"]).alias("any_flag"),
    )


@check(
    "power_laws",
    f"""SELECT p_partkey, {s6('p_retailprice*POWER(p_size/10.0,-0.8)')} AS pl, p_retailprice*10.0 AS flat,
    {s6('p_retailprice*POWER(p_size/10.0,-0.8+0.1*LOG10(p_size/10.0))')} AS curved FROM part""",
)
def _(spark, d):
    nu, s = F.col("p_size").cast("double"), F.col("p_retailprice")
    return table(spark, d, "part").select(
        "p_partkey",
        r6(spectral.power_law(nu, s, F.lit(-0.8), F.lit(10.0)), "pl"),
        spectral.flat_power_law(s, F.lit(10.0)).alias("flat"),
        r6(spectral.curved_power_law(nu, s, F.lit(-0.8), F.lit(0.1), F.lit(10.0)), "curved"),
    )


@check(
    "taylor_power_law",
    f"""SELECT p_partkey, {s6('-(-0.001*p_size*p_retailprice)/p_retailprice')} AS alpha,
    {s6('p_retailprice*POWER(0.9,(-0.001*p_size*p_retailprice)/p_retailprice)')} AS model FROM part""",
)
def _(spark, d):
    tt1 = F.col("p_retailprice") * F.col("p_size") * -0.001
    return table(spark, d, "part").select(
        "p_partkey",
        r6(spectral.taylor_alpha("p_retailprice", tt1), "alpha"),
        r6(spectral.taylor_power_law(F.lit(0.9e9), "p_retailprice", tt1, F.lit(1.0e9)), "model"),
    )


@check(
    "pol_fractions",
    f"""SELECT cat_id, chan, {s6('SQRT(q*q+u*u)')} AS p, {s6('q/i')} AS qf, {s6('u/i')} AS uf, {s6('POWER(299792458.0/freq,2)')} AS l2
    FROM fx_spectra""",
)
def _(spark, d):
    return view(spark, d, "fx_spectra").select(
        "cat_id",
        "chan",
        r6(spectral.pol_intensity("q", "u"), "p"),
        r6(spectral.frac_pol("q", "i"), "qf"),
        r6(spectral.frac_pol("u", "i"), "uf"),
        r6(spectral.lambda_sq("freq"), "l2"),
    )


_ZL, _ZH = repr(spectral.Z_LOW), repr(spectral.Z_HIGH)


@check(
    "lognorm_params",
    f"""SELECT cat_id, {s6(f'(LN(fracpol+0.03)-LN(fracpol+0.01))/({_ZH}-({_ZL}))')} AS shape,
    {s6(f'EXP((LN(fracpol+0.01)*{_ZH}-LN(fracpol+0.03)*({_ZL}))/({_ZH}-({_ZL})))')} AS scale FROM fx_cat""",
)
def _(spark, d):
    shape, scale = spectral.lognorm_params(F.col("fracpol") + 0.01, F.col("fracpol") + 0.03)
    return view(spark, d, "fx_cat").select("cat_id", r6(shape, "shape"), r6(scale, "scale"))


@check("sigma_add")
def _(spark, d):
    cat = view(spark, d, "fx_cat").select(
        "cat_id",
        (F.col("fracpol") + 0.1).alias("sigma_add_Q"),
        (F.col("tax") + 0.1).alias("sigma_add_U"),
        *[F.lit(0.05).alias(f"sigma_add_{s}_err_{k}") for s in "QU" for k in ("minus", "plus")],
    )
    return complexity.sigma_add(cat)


@check(
    "spectral_index",
    """SELECT p_partkey, p_size/100.0 AS alpha, CAST(0.5 AS DOUBLE) AS alpha_err, p_retailprice AS beta, CAST(NULL AS DOUBLE) AS beta_err FROM part""",
)
def _(spark, d):
    coefs = F.concat_ws(",", F.lit("nan"), F.col("p_retailprice").cast("string"), (F.col("p_size") / 100.0).cast("string"), F.lit("7.5"))
    cols = spectral.spectral_index(coefs, F.lit("0.5,0.25"))
    return table(spark, d, "part").select("p_partkey", *[c.alias(n) for n, c in cols.items()])


@check(
    "pad_coefs",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN 'nan,nan,nan,2.5,1.5' ELSE 'nan,nan,nan,nan,0.5' END AS coefs FROM part""",
)
def _(spark, d):
    arr = F.when(F.col("p_size") > 25, F.array(F.lit(1.5), F.lit(2.5))).otherwise(F.array(F.lit(0.5)))
    return table(spark, d, "part").select("p_partkey", spectral.pad_coefs(arr).alias("coefs"))


@check(
    "epoch_and_poly",
    f"""SELECT cat_id, {s6('start_time+900.0/(2.0*86400.0)')} AS epoch, {s6('start_time+900.0')} AS ends,
    {s6('0.5+0.25*beamdist-0.125*POWER(beamdist,2)',9)} AS leakage FROM fx_cat""",
)
def _(spark, d):
    return view(spark, d, "fx_cat").select(
        "cat_id",
        r6(spectral.epoch_mid("start_time", F.lit(900.0)), "epoch"),
        r6(spectral.observation_end("start_time", F.lit(900.0)), "ends"),
        r6(spectral.eval_poly("beamdist", [0.5, 0.25, -0.125]), "leakage", 9),
    )


# --- release ---------------------------------------------------------------------


@check("by_source", "SELECT source_id, cat_id FROM fx_cat ORDER BY source_id, cat_id")
def _(spark, d):
    return view(spark, d, "fx_cat").select("source_id", "cat_id").orderBy("source_id", "cat_id")


@check("release_order", "SELECT cat_id, si_flag, snr_polint FROM fx_cat ORDER BY si_flag, snr_polint DESC, cat_id")
def _(spark, d):
    return release.release_order(view(spark, d, "fx_cat"), flag="si_flag").select("cat_id", "si_flag", "snr_polint")


@check("release_top", "SELECT cat_id, snr_polint FROM fx_cat ORDER BY si_flag, snr_polint DESC, cat_id LIMIT 100")
def _(spark, d):
    return release.release_subset(view(spark, d, "fx_cat"), "test", flag="si_flag").select("cat_id", "snr_polint")


@check("release_cut", "SELECT cat_id, snr_polint FROM fx_cat WHERE NOT si_flag")
def _(spark, d):
    return release.release_subset(view(spark, d, "fx_cat"), "cut", flag="si_flag").select("cat_id", "snr_polint")


@check(
    "order_like_catalogue",
    """WITH p AS (SELECT o_orderkey AS source_id, CASE WHEN o_orderstatus='O' THEN 'weight' ELSE 'image' END AS kind,
      CASE WHEN o_orderkey%3=0 THEN 'i' WHEN o_orderkey%3=1 THEN 'q' ELSE 'u' END AS stokes FROM orders)
    SELECT p.source_id, p.kind, p.stokes, i.n_rows AS rank, CASE WHEN kind='weight' THEN 3 ELSE 0 END
      + CASE stokes WHEN 'i' THEN 1 WHEN 'q' THEN 2 ELSE 3 END AS slot
    FROM p JOIN fx_islands i ON p.source_id=i.source_id ORDER BY rank, slot, source_id""",
)
def _(spark, d):
    key = F.col("o_orderkey")
    products = table(spark, d, "orders").select(
        key.alias("source_id"),
        F.when(F.col("o_orderstatus") == "O", "weight").otherwise("image").alias("kind"),
        F.when(key % 3 == 0, "i").when(key % 3 == 1, "q").otherwise("u").alias("stokes"),
    )
    islands = view(spark, d, "fx_islands").select("source_id", F.col("n_rows").alias("rank"))
    return release.order_like_catalogue(products, islands).select("source_id", "kind", "stokes", "rank", "slot")


@check(
    "unique_products",
    """SELECT (SELECT COUNT(DISTINCT o_orderkey) FROM orders) AS n_products, (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS n_catalogue,
    (SELECT COUNT(DISTINCT o_orderkey) FROM orders) = (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS complete""",
)
def _(spark, d):
    products = table(spark, d, "orders").select(F.col("o_orderkey").alias("source_id"))
    return release.unique_products(products, view(spark, d, "fx_islands")).select("n_products", "n_catalogue", "complete")
