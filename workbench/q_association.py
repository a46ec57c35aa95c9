"""Association, scalar geometry and field selection queries."""

from pyspark.sql import functions as F

from stokesweave.functions import numeric, sky, text
from stokesweave.operators import association, fields, keyed, pixels, release
from workbench.registry import check, r6, s6, s_pa, s_sep, s_wrap
from workbench.views import table, view

SEP_CF = s_sep("f.ra", "f.dec", "c.ra", "c.dec")


@check(
    "sky_radius_join",
    f"""SELECT i.source_id, b.beam_id, {s6(s_sep('b.ra','b.dec','i.ra','i.dec'))} AS sep
    FROM fx_islands i, fx_beam_inf b WHERE {s_sep('b.ra','b.dec','i.ra','i.dec')} < 1.0""",
)
def _(spark, d):
    beams = view(spark, d, "fx_beam_inf").select("beam_id", "ra", "dec")
    islands = view(spark, d, "fx_islands").select("source_id", "ra", "dec")
    out = association.sky_radius_join(beams, islands, 1.0)
    return out.select("source_id", "beam_id", r6("sep"))


@check(
    "sources_near_position",
    f"""SELECT source_id, {s6(s_sep('10.0','(-30.0)','ra','dec'))} AS sep FROM fx_islands
    WHERE {s_sep('10.0','(-30.0)','ra','dec')} < 12.0""",
)
def _(spark, d):
    near = association.sources_near(view(spark, d, "fx_islands"), 10.0, -30.0, 12.0)
    return near.select("source_id", r6(sky.sep_deg(F.lit(10.0), F.lit(-30.0), "ra", "dec"), "sep"))


@check(
    "nearest_match",
    f"""WITH p AS (SELECT b.beam_id, i.source_id, {s_sep('b.ra','b.dec','i.ra','i.dec')} AS sep
      FROM fx_beam_inf b, fx_islands i),
    k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY beam_id ORDER BY sep, source_id) AS rn FROM p WHERE sep < 1.0)
    SELECT beam_id, source_id, {s6('sep')} AS sep FROM k WHERE rn = 1""",
)
def _(spark, d):
    out = association.nearest_match(
        view(spark, d, "fx_beam_inf"), view(spark, d, "fx_islands"), 1.0, "beam_id", "source_id"
    )
    return out.select("beam_id", "source_id", r6("sep"))


@check(
    "nearest_field",
    f"""WITH p AS (SELECT c.cat_id, f.field_name, f.sbid, {SEP_CF} AS sep FROM fx_components c, fx_fields f),
    k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cat_id ORDER BY sep, field_name) AS rn FROM p)
    SELECT cat_id, field_name, sbid, {s6('sep')} AS sep FROM k WHERE rn = 1""",
)
def _(spark, d):
    out = association.nearest_field(
        view(spark, d, "fx_components").select("cat_id", "ra", "dec"),
        view(spark, d, "fx_fields"),
        ["field_name", "sbid"],
        "field_name",
    )
    return out.select("cat_id", F.col("near_field_name").alias("field_name"), F.col("near_sbid").alias("sbid"), r6("near_sep", "sep"))


@check(
    "reassign_fields",
    f"""WITH p AS (SELECT c.cat_id, f.field_name, f.sbid, {SEP_CF} AS sep FROM fx_cat c, fx_fields f WHERE f.sel=1),
    k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cat_id ORDER BY sep, field_name) AS rn FROM p)
    SELECT c.cat_id, CASE WHEN w.sel=0 THEN k.field_name ELSE c.field_name END AS field_name,
      CASE WHEN w.sel=0 THEN k.sbid ELSE c.sbid END AS sbid,
      {s6("CASE WHEN w.sel=0 THEN k.sep ELSE c.beamdist END")} AS beamdist
    FROM fx_cat c JOIN k ON c.cat_id=k.cat_id AND k.rn=1 JOIN fx_fields w ON w.field_name=c.field_name""",
)
def _(spark, d):
    cat = view(spark, d, "fx_cat").select("cat_id", "ra", "dec", "field_name", "sbid", "beamdist")
    every = view(spark, d, "fx_fields")
    good = every.where("sel = 1")
    wanted = [r.field_name for r in good.select("field_name").collect()]
    out = association.reassign_fields(
        cat,
        good.withColumnsRenamed({"field_name": "tile", "sbid": "block"}),
        ~F.col("field_name").isin(wanted),
        {"field_name": "tile", "sbid": "block"},
        "tile",
        sep_cols=("beamdist",),
    )
    return out.select("cat_id", "field_name", "sbid", r6("beamdist"))


BLENDS = """WITH s AS (SELECT source_id, COUNT(*) AS n, MAX(beam_maj) AS r FROM fx_components GROUP BY source_id),
    p AS (SELECT a.cat_id, b.total_i_flux AS f FROM fx_components a
      JOIN fx_components b ON a.source_id=b.source_id AND a.cat_id<>b.cat_id
      JOIN s ON a.source_id=s.source_id WHERE {sep} > 0 AND {sep} < s.r),
    k AS (SELECT cat_id, COUNT(*) AS n_blended, SUM(f) AS near FROM p GROUP BY cat_id)
    SELECT c.source_id, c.cat_id, COALESCE(k.n_blended,0) > 0 AS is_blended_flag,
      CAST(COALESCE(k.n_blended,0) AS BIGINT) AS n_blended,
      {ratio} AS blend_ratio
    FROM fx_components c JOIN s ON c.source_id=s.source_id LEFT JOIN k ON c.cat_id=k.cat_id""".format(
    sep=s_sep("a.ra", "a.dec", "b.ra", "b.dec"),
    ratio=s6("CASE WHEN s.n > 1 THEN c.total_i_flux/(c.total_i_flux+COALESCE(k.near,0)) END"),
)


@check("blended_components", BLENDS)
def blended(spark, d):
    out = association.blended_components(view(spark, d, "fx_components"))
    return out.select(
        "source_id", "cat_id", "is_blended_flag", "n_blended", r6(F.nanvl("blend_ratio", F.lit(None)), "blend_ratio")
    )


@check(
    "close_pairs",
    f"""SELECT a.source_id, a.cat_id, b.cat_id AS cat_id_2, {s6(s_sep('a.ra','a.dec','b.ra','b.dec'))} AS sep
    FROM fx_components a JOIN fx_components b ON a.source_id=b.source_id AND a.cat_id<b.cat_id
    WHERE {s_sep('a.ra','a.dec','b.ra','b.dec')} < 0.03""",
)
def _(spark, d):
    out = association.close_pairs(view(spark, d, "fx_components"), "source_id", "cat_id", 0.03)
    return out.withColumn("sep", r6("sep"))


WIDEST = f"""WITH b AS (SELECT source_id, MIN(dec) AS lo, MAX(dec) AS hi,
      CASE WHEN ABS(MAX(dec)) > ABS(MIN(dec)) THEN MIN(dec) ELSE MAX(dec) END AS bd
      FROM fx_components GROUP BY source_id),
    e AS (SELECT source_id, ra, ra - 360.0*ROUND((ra-f0)/360.0) - f0 AS off, f0 FROM (
      SELECT c.source_id, c.ra, FIRST_VALUE(c.ra) OVER (PARTITION BY c.source_id ORDER BY c.ra, c.dec) AS f0 FROM fx_components c)),
    x AS (SELECT source_id, MAX(f0+off) AS l, MIN(f0+off) AS r FROM e GROUP BY source_id)
    SELECT b.source_id, {s6(s_wrap('x.l'))} AS ra_left, {s6(s_wrap('x.r'))} AS ra_right, {s6('b.bd')} AS dec_boundary,
      {s6(s_sep('x.l','b.bd','x.r','b.bd'))} AS sep FROM b JOIN x ON b.source_id=x.source_id"""


@check("widest_pair", WIDEST)
def _(spark, d):
    out = association.widest_pair(view(spark, d, "fx_components"))
    return out.select("source_id", r6("ra_left"), r6("ra_right"), r6("dec_boundary"), r6("sep"))


def s_offset(ra, dec, pa, sep):
    d2 = (
        f"ASIN(SIN(RADIANS({dec}))*COS(RADIANS({sep}))+COS(RADIANS({dec}))*SIN(RADIANS({sep}))*COS(RADIANS({pa})))"
    )
    ra2 = s_wrap(
        f"{ra}+DEGREES(ATAN2(SIN(RADIANS({pa}))*SIN(RADIANS({sep}))*COS(RADIANS({dec})),"
        f"COS(RADIANS({sep}))-SIN(RADIANS({dec}))*SIN({d2})))"
    )
    return ra2, f"DEGREES({d2})"


_PAD = "p.pad"
_TR, _BL = s_offset("p.r", "p.hi", "-45.0", _PAD), s_offset("p.l", "p.lo", "135.0", _PAD)
_TL, _BR = s_offset("p.l", "p.hi", "45.0", _PAD), s_offset("p.r", "p.lo", "-135.0", _PAD)


@check(
    "source_box",
    f"""WITH e AS (SELECT source_id, dec, f0, ra - 360.0*ROUND((ra-f0)/360.0) AS ra2, maj FROM (
      SELECT source_id, ra, dec, snr_polint AS maj, FIRST_VALUE(ra) OVER (PARTITION BY source_id ORDER BY ra, dec) AS f0
      FROM fx_components)),
    p AS (SELECT source_id, MIN(dec) AS lo, MAX(dec) AS hi, MAX(ra2) AS l, MIN(ra2) AS r,
      MAX(maj)/3600.0*SQRT(2.0) AS pad FROM e GROUP BY source_id)
    SELECT source_id, {s6(f'LEAST({_BL[1]},{_BR[1]})')} AS dec_low, {s6(f'GREATEST({_TL[1]},{_TR[1]})')} AS dec_high,
      {s6(_TL[0])} AS ra_left, {s6(_TR[0])} AS ra_right FROM p""",
)
def _(spark, d):
    out = association.source_box(view(spark, d, "fx_components"), maj_arcsec="snr_polint")
    return out.select("source_id", *[r6(c) for c in ("dec_low", "dec_high", "ra_left", "ra_right")])


def _per_field(spark, d, radius=3.0):
    islands = view(spark, d, "fx_islands").select("source_id", "ra", "dec")
    tiles = view(spark, d, "fx_fields").where("sel = 1").select(F.col("field_name").alias("tile_id"))
    pairs = association.beam_pairs(islands, view(spark, d, "fx_beam_inf"), radius, nested=True, epoch=1, tiles=tiles)
    return association.source_fields(pairs, tiles, epoch=1)


PER_FIELD = f"""pf AS (SELECT i.source_id, b.field_name, MAX(CASE WHEN f.sel=1 THEN 1 ELSE 0 END) AS dr1,
      STRING_AGG(CAST(b.beam_num AS VARCHAR), ',' ORDER BY b.beam_num) AS beams,
      STRING_AGG(DISTINCT CAST(b.sbid AS VARCHAR), ',') AS sbids, COUNT(*) AS n_beams
      FROM fx_islands i, fx_beam_inf b, fx_fields f
      WHERE f.field_name=b.field_name AND {s_sep('b.ra','b.dec','i.ra','i.dec')} < 3.0
      GROUP BY i.source_id, b.field_name)"""


@check(
    "source_fields",
    f"""WITH {PER_FIELD} SELECT source_id, field_name, beams, sbids, dr1=1 AS dr1 FROM pf""",
)
def _(spark, d):
    return association.field_rows(_per_field(spark, d)).select(
        "source_id",
        "field_name",
        F.array_join(F.col("beam_list").cast("array<string>"), ",").alias("beams"),
        F.array_join(F.col("sbids").cast("array<string>"), ",").alias("sbids"),
        "dr1",
    )


@check(
    "source_beams",
    f"""WITH {PER_FIELD} SELECT source_id, CAST(COUNT(*) AS BIGINT) AS n_fields, CAST(SUM(dr1) AS BIGINT) AS n_fields_dr1,
      STRING_AGG(CONCAT(field_name,':',beams), ';' ORDER BY field_name) AS beams FROM pf GROUP BY source_id""",
)
def _(spark, d):
    nested = association.source_beams(_per_field(spark, d))
    entries = F.transform(
        F.map_entries("beams"),
        lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"]["beam_list"].cast("array<string>"), ",")),
    )
    return nested.select("source_id", "n_fields", "n_fields_dr1", F.array_join(entries, ";").alias("beams"))


@check(
    "single_vs_multi_field",
    f"""WITH {PER_FIELD}, n AS (SELECT source_id, SUM(dr1) AS n_dr1,
      MAX(CASE WHEN dr1=1 AND field_name IN ('NATION_4','NATION_12','NATION_14','NATION_7') THEN 1 ELSE 0 END) AS w FROM pf GROUP BY source_id)
    SELECT source_id, CAST(n_dr1 AS BIGINT) AS n_fields_dr1, CASE WHEN n_dr1=1 THEN 'single' ELSE 'multiple' END AS kind
    FROM n WHERE w=1""",
)
def _(spark, d):
    return association.split_by_field_count(_per_field(spark, d), ["NATION_4", "NATION_12", "NATION_14", "NATION_7"])


@check(
    "in_field",
    f"""WITH {PER_FIELD}, n AS (SELECT source_id, COUNT(*) AS n_fields FROM pf GROUP BY source_id)
    SELECT n.source_id, CAST(n.n_fields AS BIGINT) AS n_fields FROM n JOIN pf ON n.source_id=pf.source_id WHERE pf.field_name='NATION_14'""",
)
def _(spark, d):
    return fields.in_field(association.source_beams(_per_field(spark, d)), "NATION_14").select("source_id", "n_fields")


@check(
    "with_sbid",
    f"""WITH {PER_FIELD} SELECT source_id FROM pf WHERE field_name='NATION_14' AND CONCAT(',',sbids,',') LIKE '%,8014,%'""",
)
def _(spark, d):
    return fields.with_sbid(association.source_beams(_per_field(spark, d)), "NATION_14", 8014).select("source_id")


@check("distinct_beams", f"""WITH {PER_FIELD.replace('pf AS', 'pg AS')} SELECT DISTINCT b.beam_num FROM fx_beam_inf b
    WHERE EXISTS (SELECT 1 FROM fx_islands i WHERE {s_sep('b.ra','b.dec','i.ra','i.dec')} < 3.0)""")
def _(spark, d):
    return release.distinct_beams(association.field_rows(_per_field(spark, d)))


@check(
    "explode_beams",
    f"""SELECT DISTINCT i.source_id, b.field_name, b.beam_num FROM fx_islands i, fx_beam_inf b
    WHERE {s_sep('b.ra','b.dec','i.ra','i.dec')} < 3.0""",
)
def _(spark, d):
    from stokesweave.functions.nested import explode_beams

    return explode_beams(association.source_beams(_per_field(spark, d))).select("source_id", "field_name", "beam_num")


@check(
    "components_of_islands",
    f"""WITH {PER_FIELD} SELECT c.cat_id, pf.field_name, i.n_rows FROM fx_components c JOIN pf ON c.source_id=pf.source_id
    JOIN fx_islands i ON c.source_id=i.source_id""",
)
def _(spark, d):
    out = fields.components_of_islands(
        view(spark, d, "fx_components").select("source_id", "cat_id"),
        _per_field(spark, d),
        view(spark, d, "fx_islands").select("source_id", "n_rows"),
    )
    # the rows of a source and its fields come last: each is joined with lists that are shuffled once
    return association.field_rows(out).select("cat_id", "field_name", "n_rows")


# --- scalar geometry ---------------------------------------------------------


@check(
    "sky_scalars",
    f"""SELECT c.cat_id, {s6(SEP_CF)} AS sep, {s6(s_pa('f.ra','f.dec','c.ra','c.dec'))} AS pa
    FROM fx_cat c JOIN fx_fields f ON c.field_name=f.field_name""",
)
def _(spark, d):
    f = view(spark, d, "fx_fields").select("field_name", F.col("ra").alias("fra"), F.col("dec").alias("fdec"))
    j = view(spark, d, "fx_cat").join(f, "field_name")
    return j.select(
        "cat_id",
        r6(sky.sep_deg("fra", "fdec", "ra", "dec"), "sep"),
        r6(sky.position_angle("fra", "fdec", "ra", "dec"), "pa"),
    )


_OFF = s_offset("ra", "dec", "CAST(cat_id%360 AS DOUBLE)", "fracpol")


@check("offset_by", f"SELECT cat_id, {s6(_OFF[0])} AS ra, {s6(_OFF[1])} AS dec FROM fx_components")
def _(spark, d):
    ra, dec = sky.offset_by("ra", "dec", (F.col("cat_id") % 360).cast("double"), "fracpol")
    return view(spark, d, "fx_components").select("cat_id", r6(ra, "ra"), r6(dec, "dec"))


@check(
    "tile_separation",
    f"""WITH j AS (SELECT c.cat_id, {SEP_CF} AS sep, {s_pa('f.ra','f.dec','c.ra','c.dec')} AS pa, f.pol_axis
      FROM fx_cat c JOIN fx_fields f ON c.field_name=f.field_name)
    SELECT cat_id, {s6('sep')} AS sep, {s6('sep*SIN(RADIANS(pa-(45+pol_axis)))')} AS l,
      {s6('sep*COS(RADIANS(pa-(45+pol_axis)))')} AS m FROM j""",
)
def _(spark, d):
    out = fields.tile_separation(view(spark, d, "fx_cat"), view(spark, d, "fx_fields"), tile="field_name")
    return out.select("cat_id", r6("separation_tile_centre", "sep"), r6("l_tile_centre", "l"), r6("m_tile_centre", "m"))


@check(
    "to_galactic",
    f"""WITH t AS (SELECT cat_id, RADIANS(dec) AS d, RADIANS(ra-192.85948) AS a, RADIANS(27.12825) AS p FROM fx_components)
    SELECT cat_id, {s6(s_wrap('122.93192-DEGREES(ATAN2(COS(d)*SIN(a), SIN(d)*COS(p)-COS(d)*SIN(p)*COS(a)))'))} AS l,
      {s6('DEGREES(ASIN(SIN(d)*SIN(p)+COS(d)*COS(p)*COS(a)))')} AS b FROM t""",
)
def _(spark, d):
    lon, lat = sky.to_galactic("ra", "dec")
    return view(spark, d, "fx_components").select("cat_id", r6(lon, "l"), r6(lat, "b"))


@check(
    "coord_strings",
    """WITH h AS (SELECT cat_id, ra*(24.0/360.0) AS h, dec FROM fx_components),
    t AS (SELECT cat_id, TRUNC(h) AS hh, (h-TRUNC(h))*60 AS hm, CAST(CAST(TRUNC(dec) AS BIGINT) AS DOUBLE) AS dd, (dec-TRUNC(dec))*60 AS dm FROM h)
    SELECT cat_id, PRINTF('%02.0f:%02.0f', hh, TRUNC(hm)) AS ra_hm, ROUND((hm-TRUNC(hm))*60,3) AS ra_s,
      PRINTF('%02.0f:%02.0f', dd, ABS(TRUNC(dm))) AS dec_dm, ROUND(ABS((dm-TRUNC(dm))*60),2) AS dec_s FROM t""",
)
def _(spark, d):
    ra, dec = sky.coord_strings("ra", "dec")
    cat = view(spark, d, "fx_components").select("cat_id", ra.alias("r"), dec.alias("d"))
    return cat.select(
        "cat_id",
        F.substring_index("r", ":", 2).alias("ra_hm"),
        F.substring_index("r", ":", -1).cast("double").alias("ra_s"),
        F.substring_index("d", ":", 2).alias("dec_dm"),
        F.substring_index("d", ":", -1).cast("double").alias("dec_s"),
    )


@check(
    "sin_project",
    f"""WITH m AS (SELECT AVG(ra) AS ra0, AVG(dec) AS dec0 FROM fx_components),
    t AS (SELECT cat_id, RADIANS(dec) AS d, RADIANS(ra-ra0) AS a, RADIANS(dec0) AS d0 FROM fx_components, m)
    SELECT cat_id, {s6('DEGREES(COS(d)*SIN(a))/(8.0/512)+255.0', 4)} AS x,
      {s6('DEGREES(COS(d0)*SIN(d)-SIN(d0)*COS(d)*COS(a))/(8.0/512)+255.0', 4)} AS y
    FROM t WHERE SIN(d0)*SIN(d)+COS(d0)*COS(d)*COS(a) >= 0""",
)
def _(spark, d):
    from stokesweave.operators.maps import map_centre

    cat = view(spark, d, "fx_components")
    x, y = sky.sin_project("ra", "dec", "ra0", "dec0")
    placed = keyed.with_scalars(cat.select("cat_id", "ra", "dec"), map_centre(cat)).select("cat_id", x.alias("x"), y.alias("y"))
    return placed.where("x is not null").select("cat_id", r6("x", digits=4), r6("y", digits=4))


@check(
    "ceil_floor_to",
    "SELECT cat_id, CEIL(total_i_flux*10)/10 AS up, FLOOR(fracpol*100)/100 AS down FROM fx_components",
)
def _(spark, d):
    return view(spark, d, "fx_components").select(
        "cat_id", numeric.ceil_to("total_i_flux", 1).alias("up"), numeric.floor_to("fracpol", 2).alias("down")
    )


# --- names and fields --------------------------------------------------------


@check(
    "field_names",
    """SELECT field_name, sbid, REPLACE(CONCAT('RACS_test4_1.05_', field_name), '_test4_1.05_', '_') AS clean,
      CONCAT('RACS_test4_1.05_', field_name) AS epoch1, CONCAT(field_name, '_', CAST(sbid AS VARCHAR)) AS run,
      REGEXP_REPLACE(CONCAT(field_name, 'A'), '[AB]$', '') AS stripped FROM fx_fields""",
)
def _(spark, d):
    raw = F.concat(F.lit("RACS_test4_1.05_"), "field_name")
    return view(spark, d, "fx_fields").select(
        "field_name",
        "sbid",
        text.normalise_field_name(raw, 0).alias("clean"),
        text.normalise_field_name(raw, 1).alias("epoch1"),
        text.save_name("field_name", "sbid").alias("run"),
        text.strip_tile_suffix(F.concat("field_name", F.lit("A"))).alias("stripped"),
    )


@check(
    "path_rewrites",
    """WITH p AS (SELECT p_partkey, CONCAT('/data/', p_brand, '/', p_brand, '.image.restored.q.', CAST(p_partkey AS VARCHAR), '.ion.fits') AS path
      FROM part)
    SELECT p_partkey, CONCAT(SPLIT_PART(path,'/',3), '/', SPLIT_PART(path,'/',4)) AS short,
      REPLACE(REPLACE(path,'.image.restored.','.weights.'),'.ion','') AS weight,
      REPLACE(path,'.fits','.ion.fits') AS corrected,
      CONCAT('S', CAST(p_partkey AS VARCHAR), '.cutout.', SPLIT_PART(path,'/',4)) AS cut FROM p""",
)
def _(spark, d):
    path = F.concat(
        F.lit("/data/"), "p_brand", F.lit("/"), "p_brand", F.lit(".image.restored.q."), F.col("p_partkey").cast("string"), F.lit(".ion.fits")
    )
    return (
        table(spark, d, "part")
        .withColumn("path", path)
        .select(
            "p_partkey",
            text.short_name("path").alias("short"),
            text.weight_path("path").alias("weight"),
            text.corrected_path("path").alias("corrected"),
            text.cutout_name(F.concat(F.lit("S"), F.col("p_partkey").cast("string")), "path").alias("cut"),
        )
    )


@check("valid_sbid", "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal >= 0")
def _(spark, d):
    from stokesweave.sources.tables import valid_sbid

    return valid_sbid(table(spark, d, "supplier"), "s_acctbal").select("s_suppkey", "s_acctbal")


@check(
    "select_best",
    """WITH w AS (SELECT o.* FROM fx_obs o JOIN fx_fields f ON o.field_name=f.field_name WHERE f.sel=1)
    SELECT field_name, sbid, sel FROM w WHERE sel=(SELECT MAX(sel) FROM w)""",
)
def _(spark, d):
    wanted = view(spark, d, "fx_fields").where("sel = 1").select("field_name")
    return fields.select_best(view(spark, d, "fx_obs"), wanted).select("field_name", "sbid", "sel")


@check(
    "latest_per_key",
    """SELECT field_name, sbid, scan_tint FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY field_name ORDER BY sbid DESC) AS rn FROM fx_obs)
    WHERE rn=1""",
)
def _(spark, d):
    return keyed.latest_per_key(view(spark, d, "fx_obs"), ["field_name"], ["sbid"]).select("field_name", "sbid", "scan_tint")


@check(
    "first_per_key",
    """SELECT field_name, sbid, acctbal FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY field_name ORDER BY acctbal, sbid) AS rn FROM fx_obs)
    WHERE rn=1""",
)
def _(spark, d):
    return keyed.first_per_key(view(spark, d, "fx_obs"), ["field_name"], ["acctbal", "sbid"]).select("field_name", "sbid", "acctbal")


@check(
    "int_time_lookup",
    """WITH o AS (SELECT * FROM fx_obs WHERE sel=1),
    l AS (SELECT field_name, scan_tint, ROW_NUMBER() OVER (PARTITION BY field_name ORDER BY sbid DESC) AS rn FROM o)
    SELECT c.cat_id, l.scan_tint AS int_time FROM fx_cat c LEFT JOIN l ON l.field_name=c.field_name AND l.rn=1""",
)
def _(spark, d):
    cat = view(spark, d, "fx_cat").select("cat_id", "tile_id")
    return fields.int_time_lookup(cat, view(spark, d, "fx_obs"), strict=False).select("cat_id", "int_time")


@check(
    "latest_calibration",
    """WITH b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY field_name ORDER BY cal_sbid DESC, sbid DESC) AS rn FROM fx_obs),
    n AS (SELECT field_name, cal_sbid, COUNT(*) AS n FROM fx_obs WHERE acctbal>0 GROUP BY field_name, cal_sbid),
    c AS (SELECT field_name, cal_sbid, COUNT(*) AS n FROM fx_obs GROUP BY field_name, cal_sbid)
    SELECT b.field_name, b.cal_sbid, b.sbid, COALESCE(n.n>0, FALSE) AS leakage_ready, COALESCE(c.n=1, FALSE) AS cubes_ready
    FROM b LEFT JOIN n ON b.field_name=n.field_name AND b.cal_sbid=n.cal_sbid
    LEFT JOIN c ON b.field_name=c.field_name AND b.cal_sbid=c.cal_sbid WHERE rn=1""",
)
def _(spark, d):
    obs = view(spark, d, "fx_obs")
    files = obs.select("field_name", "cal_sbid")
    out = fields.latest_calibration(obs, obs.where("acctbal > 0").select("field_name", "cal_sbid"), files, wanted_cubes=1)
    return out.select("field_name", "cal_sbid", "sbid", "leakage_ready", "cubes_ready")


@check(
    "field_keys",
    """WITH f AS (SELECT CONCAT('RACS_', n_name) AS fn, 8493+n_nationkey*81 AS cal,
      CASE WHEN n_nationkey=7 THEN 8674 WHEN n_nationkey=8 THEN 12431 ELSE 8000 END AS sb FROM nation)
    SELECT fn AS field_name, CAST(cal AS BIGINT) AS cal_sbid, CAST(sb AS BIGINT) AS sbid,
      CASE WHEN sb=8674 THEN 8669 WHEN sb=12431 THEN 11371 END AS weight_sbid FROM f""",
)
def _(spark, d):
    key = F.col("n_nationkey")
    f = table(spark, d, "nation").select(
        F.concat(F.lit("RACS_"), "n_name").alias("FIELD_NAME"),
        (key * 81 + 8493).cast("long").alias("CAL_SBID"),
        F.when(key == 7, 8674).when(key == 8, 12431).otherwise(8000).cast("long").alias("SBID"),
    )
    return f.select(
        F.col("FIELD_NAME").alias("field_name"),
        F.col("CAL_SBID").alias("cal_sbid"),
        F.col("SBID").alias("sbid"),
        fields.weight_block("SBID").alias("weight_sbid"),
    )


@check("unique_tiles", "SELECT DISTINCT tile_id, f.sel = 1 AS known FROM fx_cat c JOIN fx_fields f ON c.field_name=f.field_name")
def _(spark, d):
    tiles = fields.unique_tiles(view(spark, d, "fx_cat"))
    known = view(spark, d, "fx_fields").where("sel = 1").select(F.concat("field_name", F.lit("A")).alias("tile_id"))
    return fields.member_flag(tiles, known, "tile_id", "known")


@check("fields_not_in", "SELECT DISTINCT field_name FROM fx_cat WHERE field_name NOT IN (SELECT field_name FROM fx_fields WHERE sel=1)")
def _(spark, d):
    return fields.fields_not_in(view(spark, d, "fx_cat"), view(spark, d, "fx_fields").where("sel = 1"), "field_name")


@check("in_ids", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def _(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return keyed.in_ids(table(spark, d, "customer"), big, "c_custkey").select("c_custkey")


@check("excluded_sources", "SELECT o_orderkey AS source_id FROM orders WHERE o_orderkey NOT IN (SELECT source_id FROM fx_islands)")
def _(spark, d):
    products = table(spark, d, "orders").select(F.col("o_orderkey").alias("source_id"))
    return release.excluded_sources(products, view(spark, d, "fx_islands"))


@check(
    "component_or_island",
    """SELECT c.cat_id, COALESCE(CASE WHEN c.tax > 0.04 THEN c.tax END, i.isl_tax) AS isl_tax, i.n_rows
    FROM fx_components c LEFT JOIN fx_islands i ON c.source_id=i.source_id""",
)
def _(spark, d):
    comps = view(spark, d, "fx_components").select("source_id", "cat_id", F.when(F.col("tax") > 0.04, F.col("tax")).alias("isl_tax"))
    out = fields.component_or_island(comps, view(spark, d, "fx_islands"), ["isl_tax", "n_rows"])
    return out.select("cat_id", "isl_tax", "n_rows")


@check(
    "stack_tables",
    """SELECT s_suppkey AS k, s_name AS name, s_acctbal AS bal, CAST(NULL AS VARCHAR) AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""",
)
def _(spark, d):
    s = table(spark, d, "supplier").selectExpr("s_suppkey k", "s_name name", "s_acctbal bal")
    c = table(spark, d, "customer").selectExpr("c_custkey k", "c_name name", "c_acctbal bal", "c_mktsegment segment")
    return keyed.stack_tables(s, c)


@check("limit_sources", "SELECT source_id, n_rows FROM fx_islands ORDER BY source_id LIMIT 250")
def _(spark, d):
    return keyed.limit_sources(view(spark, d, "fx_islands"), "source_id", 250).select("source_id", "n_rows")


@check(
    "first_per_source",
    """SELECT source_id, sbid, start_time, tile_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_id ORDER BY cat_id) AS rn FROM fx_cat)
    WHERE rn=1""",
)
def _(spark, d):
    return fields.first_per_source(view(spark, d, "fx_cat"), ["sbid", "start_time", "tile_id"])


@check(
    "pos_err",
    """SELECT cat_id, (SELECT MAX(GREATEST(ra_err, dec_err)) FROM fx_cat) AS pos_err, GREATEST(ra_err, dec_err) AS row_err FROM fx_cat""",
)
def _(spark, d):
    out = fields.pos_err(view(spark, d, "fx_cat"))
    return out.select("cat_id", "pos_err", F.greatest("ra_err", "dec_err").alias("row_err"))


@check(
    "channel_flag",
    "SELECT cat_id, nchan, nchan < FLOOR((SELECT MAX(nchan) FROM fx_cat)*0.5) AS channel_flag FROM fx_cat",
)
def _(spark, d):
    return fields.channel_flag(view(spark, d, "fx_cat"), "nchan").select("cat_id", "nchan", "channel_flag")


@check("table_counts", "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT l_orderkey) AS n_distinct FROM lineitem")
def _(spark, d):
    return release.counts(table(spark, d, "lineitem"), "l_orderkey")


def s_pixel(ra, dec):
    d, a, d0 = f"RADIANS({dec})", f"RADIANS(({ra})-ra0)", "RADIANS(dec0)"
    return f"DEGREES(COS({d})*SIN({a}))/(-0.02)+4.5-1.0", f"DEGREES(COS({d0})*SIN({d})-SIN({d0})*COS({d})*COS({a}))/0.02+4.5-1.0"


# an image of 8 x 8 pixels about the island of its number
_IMAGES = """SELECT v.beam, i.source_id, i.ra AS ra0, i.dec AS dec0, CAST(4.5 AS DOUBLE) AS crpix_x, CAST(4.5 AS DOUBLE) AS crpix_y, CAST(-0.02 AS DOUBLE) AS cdelt_x,
    CAST(0.02 AS DOUBLE) AS cdelt_y, 8 AS nx, 8 AS ny, CAST(0.002 AS DOUBLE) AS beam_maj FROM (SELECT DISTINCT vec_id AS beam FROM embeddings) v JOIN fx_islands i ON v.beam=i.source_id"""
_OUT = "0.002*3.0*SQRT(2.0)"
_CORNERS = [s_offset("ra_right", "dec_high", "-45.0", _OUT), s_offset("ra_left", "dec_low", "135.0", _OUT), s_offset("ra_left", "dec_high", "45.0", _OUT), s_offset("ra_right", "dec_low", "-135.0", _OUT)]
_XS, _YS = zip(*[s_pixel(*c) for c in _CORNERS])


@check(
    "sky_cutout",
    f"""WITH e AS (SELECT source_id, dec, f0, ra - 360.0*ROUND((ra-f0)/360.0) AS ra2, maj FROM (
      SELECT source_id, ra, dec, snr_polint AS maj, FIRST_VALUE(ra) OVER (PARTITION BY source_id ORDER BY ra, dec) AS f0 FROM fx_components)),
    p AS (SELECT source_id, MIN(dec) AS lo, MAX(dec) AS hi, MAX(ra2) AS l, MIN(ra2) AS r, MAX(maj)/3600.0*SQRT(2.0) AS pad FROM e GROUP BY source_id),
    b AS (SELECT source_id, LEAST({_BL[1]},{_BR[1]}) AS dec_low, GREATEST({_TL[1]},{_TR[1]}) AS dec_high, {_TL[0]} AS ra_left, {_TR[0]} AS ra_right FROM p),
    m AS ({_IMAGES}), c AS (SELECT b.*, m.beam, m.ra0, m.dec0 FROM b JOIN m ON b.source_id=m.source_id),
    x AS (SELECT source_id, beam, GREATEST(FLOOR(LEAST({','.join(_XS)})),0) AS x_lo, LEAST(CEIL(GREATEST({','.join(_XS)})),8) AS x_hi,
      GREATEST(FLOOR(LEAST({','.join(_YS)})),0) AS y_lo, LEAST(CEIL(GREATEST({','.join(_YS)})),8) AS y_hi FROM c)
    SELECT x.source_id, x.beam, q.stokes, q.y, q.x, q.value FROM x JOIN fx_pixels q ON q.beam=x.beam AND q.x>=x_lo AND q.x<x_hi AND q.y>=y_lo AND q.y<y_hi""",
)
def _(spark, d):
    boxes = association.source_box(view(spark, d, "fx_components"), maj_arcsec="snr_polint")
    images = spark.sql(_IMAGES.replace("fx_islands", "{i}").replace("embeddings", "{e}"), i=view(spark, d, "fx_islands"), e=table(spark, d, "embeddings"))
    placed = pixels.pixel_boxes(boxes, images, "source_id").select("source_id", "beam", "x_lo", "x_hi", "y_lo", "y_hi")
    image = view(spark, d, "fx_pixels").select("beam", "stokes", "y", "x", "value")
    return pixels.cutout(image, placed, keys=["beam"], tile=4).select("source_id", "beam", "stokes", "y", "x", "value")
