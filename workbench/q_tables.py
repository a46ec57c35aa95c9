"""Nested columns, sources, sinks, schema and composite job queries.

Files are written by Spark from the test tables into the shared folder and read
back through the operator under test.
"""

from pyspark.sql import functions as F

from stokesweave.functions import nested
from stokesweave.operators import association, fields
from stokesweave.operators.complexity import INPUTS
from stokesweave.plans import catalogue as catalogue_plan
from stokesweave.plans import ingest, merge, release, repair, validate
from stokesweave.session import scratch_path
from stokesweave.sources import schema, spectra_files, tables
from workbench.registry import check, r6, s6, s_sep
from workbench.views import table, view

# --- nested columns --------------------------------------------------------------


def _runs(spark, d):
    """Per source, one result per return flag: field, stage flag and a summary."""
    li = table(spark, d, "lineitem")
    per_run = li.groupBy("l_orderkey", "l_returnflag").agg(
        F.max("l_quantity").alias("q"), F.max(F.when(F.col("l_tax") > 0.02, F.col("l_tax"))).alias("summary")
    )
    item = F.struct(F.col("l_returnflag").alias("field"), (F.col("q") > 25).alias("done"), "q", "summary")
    return per_run.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(item)).alias("runs"))


RUNS = """r AS (SELECT l_orderkey, l_returnflag AS field, MAX(l_quantity) AS q, MAX(l_quantity) > 25 AS done,
    MAX(CASE WHEN l_tax > 0.02 THEN l_tax END) AS summary FROM lineitem GROUP BY l_orderkey, l_returnflag)"""


@check(
    "element_where",
    f"""WITH {RUNS}, k AS (SELECT DISTINCT l_orderkey FROM lineitem) SELECT k.l_orderkey, r.q FROM k
    LEFT JOIN r ON k.l_orderkey=r.l_orderkey AND field='R' AND done AND summary IS NOT NULL""",
)
def _(spark, d):
    hit = nested.element_where("runs", {"field": "R", "done": True}, ["summary"])
    return _runs(spark, d).select("l_orderkey", hit["q"].alias("q"))


@check(
    "exists_where",
    f"WITH {RUNS} SELECT l_orderkey FROM r WHERE field='A' AND done AND summary IS NOT NULL",
)
def _(spark, d):
    return _runs(spark, d).where(nested.exists_where("runs", {"field": "A", "done": True}, ["summary"])).select("l_orderkey")


def _flat(df):
    x = df.select("l_orderkey", F.inline("runs"))
    return x.select("l_orderkey", "field", "done", "q")


@check("set_element", f"WITH {RUNS} SELECT l_orderkey, field, CASE WHEN field='R' THEN FALSE ELSE done END AS done, CASE WHEN field='R' THEN -1.0 ELSE q END AS q FROM r")
def _(spark, d):
    return _flat(_runs(spark, d).withColumn("runs", nested.set_element("runs", {"field": "R"}, {"done": False, "q": -1.0})))


PUSHED = f"""WITH {RUNS}, k AS (SELECT DISTINCT l_orderkey FROM lineitem)
    SELECT l_orderkey, field, done, q FROM r UNION ALL
    SELECT k.l_orderkey, 'N', FALSE, CAST(NULL AS DOUBLE) FROM k WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.l_orderkey=k.l_orderkey AND field='N')"""


@check("push_element", PUSHED)
def _(spark, d):
    runs = _runs(spark, d)
    item = F.struct(
        F.lit("N").alias("field"), F.lit(False).alias("done"), F.lit(None).cast("double").alias("q"), F.lit(None).cast("double").alias("summary")
    )
    return _flat(runs.withColumn("runs", nested.push_element("runs", item, {"field": "N"})))


@check(
    "reset_status",
    f"""WITH {RUNS}, k AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_suppkey < 20), a AS (SELECT l_orderkey, field, done, q FROM r
      UNION ALL SELECT k.l_orderkey, 'N', FALSE, NULL FROM k WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.l_orderkey=k.l_orderkey AND field='N'))
    SELECT a.l_orderkey, field, CASE WHEN field='N' AND k.l_orderkey IS NOT NULL THEN FALSE ELSE done END AS done, q
    FROM a LEFT JOIN k ON a.l_orderkey=k.l_orderkey""",
)
def _(spark, d):
    chosen = table(spark, d, "lineitem").where("l_suppkey < 20").select("l_orderkey")
    return _flat(nested.reset_status(_runs(spark, d), chosen, "l_orderkey", "runs", "N", "done"))


@check(
    "header_map",
    """SELECT s_suppkey, s_name AS obj, COUNT(*) OVER () > 0 AS has_beam FROM supplier""",
)
def _(spark, d):
    card = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    cards = F.array(card("", F.lit("x")), card("OBJECT", F.lit("old")), card("BMAJ", F.col("s_acctbal").cast("string")), card("OBJECT", F.col("s_name")))
    m = table(spark, d, "supplier").select("s_suppkey", nested.header_map(cards).alias("h"))
    return m.select("s_suppkey", F.col("h")["OBJECT"].alias("obj"), (F.map_contains_key("h", "BMAJ") & (F.size("h") == 2)).alias("has_beam"))


@check("json_roundtrip", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type FROM events")
def _(spark, d):
    e = table(spark, d, "events")
    packed = e.select("event_id", nested.json_encode(F.struct("event_type", nested.json_decode("props", "k bigint").alias("p"))).alias("j"))
    back = packed.select("event_id", nested.json_decode("j", "event_type string, p struct<k: bigint>").alias("v"))
    return back.select("event_id", F.col("v.p.k").alias("k"), F.col("v.event_type").alias("event_type"))


@check("complex_pair", f"SELECT cat_id, chan, {s6('q')} AS re, {s6('u')} AS im FROM fx_spectra")
def _(spark, d):
    from stokesweave.functions.spectral import complex_pair

    p = view(spark, d, "fx_spectra").select("cat_id", "chan", complex_pair("q", "u").alias("p"))
    return p.select("cat_id", "chan", r6("p.re", "re"), r6("p.im", "im"))


# --- sources and sinks --------------------------------------------------------------


def _field_data(spark, d):
    """Survey field table with the survey's own column names."""
    f, k = view(spark, d, "fx_fields"), F.col("sbid") - 8000
    return f.select(
        k.cast("int").alias("INDEX"),
        F.col("field_name").alias("FIELD_NAME"),
        F.when(k % 6 == 5, F.lit(-1)).otherwise(F.col("sbid")).cast("long").alias("SBID"),
        (F.col("sbid") - 500).alias("CAL_SBID"),
        F.col("sel").alias("SELECT"),
        F.col("ra").alias("RA_DEG"),
        F.col("dec").alias("DEC_DEG"),
        F.col("pol_axis").alias("POL_AXIS"),
        (F.lit(5.0e9) + k).alias("SCAN_START"),
        F.col("scan_tint").alias("SCAN_TINT"),
        F.lit("ok").alias("COMMENT"),
    )


def _place(spark, src, dst):
    """Give the single file of a written folder its final name."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(src).getFileSystem(conf)
    part = fs.globStatus(path(f"{src}/part-*"))[0].getPath()
    fs.mkdirs(path(dst).getParent())
    fs.rename(part, path(dst))


def _survey_folder(spark, d):
    root = scratch_path(spark, "survey")
    _field_data(spark, d).coalesce(1).write.option("header", True).csv(f"{root}/raw_fields")
    _place(spark, f"{root}/raw_fields", f"{root}/db/epoch_1/field_data.csv")
    return root


@check(
    "read_field_table",
    """SELECT field_name AS "FIELD_NAME", sbid AS "SBID", sel AS "SELECT", ra AS "RA_DEG", scan_tint AS "SCAN_TINT" FROM fx_fields
    WHERE (sbid-8000)%6<>5""",
)
def _(spark, d):
    out = tables.valid_sbid(tables.read_field_table(spark, _survey_folder(spark, d), 1))
    return out.select("FIELD_NAME", "SBID", "SELECT", "RA_DEG", "SCAN_TINT")


@check(
    "read_beam_pointings",
    """SELECT b.field_name AS "FIELD_NAME", b.sbid AS "SBID", b.beam_num AS "BEAM_NUM", b.ra AS "RA_DEG", b.dec AS "DEC_DEG" FROM fx_beam_inf b
    WHERE (b.sbid-8000)%6<>5""",
)
def _(spark, d):
    root = _survey_folder(spark, d)
    beams = view(spark, d, "fx_beam_inf")
    # one file per (SBID, field), named like the survey's
    rows = beams.select(
        F.concat(F.lit("beam_inf_"), F.col("sbid").cast("string"), F.lit("-"), "field_name", F.lit(".csv")).alias("f"),
        F.col("beam_num").alias("BEAM_NUM"),
        F.col("ra").alias("RA_DEG"),
        F.col("dec").alias("DEC_DEG"),
    )
    rows.repartition("f").write.partitionBy("f").option("header", True).csv(f"{root}/raw_beams")
    for r in rows.select("f").distinct().collect():
        _place(spark, f"{root}/raw_beams/f={r.f}", f"{root}/db/epoch_1/{r.f}")
    return tables.read_beam_pointings(spark, root, 1, tables.read_field_table(spark, root, 1))


@check("read_catalogue", "SELECT p_partkey, p_name, p_retailprice FROM part")
def _(spark, d):
    path = scratch_path(spark, "bytes")
    table(spark, d, "part").select("p_partkey", F.encode("p_name", "UTF-8").alias("p_name"), "p_retailprice").write.parquet(path)
    return tables.read_catalogue(spark, path)


@check("read_votable", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark, d):
    path = scratch_path(spark, "vot")
    c = table(spark, d, "customer")
    head = (
        '<VOTABLE version="1.3"><RESOURCE><TABLE><FIELD name="c_custkey" datatype="long"/><FIELD name="c_name" datatype="char" arraysize="*"/>'
        '<FIELD name="c_acctbal" datatype="double" unit="Jy"/><DATA><TABLEDATA>'
    )
    tr = F.concat(F.lit("<TR><TD>"), F.concat_ws("</TD><TD>", F.col("c_custkey").cast("string"), "c_name", F.col("c_acctbal").cast("string")), F.lit("</TD></TR>"))
    body = c.select(F.lit(1).alias("o"), tr.alias("value"))
    lines = spark.range(1).select(F.lit(0).alias("o"), F.lit(head).alias("value")).unionByName(body).unionByName(
        spark.range(1).select(F.lit(2).alias("o"), F.lit("</TABLEDATA></DATA></TABLE></RESOURCE></VOTABLE>").alias("value"))
    )
    lines.coalesce(1).sortWithinPartitions("o").select("value").write.text(path)
    return tables.read_votable(spark, path)


@check(
    "upsert",
    """WITH u AS (SELECT o_custkey AS c_custkey, MAX(o_totalprice) AS c_acctbal, MAX(o_orderstatus) AS status FROM orders WHERE o_totalprice > 100000 GROUP BY o_custkey
      UNION ALL SELECT 1000000+s_suppkey, s_acctbal, 'S' FROM supplier)
    SELECT COALESCE(c.c_custkey, u.c_custkey) AS c_custkey, c.c_name, CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE c.c_acctbal END AS c_acctbal,
      u.status FROM customer c FULL OUTER JOIN u ON c.c_custkey=u.c_custkey""",
)
def _(spark, d):
    o = table(spark, d, "orders").where("o_totalprice > 100000")
    a = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"), F.max("o_orderstatus").alias("status"))
    b = table(spark, d, "supplier").select((F.col("s_suppkey") + 1000000).alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"), F.lit("S").alias("status"))
    target = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return tables.upsert(target, a.unionByName(b), ["c_custkey"])


@check(
    "replace_table",
    "SELECT r_regionkey, r_name, (SELECT COUNT(*) FROM region) AS n FROM region",
)
def _(spark, d):
    path = scratch_path(spark, "replaced")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS scratch_{path[-12:]} LOCATION '{path}'")
    name = f"scratch_{path[-12:]}.region_copy"
    n = tables.replace_table(table(spark, d, "region"), name, cluster_by="r_regionkey")
    return spark.table(name).withColumn("n", F.lit(n).cast("long"))


@check("read_spectra_text", f"SELECT CAST(cat_id AS VARCHAR) AS cat_id, chan, {s6('q')} AS q, {s6('u')} AS u, {s6('du')} AS du FROM fx_spectra")
def _(spark, d):
    path = scratch_path(spark, "dat")
    s = view(spark, d, "fx_spectra")
    line = F.concat_ws("  ", *[F.col(c).cast("string") for c in spectra_files.SPECTRUM_COLUMNS])
    text = s.groupBy("cat_id").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("value"))
    text.withColumn("f", F.concat(F.lit("c"), F.col("cat_id").cast("string"))).select("value", "f").write.partitionBy("f").text(path)
    # the key of this check is the folder, one file per component
    rows = spectra_files.read_spectra_text(spark, path, glob="*.txt", marker=".txt", key_from="folder")
    return rows.select(F.substring("cat_id", 4, 20).alias("cat_id"), "chan", r6("q"), r6("u"), r6("du"))


@check("write_spectra", "SELECT cat_id, chan, q, CASE WHEN cat_id%2=0 THEN 'even' ELSE 'odd' END AS save_name FROM fx_spectra")
def _(spark, d):
    path = scratch_path(spark, "spectra")
    s = view(spark, d, "fx_spectra").select("cat_id", "chan", "q", F.when(F.col("cat_id") % 2 == 0, "even").otherwise("odd").alias("save_name"))
    spectra_files.write_spectra(s, path)
    return spark.read.parquet(path)


@check("weights_roundtrip", f"SELECT stokes, chan, {s6('SUM(weight)')} AS weight FROM fx_pixels GROUP BY stokes, chan")
def _(spark, d):
    path = scratch_path(spark, "weights")
    w = view(spark, d, "fx_pixels").groupBy("stokes", "chan").agg(F.sum("weight").alias("weight"))
    spectra_files.write_weights(w, path, ["stokes"])
    back = spark.read.option("sep", " ").option("comment", "#").schema("chan int, weight double, stokes string").csv(path)
    return back.select("stokes", "chan", r6("weight"))


@check("file_inventory", "SELECT COUNT(DISTINCT n_regionkey) AS n_files FROM nation")
def _(spark, d):
    path = scratch_path(spark, "products")
    n = table(spark, d, "nation").select("n_regionkey", F.col("n_name").alias("value"))
    n.repartition(1).write.partitionBy("n_regionkey").text(path)
    files = spectra_files.file_inventory(spark, path, "part-*.txt", "-")
    return spectra_files.inventory_summary(files.withColumn("product_id", F.lit(1))).select("n_files")


def _declared(spark, d):
    """The fixture catalogue under the declared input names."""
    cat = view(spark, d, "fx_cat")
    have = {
        "RA": "ra", "Dec": "dec", "E_RA": "ra_err", "E_Dec": "dec_err", "Total_flux_Gaussian": "total_i_flux", "Peak_flux": "total_i_flux",
        "Separation_Tile_Centre": "beamdist", "Gaussian_ID": "cat_id", "Source_ID": "source_id", "Tile_ID": "tile_id", "SBID": "sbid",
        "Obs_Start_Time": "start_time", "N_channels": "nchan", "snrPIfit": "snr_polint", "fracPol": "fracpol", "phiPeakPIfit_rm2": "rm",
        "dPhiPeakPIfit_rm2": "rm_err", "BMAJ": "beam_maj", "fit_flag_is_negative": "si_flag", "Ifreq0": "snr_polint",
    }
    exprs = {}
    for c in schema.COLUMNS:
        exprs[c.key] = F.col(have[c.key]) if c.key in have else F.lit(None)
    exprs["dIFullBand"] = F.lit(0.5)
    exprs["N_Gaus"] = F.lit(2)
    for k in ("fit_flag_is_close_to_zero", "fit_flag_is_not_finite", "fit_flag_is_not_normal"):
        exprs[k] = F.lit(False)
    exprs["sigmaAddQ"], exprs["sigmaAddU"] = F.col("fracpol") + 0.1, F.col("tax") + 0.1
    for k in ("dSigmaAddPlusQ", "dSigmaAddMinusQ", "dSigmaAddPlusU", "dSigmaAddMinusU"):
        exprs[k] = F.lit(0.05)
    exprs["mom2CCFDF"], exprs["fwhmRMSF"] = F.col("rm"), F.lit(20.0)
    exprs["polyCoeffs"] = F.lit("nan,nan,nan,-0.8,1.5")
    exprs["polyCoefferr"] = F.lit("nan,nan,nan,0.1,0.2")
    return cat, exprs


@check(
    "select_catalogue_columns",
    """SELECT CAST(cat_id AS VARCHAR) AS cat_id, CAST(source_id AS VARCHAR) AS source_id, CAST(sbid AS VARCHAR) AS sbid, ra, dec, total_i_flux*0.001 AS flux_jy,
    nchan AS "Nchan", si_flag AS negative FROM fx_cat""",
)
def _(spark, d):
    cat, exprs = _declared(spark, d)
    out = schema.to_jy(schema.select_catalogue_columns(cat, exprs))
    return out.select("cat_id", "source_id", "sbid", "ra", "dec", F.col("total_I_flux").alias("flux_jy"), "Nchan", F.col("stokesI_fit_flag_is_negative").alias("negative"))


@check("field_dictionary")
def _(spark, d):
    """Dictionary of the catalogue beside the number of known values per column."""
    cat, exprs = _declared(spark, d)
    out = schema.fill_blank_units(schema.to_jy(schema.select_catalogue_columns(cat, exprs)))
    known = out.agg(*[F.count(c).alias(c) for c in out.columns]).unpivot([], out.columns, "name", "n_known")
    return schema.field_dictionary(out).join(known, "name")


@check("constant_columns", """SELECT cat_id, 'ASKAP' AS telescope, 'Peak' AS flux_type, CAST(0 AS DOUBLE) AS aperture, '8001' AS sbid, 'NATION_1' AS tile_id FROM fx_cat""")
def _(spark, d):
    out = fields.constant_columns(view(spark, d, "fx_cat"), "demo", 8001, "NATION_1")
    return out.select("cat_id", "telescope", "flux_type", "aperture", "sbid", "tile_id")


@check(
    "nest_spectra",
    f"""SELECT cat_id, COUNT(*) AS n_chan, MIN(freq) AS first_freq, {s6('MAX(CASE WHEN chan=5 THEN q END)')} AS q5, {s6('MAX(CASE WHEN chan=31 THEN du END)')} AS du31,
    CAST(9000000 AS DOUBLE) AS channel_width FROM fx_spectra GROUP BY cat_id""",
)
def _(spark, d):
    s = view(spark, d, "fx_spectra").drop("source_id")
    cat = table(spark, d, "embeddings").select(F.col("vec_id").alias("cat_id"), "label")
    out = spectra_files.nest_spectra(s, cat)
    return out.select(
        "cat_id",
        F.size("freq").cast("long").alias("n_chan"),
        F.col("freq")[0].alias("first_freq"),
        r6(F.col("stokesQ")[5], "q5"),
        r6(F.col("stokesU_error")[31], "du31"),
        "channel_width",
    )


# --- composite jobs ------------------------------------------------------------------


@check(
    "associate_survey",
    f"""SELECT i.source_id, b.field_name, COUNT(*) AS n_beams, b.field_name IN (SELECT tile_id FROM fx_islands) AS dr1 FROM fx_islands i, fx_beam_inf b
    WHERE {s_sep('b.ra','b.dec','i.ra','i.dec')} < 2.0 GROUP BY i.source_id, b.field_name""",
)
def _(spark, d):
    out = ingest.associate(view(spark, d, "fx_islands"), view(spark, d, "fx_beam_inf"), epoch=1, radius_deg=2.0)
    return out.select("source_id", "field_name", F.size("beam_list").cast("long").alias("n_beams"), "dr1")


def _survey(spark, d):
    """Components with nested results, islands, (source, field) rows and fields."""
    cat, exprs = _declared(spark, d)
    synth = F.struct(*[exprs[c.key].cast(c.type).alias(c.key) for c in {c.key: c for c in schema.COLUMNS if c.source == "synth"}.values() if c.key != "mom2CCFDF"])
    clean = F.struct(exprs["mom2CCFDF"].cast("double").alias("mom2CCFDF"))
    header = F.struct(*[F.lit(0.02).alias(k) for k in ("BMAJ", "BMIN", "BPA")])
    run = F.struct(
        F.lit("ALL").alias("field"),
        F.lit(True).alias("rmsynth1d"),
        (F.col("tax") < 0.07).alias("rmclean1d"),
        synth.alias("rmsynth_summary"),
        clean.alias("rmclean_summary"),
        header.alias("header"),
    )
    cat_keys = {c.key: c for c in schema.COLUMNS if c.source == "cat" and c.key != "S_Code"}
    comps = cat.select(*[exprs[k].cast(c.type).alias(k) for k, c in cat_keys.items()], F.array(run).alias("rm_outputs_1d"))
    islands = view(spark, d, "fx_islands").select(F.col("source_id").cast("string").alias("Source_ID"), F.lit("S").alias("S_Code"))
    per_field = islands.select(F.col("Source_ID").alias("source_id"), F.lit("ALL").alias("field_name"), F.array(F.lit(8000).cast("long")).alias("sbids"))
    flds = view(spark, d, "fx_fields").withColumns({"sel": F.lit(1), "scan_tint": F.col("scan_tint")})
    # the tile carries a pointing letter that field names do not have
    centres = flds.withColumn("field_name", F.concat("field_name", F.lit("A")))
    return comps, islands, per_field, flds.unionByName(centres)


def _catalogue(spark, d):
    comps, islands, per_field, flds = _survey(spark, d)
    return catalogue_plan.make_catalogue(comps, islands, per_field, flds, "ALL", catalogue_name="demo")


_GAL = "RADIANS(c.dec) AS d, RADIANS(c.ra-192.85948) AS a, RADIANS(27.12825) AS p"


@check(
    "make_catalogue",
    f"""WITH k AS (SELECT c.*, {_GAL}, f.scan_tint FROM fx_cat c JOIN fx_fields f ON c.field_name=f.field_name WHERE c.tax < 0.07),
    n AS (SELECT x.cat_id, COUNT(*) AS n, SUM(y.total_i_flux) AS near FROM k x JOIN k y ON x.source_id=y.source_id
      WHERE {s_sep('x.ra','x.dec','y.ra','y.dec')} > 0 AND {s_sep('x.ra','x.dec','y.ra','y.dec')} < 0.02 GROUP BY x.cat_id)
    SELECT CAST(k.cat_id AS VARCHAR) AS cat_id, snr_polint < 8 AS snr_flag, nchan < FLOOR((SELECT MAX(nchan) FROM k)*0.5) AS channel_flag,
      rm > 20.0 AS complex_width, COALESCE(n.n,0) > 0 AS is_blended_flag, CAST(COALESCE(n.n,0) AS BIGINT) AS "N_blended",
      {s6('total_i_flux/(total_i_flux+COALESCE(n.near,0))')} AS blend_ratio, scan_tint AS int_time,
      {s6('start_time+scan_tint/(2.0*86400.0)')} AS epoch, {s6('DEGREES(ASIN(SIN(d)*SIN(p)+COS(d)*COS(p)*COS(a)))')} AS b,
      (SELECT MAX(GREATEST(ra_err, dec_err)) FROM k) AS pos_err, CAST(-0.8 AS DOUBLE) AS spectral_index
    FROM k LEFT JOIN n ON k.cat_id=n.cat_id""",
)
def _(spark, d):
    out = _catalogue(spark, d)
    return out.select(
        "cat_id", "snr_flag", "channel_flag", F.col("complex_M2_CC_flag").alias("complex_width"), "is_blended_flag", "N_blended", r6("blend_ratio"),
        "int_time", r6("epoch"), r6("b"), "pos_err", "spectral_index",
    )


@check("make_catalogue_flags")
def _(spark, d):
    out = _catalogue(spark, d)
    return out.select("cat_id", "leakage", "leakage_flag", "complex_sigma_add_flag", "local_rm_flag", "sigma_add", "sigma_add_err")


@check("catalogue_checks")
def _(spark, d):
    return catalogue_plan.catalogue_checks(_catalogue(spark, d))


@check(
    "merge_fields",
    """WITH w AS (SELECT DISTINCT source_id, beam%3 AS f FROM fx_pixels WHERE beam%3 < 2), n AS (SELECT source_id, COUNT(*) AS n FROM w GROUP BY source_id)
    SELECT p.source_id, p.stokes, p.chan, p.y, p.x, """
    + s6("SUM(weight*value)/SUM(weight)")
    + """ AS value, SUM(weight) AS weight FROM fx_pixels p JOIN n ON p.source_id=n.source_id WHERE p.beam%3 < 2 AND n.n > 1 GROUP BY p.source_id, p.stokes, p.chan, p.y, p.x""",
)
def _(spark, d):
    px = view(spark, d, "fx_pixels").withColumn("field_name", F.concat(F.lit("F"), (F.col("beam") % 3).cast("string")))
    per_field = px.groupBy("source_id", "field_name").agg(
        F.array_sort(F.collect_set(F.col("beam").cast("int"))).alias("beam_list"), F.array(F.lit(1).cast("long")).alias("sbids"), (F.first("field_name") != "F2").alias("dr1")
    )
    merged, _ = merge.merge_fields(px, per_field, ["F0", "F1"], "MERGED")
    return merged.select("source_id", "stokes", "chan", "y", "x", r6("value"), "weight")


@check(
    "validate_catalogue",
    f"""WITH p AS (SELECT c.cat_id, i.source_id AS ext_id, c.rm, i.isl_tax, {s_sep('c.ra','c.dec','i.ra','i.dec')} AS sep FROM fx_cat c
      JOIN fx_islands i ON i.dec >= c.dec-0.0501 AND i.dec <= c.dec+0.0501),
    k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cat_id ORDER BY sep, ext_id) AS rn FROM p WHERE sep < 0.05)
    SELECT cat_id, ext_id, rm, isl_tax AS ext_rm, {s6('sep')} AS sep FROM k WHERE rn=1""",
)
def _(spark, d):
    cat = view(spark, d, "fx_cat").select(
        "cat_id", "ra", "dec", "rm", "rm_err", F.col("snr_polint").alias("stokesI"), F.lit(0.5).alias("stokesI_err"), F.col("fracpol").alias("stokesQ"),
        F.col("tax").alias("stokesU"), F.col("fracpol").alias("stokesQ_err"), F.col("tax").alias("stokesU_err"),
        *[F.col("fracpol").alias(f"stokes{s}_bkg") for s in "IQU"],
        *[F.lit(False).alias(f) for f in ("snr_flag", "leakage_flag", "channel_flag", "stokesI_fit_flag", "local_rm_flag")],
    )
    other = view(spark, d, "fx_islands").select(F.col("source_id").alias("ext_id"), "ra", "dec", F.col("isl_tax").alias("rm"), F.lit(1.0).alias("rm_err"))
    out = validate.validate(cat, {"islands": other}, npix=512, map_size=100.0, radius_deg=0.05)
    return out["match_islands"].select("cat_id", "ext_id", "rm", "ext_rm", r6("sep"))


@check(
    "release_spectra",
    """WITH c AS (SELECT vec_id AS cat_id FROM embeddings WHERE label < 5) SELECT s.cat_id, COUNT(*) AS n_chan FROM fx_spectra s JOIN c ON s.cat_id=c.cat_id GROUP BY s.cat_id""",
)
def _(spark, d):
    cat = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("cat_id"), F.col("label").alias("source_id"), (F.col("label") >= 5).alias("stokesI_fit_flag"), F.col("vec_id").alias("snr_polint")
    )
    out = release.prepare_release(cat, "cut", spectra=view(spark, d, "fx_spectra").drop("source_id"))
    return out["spectra"].select("cat_id", F.size("freq").cast("long").alias("n_chan"))


@check(
    "repair_sources",
    f"""WITH f AS (SELECT source_id, sbid, start_time, field_name FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_id ORDER BY cat_id) AS rn FROM fx_cat) WHERE rn=1)
    SELECT i.source_id AS "Source_ID", f.sbid AS "SBID", f.start_time AS "Obs_Start_Time", f.field_name AS "Tile_ID",
      {s6("COALESCE(" + s_sep('i.ra','i.dec','w.ra','w.dec') + ", -1.0)")} AS "Separation_Tile_Centre", i.isl_tax AS "Maj_axis"
    FROM fx_islands i JOIN f ON i.source_id=f.source_id LEFT JOIN fx_fields w ON w.field_name=f.field_name AND w.sel=1""",
)
def _(spark, d):
    i = view(spark, d, "fx_islands")
    sources = i.select(
        F.col("source_id").alias("Source_ID"), F.col("ra").alias("RA"), F.col("dec").alias("Dec"), F.lit(0).cast("long").alias("SBID"),
        F.lit(0.0).alias("Obs_Start_Time"), F.lit("?").alias("Tile_ID"), F.lit(-1.0).alias("Separation_Tile_Centre"), F.col("isl_tax").alias("Maj"),
    )
    cat = view(spark, d, "fx_cat").withColumn("tile_id", F.col("field_name"))
    out = repair.repair_sources(sources, cat, view(spark, d, "fx_fields"))
    return out.select("Source_ID", "SBID", "Obs_Start_Time", "Tile_ID", r6("Separation_Tile_Centre"), "Maj_axis")


@check(
    "repair_fields",
    f"""WITH p AS (SELECT c.cat_id, f.field_name, f.sbid, {s_sep('f.ra','f.dec','c.ra','c.dec')} AS sep FROM fx_cat c, fx_fields f WHERE f.sel=1 AND f.epoch<3),
    k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cat_id ORDER BY sep, field_name) AS rn FROM p)
    SELECT c.cat_id, CASE WHEN w.field_name IS NULL THEN k.field_name ELSE c.field_name END AS tile_id,
      CASE WHEN w.field_name IS NULL THEN k.sbid ELSE c.sbid END AS sbid, {s6('CASE WHEN w.field_name IS NULL THEN k.sep ELSE c.beamdist END')} AS beamdist
    FROM fx_cat c JOIN k ON c.cat_id=k.cat_id AND k.rn=1 LEFT JOIN fx_fields w ON w.field_name=c.field_name AND w.sel=1 AND w.epoch<3""",
)
def _(spark, d):
    cat = view(spark, d, "fx_cat").withColumn("tile_id", F.col("field_name")).withColumns(
        {
            "separation_tile_centre": F.col("beamdist"), "stokesI": F.col("snr_polint"), "stokesI_err": F.lit(0.5), "stokesI_fit_flag": F.col("si_flag"),
            "channel_flag": F.lit(False), "snr_flag": F.col("snr_polint") < 8, "local_rm_flag": F.lit(False),
        }
    )
    flds = view(spark, d, "fx_fields").withColumn("scan_start", F.lit(5.0e9))
    wanted = [r.field_name for r in flds.where("sel = 1 and epoch < 3").collect()]
    out, _ = repair.repair_fields(cat, flds, wanted)
    return out.select("cat_id", "tile_id", "sbid", r6("beamdist"))


@check(
    "record_stage",
    """SELECT c_custkey, COALESCE(c_acctbal > 100, FALSE) AS done FROM customer""",
)
def _(spark, d):
    from stokesweave.plans.spectra import record_stage

    c = table(spark, d, "customer").select("c_custkey")
    results = table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey", (F.col("c_acctbal") > 100).alias("done"))
    return record_stage(results, c.withColumn("done", F.lit(None).cast("boolean")), "done", ["c_custkey"])


@check("nearest_field_of_islands", f"""WITH p AS (SELECT i.source_id, f.field_name, {s_sep('f.ra','f.dec','i.ra','i.dec')} AS sep FROM fx_islands i, fx_fields f),
    k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_id ORDER BY sep, field_name) AS rn FROM p) SELECT source_id, field_name FROM k WHERE rn=1""")
def _(spark, d):
    out = association.nearest_field(view(spark, d, "fx_islands"), view(spark, d, "fx_fields"), ["field_name"], "field_name")
    return out.select("source_id", F.col("near_field_name").alias("field_name"))


@check("drop_columns", "SELECT cat_id, rm FROM fx_cat")
def _(spark, d):
    cat = view(spark, d, "fx_cat")
    keep = ("cat_id", "rm", *INPUTS)
    return tables.drop_columns(cat, [c for c in cat.columns if c not in keep])


@check("write_catalogue", "SELECT cat_id, rm, 'demo' AS catalog_name FROM fx_cat")
def _(spark, d):
    path = scratch_path(spark, "catalogue")
    cat = fields.constant_columns(view(spark, d, "fx_cat").select("cat_id", "rm"), "demo")
    tables.write_catalogue(cat.select("cat_id", "rm", "catalog"), path)
    return spark.read.parquet(f"{path}/catalogue")


@check("rename_reserved", "SELECT source_id, isl_tax AS \"Maj_axis\", n_rows AS \"E_Min_axis\" FROM fx_islands")
def _(spark, d):
    return tables.rename_reserved(view(spark, d, "fx_islands").selectExpr("source_id", "isl_tax AS Maj", "n_rows AS E_Min"))


@check("decode_bytes", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, d):
    raw = table(spark, d, "customer").select("c_custkey", F.encode("c_name", "UTF-8").alias("c_name"), F.encode("c_mktsegment", "UTF-8").alias("c_mktsegment"))
    return tables.decode_bytes(raw)
