"""Queries from spectra to the catalogue: Stokes I modes, added noise, results written back."""

from pyspark.sql import functions as F

from stokesweave.functions.spectral import taylor_alpha
from stokesweave.operators.complexity import added_noise, thin_residuals
from stokesweave.operators.faraday import faraday_spectra, peak_measurements
from stokesweave.plans import catalogue, runs
from stokesweave.plans import spectra as spectra_plan
from stokesweave.session import scratch_path
from stokesweave.sources import schema
from workbench.q_spectra import PHI
from workbench.q_tables import RUNS, _runs
from workbench.registry import check, r6, s6
from workbench.views import view

PARTS = 16

# Taylor terms of a component and, for the residuals, a Faraday-thin source
TERMS = "CAST(3+cat_id%5 AS DOUBLE) AS tt0, CAST(cat_id%7 AS DOUBLE)/-4.0 AS tt1, CAST(900000000 AS DOUBLE) AS ref_nu"
THIN = "CAST(1+cat_id%3 AS DOUBLE)/10.0 AS polint, CAST(cat_id%180 AS DOUBLE) AS derot_polangle, CAST(cat_id%50 AS DOUBLE)-25.0 AS rm"


def _per_component(spark, d, columns):
    return view(spark, d, "fx_spectra").select("cat_id").distinct().selectExpr("cat_id", *columns.split(", "))


@check(
    "taylor_model",
    f"""WITH t AS (SELECT *, {TERMS} FROM fx_spectra), m AS (SELECT *, tt0*POWER(freq/ref_nu, tt1/tt0) AS i_model FROM t)
    SELECT cat_id, chan, {s6('i_model')} AS i_model, {s6('q/i_model')} AS q_frac, {s6('u/i_model')} AS u_frac, {s6('-tt1/tt0')} AS alpha FROM m""",
)
def _(spark, d):
    taylor = _per_component(spark, d, TERMS)
    out = spectra_plan.with_taylor_model(view(spark, d, "fx_spectra"), taylor, ["cat_id"])
    out = out.join(taylor.select("cat_id", taylor_alpha("tt0", "tt1").alias("alpha")), "cat_id")
    return out.select("cat_id", "chan", r6("i_model"), r6(F.col("q") / F.col("i_model"), "q_frac"), r6(F.col("u") / F.col("i_model"), "u_frac"), r6("alpha"))


@check(
    "thin_residuals",
    f"""WITH t AS (SELECT *, {THIN} FROM fx_spectra), m AS (SELECT *, 2*(RADIANS(derot_polangle)+rm*lambda_sq) AS a FROM t)
    SELECT cat_id, COUNT(*) AS n_q, COUNT(*) AS n_u, {s6('SUM(POWER((q-polint*COS(a))/dq, 2))', 3)} AS chi_q, {s6('SUM(POWER((u-polint*SIN(a))/du, 2))', 3)} AS chi_u
    FROM m GROUP BY cat_id""",
)
def _(spark, d):
    out = thin_residuals(view(spark, d, "fx_spectra"), _per_component(spark, d, THIN))
    return out.select("cat_id", "n_q", "n_u", r6("chi_q", digits=3), r6("chi_u", digits=3))


@check("added_noise")
def _(spark, d):
    s = view(spark, d, "fx_spectra")
    return added_noise(s, peak_measurements(faraday_spectra(s, PHI)))


@check(
    "band_shape",
    f"""WITH n AS (SELECT *, LEAD(freq) OVER (PARTITION BY cat_id ORDER BY freq)-freq AS step FROM fx_spectra)
    SELECT cat_id, {s6('MEDIAN((dq+du)/2.0)')} AS dqu, MEDIAN(step) AS median_channel_width FROM n GROUP BY cat_id""",
)
def _(spark, d):
    return spectra_plan.band_shape(view(spark, d, "fx_spectra"), ["cat_id"]).select("cat_id", r6("dqu"), "median_channel_width")


@check(
    "stage_results",
    f"WITH {RUNS} SELECT l_orderkey, field, CASE WHEN field='A' THEN TRUE ELSE done END AS done, q, summary FROM r",
)
def _(spark, d):
    """Runs written one after the other into a stored table: new elements, a repeated write, an update of one member."""
    key = ["l_orderkey"]
    whole = _runs(spark, d)
    each = whole.select("l_orderkey", F.explode("runs").alias("run"))
    first = F.filter("runs", lambda x: x["field"] == "A")
    path = scratch_path(spark, "components")
    runs.store_components(whole.select("l_orderkey", F.when(F.size(first) > 0, first).alias("runs")), path, PARTS, key)
    for field in ("N", "R", "R"):
        runs.store_runs(spark, path, each.where(F.col("run.field") == field), PARTS, key, "runs")
    settled = each.where("run.field = 'A'").select("l_orderkey", F.struct(F.lit("A").alias("field"), F.lit(True).alias("done")).alias("run"))
    runs.store_runs(spark, path, settled, PARTS, key, "runs")
    return spark.read.parquet(path).select("l_orderkey", F.inline("runs"))


def _components(spark, d):
    """Components of the spectra with the source finder's keys, their islands, (source, field) rows and fields."""
    ids = view(spark, d, "fx_spectra").select("cat_id").distinct()
    k = F.col("cat_id")
    exprs = {
        "Gaussian_ID": k, "Source_ID": F.floor(k / 3), "RA": F.pmod(F.floor(k / 3) * 7.31 + k % 3 * 0.01, F.lit(360.0)), "Dec": k % 100 - 50.0,
        "Total_flux_Gaussian": 10.0 + k % 90, "Peak_flux": 9.0 + k % 90, "E_RA": F.lit(0.2), "E_Dec": F.lit(0.3), "N_Gaus": F.lit(2), "Tile_ID": F.lit("ONEA"),
        "Obs_Start_Time": F.lit(58600.0), "Separation_Tile_Centre": k % 40 / 10.0,
    }
    keys = {c.key: c for c in schema.COLUMNS if c.source == "cat" and c.key != "S_Code"}
    comps = ids.select(*[exprs.get(n, F.lit(None)).cast(c.type).alias(n) for n, c in keys.items()])
    islands = comps.select("Source_ID").distinct().withColumn("S_Code", F.lit("S"))
    per_field = islands.select(F.col("Source_ID").alias("source_id"), F.lit("ALL").alias("field_name"), F.array(F.lit(8000).cast("long")).alias("sbids"))
    one = view(spark, d, "fx_fields").where("sbid = 8002").withColumns({"field_name": F.lit("ONE"), "sel": F.lit(1)})
    # the tile carries a pointing letter that field names do not have
    return comps, islands, per_field, one.unionByName(one.withColumn("field_name", F.lit("ONEA")))


def spectra_to_catalogue(spark, d, stokes_i="fit"):
    """Spectra measured, their results stored in the components' lists, the catalogue made from the stored table."""
    s = view(spark, d, "fx_spectra").drop("source_id", "lambda_sq", "dqu")
    taylor = _per_component(spark, d, TERMS) if stokes_i == "taylor" else None
    measured = spectra_plan.spectral_measurements(s, PHI, stokes_i=stokes_i, taylor=taylor)
    headers = measured.select("cat_id", *[F.lit(0.02).alias(c) for c in ("BMAJ", "BMIN", "BPA")])
    elements = runs.run_elements(measured, "ALL", headers=headers).select(F.col("cat_id").cast("string").alias("Gaussian_ID"), "run")
    comps, islands, per_field, flds = _components(spark, d)
    path = scratch_path(spark, "components")
    blank = F.lit(None).cast(f"array<{elements.schema['run'].dataType.simpleString()}>")
    runs.store_components(comps.withColumn("rm_outputs_1d", blank), path, PARTS, ["Gaussian_ID"])
    runs.store_runs(spark, path, elements, PARTS, ["Gaussian_ID"])
    return catalogue.make_catalogue(spark.read.parquet(path).drop(runs.PART), islands, per_field, flds, "ALL", catalogue_name="demo")


CATALOGUED = (
    "cat_id rm rm_err polint fracpol stokesI stokesI_err rmsf_fwhm snr_polint Nchan channelwidth rm_width fdf_noise_mad noise_chan sigma_add spectral_index snr_flag"
    " complex_flag stokesI_fit_flag"
).split()


@check("spectra_to_catalogue")
def _(spark, d):
    return spectra_to_catalogue(spark, d).select(CATALOGUED)


@check("spectra_to_catalogue_taylor")
def _(spark, d):
    return spectra_to_catalogue(spark, d, "taylor").select(CATALOGUED)
