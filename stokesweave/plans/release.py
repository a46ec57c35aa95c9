"""Release preparation: ordered catalogue, complete products, nested spectra."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stokesweave.operators.keyed import in_ids
from stokesweave.operators.pixels import require_complete
from stokesweave.operators.release import excluded_sources, matched_products, release_order, release_subset
from stokesweave.sources.spectra_files import nest_spectra


def prepare_release(
    cat: DataFrame,
    kind: str,
    pixels: DataFrame | None = None,
    spectra: DataFrame | None = None,
    fdf: DataFrame | None = None,
    rmsf: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Catalogue subset in release order with its cubes and nested spectra.

    Cubes must exist for every source and hold all Stokes; cubes of sources
    outside the catalogue are listed as ``excluded``.
    """
    subset = release_subset(cat, kind)
    out = {"catalogue": release_order(subset)}
    if pixels is not None:
        cubes = matched_products(pixels, subset)
        out["cubes"] = require_complete(cubes, ["source_id"])
        out["excluded"] = excluded_sources(pixels, subset)
    if spectra is not None:
        chosen = in_ids(spectra, subset.select("cat_id"), "cat_id")
        out["spectra"] = nest_spectra(chosen, subset, fdf, rmsf)
    return out
