"""Line dedup against a plain count of sites, with repeats, ties, clashing names, long and missing texts."""

import random
from collections import defaultdict

import pytest

from stokesweave.llm import line_dedup


def brute(rows, min_sites):
    sites = defaultdict(set)
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if line.strip(" "):
                sites[line.strip(" ")].add(source)
    out = []
    for key, text, _ in rows:
        parts = (text or "").split("\n") if text is not None else []
        marked = [bool(p.strip(" ")) and len(sites[p.strip(" ")]) >= min_sites for p in parts]
        left = [p for p, m in zip(parts, marked) if not m]
        cut = any(marked) and any(p.strip(" ") for p in left)
        out.append((key, "\n".join(left) if cut else text, len(parts), sum(marked) if cut else 0))
    return sorted(out, key=str)


def corpus(seed):
    """Lines on every number of sites from 1 to 40, so some lie at the threshold, some beside it."""
    rng = random.Random(seed)
    shared = [f"line {n}" + " more words" * (n % 4) for n in range(1, 41)]
    rows = []
    for at in range(400):
        source = None if at % 41 == 0 else f"site {at % 40}"
        own = [f"own {at} {i}" for i in range(rng.randint(0, 3))]
        common = [("  " if rng.random() < 0.2 else "") + s for n, s in enumerate(shared, 1) if at % 40 < n and rng.random() < 0.3]
        parts = own + common + [""] * rng.randint(0, 2)
        rng.shuffle(parts)
        rows.append((at, "\n".join(parts), source))
    rows += [rows[5], rows[5], (None, "line 40\nown of a null key", "site 1"), (500, None, "site 2"), (501, "", None), (502, "x" * 300_000 + "\nline 40 ", "site 3")]
    return rows


@pytest.mark.parametrize("min_sites", [2, 10, 25])
def test_equals_a_plain_count_of_sites(spark, min_sites):
    rows = corpus(min_sites)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    out = line_dedup.remove_boilerplate(df, min_sites).select("doc_id", "text", "n_lines", "n_removed")
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows, min_sites)


def test_names_that_clash_are_carried_and_counts_replaced(spark):
    names = ["key", "row", "whole", "parts", "marked", "left", "shorter", "cut", "site", "at", "line", "more", "n_lines", "a.b"]
    rows = [(k, f"shared\nown {k}", f"s{k}", *[f"{n} {k}" for n in names]) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    out = line_dedup.remove_boilerplate(df)
    assert out.columns == [*[c for c in df.columns if c != "n_lines"], "n_lines", "n_removed"]
    for r in out.collect():
        assert r["text"] == f"own {r['doc_id']}" and (r["n_lines"], r["n_removed"]) == (2, 1)
        assert all(r[n] == f"{n} {r['doc_id']}" for n in names if n != "n_lines")


def test_only_lines_near_the_threshold_are_counted_exactly(spark):
    rows = [("far\nnear\nfew", f"site {s}") if s < 10 else ("far", f"site {s}") for s in range(300)]
    rows = [(t if i < 5 else t.replace("\nfew", ""), s) for i, (t, s) in enumerate(rows)]
    got = sorted(r["sites"] for r in line_dedup.boilerplate_lines(spark.createDataFrame(rows, "text string, source string")).collect())
    assert got[0] == 10 and len(got) == 2 and abs(got[1] - 300) < 30
