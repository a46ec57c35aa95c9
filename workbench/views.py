"""Survey-shaped tables derived from the test tables, in SQL both engines run.

``view(spark, folder, name)`` builds one on Spark; ``cte(sql)`` prefixes a DuckDB
statement with the derived tables it mentions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _spread(key: str) -> str:
    return f"CAST({key} AS DOUBLE)*137.50776405-360.0*FLOOR(CAST({key} AS DOUBLE)*137.50776405/360.0)"


SQL = {
    # one row per component; lineitem keys repeat, so the largest row wins per column
    "fx_components": f"""
        SELECT l_orderkey AS source_id, l_orderkey*10+l_linenumber AS cat_id,
          {_spread('l_orderkey')} + CAST(MIN(l_partkey)%50 AS DOUBLE)*0.001 AS ra,
          CAST(l_orderkey%120 AS DOUBLE)-60.0+CAST(MIN(l_suppkey)%50 AS DOUBLE)*0.001 AS dec,
          MAX(l_extendedprice) AS total_i_flux, MAX(l_quantity) AS snr_polint,
          MAX(l_discount) AS fracpol, CAST(0.02 AS DOUBLE) AS beam_maj,
          MAX(l_tax) AS tax, CAST(MIN(l_suppkey)%25 AS INT) AS tile_key,
          MIN(l_partkey) AS partkey, MIN(l_suppkey) AS suppkey,
          MAX(l_returnflag) AS rflag, MAX(l_linestatus) AS lstatus,
          CAST(MIN(l_linenumber) AS INT) AS linenumber
        FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber""",
    "fx_cat": """
        SELECT c.*, CONCAT(n.n_name, 'A') AS tile_id, n.n_name AS field_name,
          CAST(8000+c.tile_key AS BIGINT) AS sbid,
          c.snr_polint*CAST(0.01 AS DOUBLE) AS rm_err, c.total_i_flux/1000.0-50.0 AS rm,
          CAST(100+c.partkey%200 AS INT) AS nchan, c.tax < 0.02 AS si_flag,
          CAST(58600.0 AS DOUBLE)+CAST(c.suppkey%100 AS DOUBLE)/10.0 AS start_time,
          CAST(c.partkey%97 AS DOUBLE)/10.0 AS ra_err, CAST(c.suppkey%89 AS DOUBLE)/10.0 AS dec_err,
          CAST(c.partkey%91 AS DOUBLE)/20.0 AS beamdist
        FROM {fx_components} c JOIN {nation} n ON c.tile_key=n.n_nationkey""",
    "fx_islands": f"""
        SELECT l_orderkey AS source_id, {_spread('l_orderkey')} AS ra,
          CAST(l_orderkey%120 AS DOUBLE)-60.0 AS dec, COUNT(*) AS n_rows,
          MAX(l_tax) AS isl_tax, CONCAT('tile', CAST(MIN(l_suppkey)%25 AS VARCHAR(20))) AS tile_id
        FROM {{lineitem}} GROUP BY l_orderkey""",
    "fx_beam_inf": f"""
        SELECT n.n_name AS field_name, CAST(8000+s.s_nationkey AS BIGINT) AS sbid,
          CAST(s.s_suppkey%36 AS INT) AS beam_num, s.s_suppkey AS beam_id,
          {_spread('s.s_suppkey')} AS ra, CAST(s.s_suppkey%120 AS DOUBLE)-60.0 AS dec
        FROM {{supplier}} s JOIN {{nation}} n ON s.s_nationkey=n.n_nationkey""",
    "fx_fields": """
        SELECT n_name AS field_name, CAST(8000+n_nationkey AS BIGINT) AS sbid, n_regionkey AS epoch,
          CASE WHEN n_nationkey%2=0 THEN 1 ELSE 0 END AS sel, CAST(900+n_nationkey AS DOUBLE) AS scan_tint,
          CAST(n_nationkey AS DOUBLE)*14.4 AS ra, CAST(n_nationkey AS DOUBLE)*4.0-50.0 AS dec,
          CAST(n_nationkey AS DOUBLE) AS pol_axis FROM {nation}""",
    # several observations per field
    "fx_obs": """
        SELECT n.n_name AS field_name, CAST(8000+s.s_suppkey AS BIGINT) AS sbid,
          CAST(7000+s.s_suppkey%40 AS BIGINT) AS cal_sbid, CAST(s.s_suppkey%2 AS INT) AS sel,
          CAST(900+s.s_suppkey%60 AS DOUBLE) AS scan_tint, s.s_acctbal AS acctbal
        FROM {supplier} s JOIN {nation} n ON s.s_nationkey=n.n_nationkey""",
    "fx_spectra": """
        SELECT q.vec_id AS cat_id, q.label AS source_id, q.i AS chan,
          CAST(800000000+CAST(q.i AS BIGINT)*9000000 AS DOUBLE) AS freq, q.v AS q, u.v AS u,
          CAST(3.0 AS DOUBLE)+q.v*0.5+u.v*0.25 AS i,
          POWER(CAST(299792458 AS DOUBLE)/CAST(800000000+CAST(q.i AS BIGINT)*9000000 AS DOUBLE),2) AS lambda_sq,
          CAST(10+(q.vec_id+q.i)%7 AS DOUBLE)/1000 AS dqu, CAST(10+(q.vec_id+q.i)%7 AS DOUBLE)/1000 AS dq,
          CAST(10+(q.vec_id+3*q.i)%9 AS DOUBLE)/1000 AS du, CAST(10+(q.vec_id+2*q.i)%5 AS DOUBLE)/1000 AS di,
          CAST((q.vec_id+q.i)%11 AS DOUBLE)/1000 AS bi, CAST((q.vec_id+q.i)%13 AS DOUBLE)/1000 AS bq,
          CAST((q.vec_id+q.i)%17 AS DOUBLE)/1000 AS bu
        FROM {fx_exploded} q JOIN {fx_exploded} u ON q.vec_id=u.vec_id AND u.i=q.i+32 WHERE q.i<32""",
    "fx_pixels": """
        SELECT label AS source_id, vec_id AS beam, CAST(FLOOR(i/8) AS INT) AS y, CAST(i%8 AS INT) AS x, v AS value,
          CAST(1+vec_id%5 AS DOUBLE) AS weight,
          CASE WHEN vec_id%3=0 THEN 'i' WHEN vec_id%3=1 THEN 'q' ELSE 'u' END AS stokes,
          CAST(FLOOR(vec_id/3)%8 AS INT) AS chan
        FROM {fx_exploded}""",
    "fx_iono": """
        SELECT user_id%10 AS source_id, event_id, ts, value/100.0 AS rm FROM {events}""",
}

EXPLODED_SPARK = """
    SELECT vec_id, label, i, CAST(v AS DOUBLE) AS v
    FROM (SELECT vec_id, label, posexplode(embedding) AS (i, v) FROM {embeddings})"""
EXPLODED_DUCK = """
    SELECT vec_id, label, CAST(i AS INT) AS i, CAST(v AS DOUBLE) AS v
    FROM (SELECT vec_id, label, UNNEST(RANGE(64)) AS i, UNNEST(embedding) AS v FROM embeddings)"""


def _needs(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if name in BASE:
        return table(spark, folder, name)
    text = EXPLODED_SPARK if name == "fx_exploded" else SQL[name]
    return spark.sql(text, **{n: view(spark, folder, n) for n in _needs(text)})


def _duck(name: str) -> str:
    text = EXPLODED_DUCK if name == "fx_exploded" else SQL[name]
    return re.sub(r"\{(\w+)\}", r"\1", text)


def cte(statement: str) -> str:
    """``statement`` with the derived tables it mentions as leading CTEs."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order or name in BASE:
            return
        for n in re.findall(r"\bfx_\w+", _duck(name)):
            if n != name:
                add(n)
        order.append(name)

    for name in dict.fromkeys(re.findall(r"\bfx_\w+", statement)):
        add(name)
    if not order:
        return statement
    body = statement.strip()
    head = ", ".join(f"{n} AS ({_duck(n)})" for n in order)
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {head}, {body[5:]}"
    return f"WITH {head} {body}"
