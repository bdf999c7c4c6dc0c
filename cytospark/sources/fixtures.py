"""Views of the driver's tables as event sets (FIXTURES.md §2).

Each view exists twice: as a Spark builder and as a SQL common-table expression that DuckDB runs
for the oracle.  Both compute the same columns from the same parquet tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

LINE_CHANNELS = ["qty", "price", "disc", "tax"]
VEC_CHANNELS = [f"c{i}" for i in range(1, 65)]

# Fixed values (FIXTURES.md §2): cutoffs for the line_events channels and the cell-subset definitions
# written over their labels.
LINE_CUTOFFS = {
    "qty": [12.5, 25.5, 38.5],
    "price": [20000.0, 40000.0, 60000.0],
    "disc": [0.025, 0.055, 0.085],
    "tax": [0.015, 0.035, 0.065],
}
LINE_DEFINITIONS = {
    "big": ["qty+/++"],
    "small": ["qty-/d"],
    "dear": ["price+/++"],
    "big dear": ["qty+/++", "price+/++"],
    "dear or taxed": ["price+/++ || tax+/++"],
    "nowhere": ["qty++", "qty-"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_id(*cols) -> F.Column:
    """60-bit id from md5 of the key columns; the SQL twin is ``EVENT_ID_SQL``."""
    key = F.concat_ws("|", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _line_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _event_id(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
                  F.round(F.col("l_extendedprice") * 100).cast("long")).alias("event_id"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("disc"),
        F.col("l_tax").alias("tax"),
        F.concat(F.floor((F.col("l_quantity") - 1) / 10).cast("string"),
                 F.when(F.col("l_extendedprice") >= 40000, F.lit("hi")).otherwise(F.lit("lo"))).alias("cluster"),
        (F.col("l_suppkey") % 8).cast("string").alias("cluster2"),
        "l_returnflag", "l_linestatus", "l_suppkey",
    )


def line_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (flag, status) sample: ``sample_id, id, group``.  Small by construction."""
    keys = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    return keys.select(
        F.dense_rank().over(W.orderBy("l_returnflag", "l_linestatus")).cast("int").alias("sample_id"),
        F.concat("l_returnflag", "l_linestatus").alias("id"),
        F.col("l_returnflag").alias("group"),
        "l_returnflag", "l_linestatus",
    )


def line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sample_id, event_id, qty, price, disc, tax, cluster, cluster2`` over all of lineitem.

    The sample key table has one row per distinct (flag, status) (small by construction) and is broadcast.  A shuffle
    join would bring every sample into one task, and all steps behind it would run on as few tasks as there are samples.
    """
    keys = F.broadcast(line_samples(spark, sf_dir).select("sample_id", "l_returnflag", "l_linestatus"))
    return (_line_base(spark, sf_dir).join(keys, ["l_returnflag", "l_linestatus"])
            .select("sample_id", "event_id", *LINE_CHANNELS, "cluster", "cluster2"))


def line_samples_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like line_events with one sample per supplier (10 / 100 / 1000 samples)."""
    return _line_base(spark, sf_dir).select(
        F.col("l_suppkey").cast("int").alias("sample_id"), "event_id", *LINE_CHANNELS, "cluster", "cluster2")


def supplier_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metadata row per supplier sample: ``sample_id, id, group`` (group = nation name)."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").cast("int").alias("sample_id"), F.col("s_name").alias("id"), F.col("n_name").alias("group"))


def supplier_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metadata row per supplier sample: ``sample_id, group`` (group = region name; nations leave single samples
    a group, and no degrees of freedom, on the smallest tables)."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("s_suppkey").cast("int").alias("sample_id"), F.col("r_name").alias("group"))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sample_id, event_id, time, value`` from ``events``; time = epoch seconds (unique)."""
    ev = table(spark, sf_dir, "events")
    keys = ev.select("event_type").distinct().select(
        "event_type", F.dense_rank().over(W.orderBy("event_type")).cast("int").alias("sample_id"))
    return ev.join(keys, "event_type").select(
        "sample_id", "event_id",
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("time"),
        F.col("value"))


def vec_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sample_id, event_id, c1…c64, cluster, group`` from ``embeddings``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        (F.col("vec_id") % 9).cast("int").alias("sample_id"),
        F.col("vec_id").alias("event_id"),
        *[F.col("embedding")[i].cast("double").alias(f"c{i + 1}") for i in range(64)],
        F.col("label").cast("string").alias("cluster"),
        F.when(F.col("vec_id") % 9 < 5, F.lit("g1")).otherwise(F.lit("g2")).alias("group"),
    )


def vec_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the nine vec_events samples, derived from the data (one row per sample)."""
    return vec_events(spark, sf_dir).select("sample_id", "group").distinct().select(
        "sample_id", F.format_string("s%d", "sample_id").alias("id"), "group")


def panel_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long panel ``sample_id, pos, name, desc`` from ``part``: one row per (sample, brand)."""
    p = table(spark, sf_dir, "part").select((F.col("p_size") % 5).cast("int").alias("sample_id"),
                                             F.col("p_brand").alias("name"), F.col("p_type").alias("ptype"))
    cnt = p.groupBy("sample_id", "name", "ptype").agg(F.count(F.lit(1)).alias("n"))
    best = cnt.withColumn("r", F.row_number().over(
        W.partitionBy("sample_id", "name").orderBy(F.desc("n"), F.asc("ptype")))).filter("r = 1")
    return best.select(
        "sample_id",
        F.row_number().over(W.partitionBy("sample_id").orderBy("name")).cast("int").alias("pos"),
        "name", F.col("ptype").alias("desc"))


def sample_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file`` paths of one FCS-like file per supplier."""
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("/data/"), "s_name", F.lit(".fcs")).alias("file"))


def covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata with gaps: per nation, mean balance (NULL for nation % 4 = 0) and modal segment."""
    c = table(spark, sf_dir, "customer")
    seg = c.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    mode = seg.withColumn("r", F.row_number().over(
        W.partitionBy("c_nationkey").orderBy(F.desc("n"), "c_mktsegment"))).filter("r = 1")
    bal = c.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("bal"))
    n = table(spark, sf_dir, "nation")
    return (n.join(bal, n.n_nationkey == bal.c_nationkey, "left")
            .join(mode.select(F.col("c_nationkey").alias("k2"), "c_mktsegment"), n.n_nationkey == F.col("k2"), "left")
            .select(F.col("n_name").alias("id"),
                    F.when(F.col("n_regionkey") < 2, F.lit("r01")).otherwise(F.lit("r24")).alias("group"),
                    F.when(F.col("n_nationkey") % 4 == 0, F.lit(None).cast("double")).otherwise(F.col("bal")).alias("balance"),
                    F.col("c_mktsegment").alias("segment")))


# ---------------------------------------------------------------- SQL twins (DuckDB)
EVENT_ID_SQL = ("CAST(('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
                "CAST(round(l_extendedprice * 100) AS BIGINT))), 1, 15)) AS BIGINT)")

_LINE_COLS_SQL = f"""{EVENT_ID_SQL} AS event_id,
    l_quantity AS qty, l_extendedprice AS price, l_discount AS disc, l_tax AS tax,
    CAST(CAST(floor((l_quantity - 1) / 10) AS BIGINT) AS VARCHAR)
      || CASE WHEN l_extendedprice >= 40000 THEN 'hi' ELSE 'lo' END AS cluster,
    CAST(l_suppkey % 8 AS VARCHAR) AS cluster2"""

SQL_VIEWS = {
    "line_events": f"""SELECT CAST(dense_rank() OVER (ORDER BY l_returnflag, l_linestatus) AS INTEGER) AS sample_id,
    {_LINE_COLS_SQL}
  FROM lineitem""",
    "line_samples_many": f"""SELECT CAST(l_suppkey AS INTEGER) AS sample_id, {_LINE_COLS_SQL} FROM lineitem""",
    "line_meta": """SELECT DISTINCT CAST(dense_rank() OVER (ORDER BY l_returnflag, l_linestatus) AS INTEGER) AS sample_id,
    l_returnflag || l_linestatus AS id, l_returnflag AS "group" FROM lineitem""",
    "supplier_meta": """SELECT CAST(s_suppkey AS INTEGER) AS sample_id, s_name AS id, n_name AS "group"
  FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "stream_events": """SELECT CAST(dense_rank() OVER (ORDER BY event_type) AS INTEGER) AS sample_id, event_id,
    epoch_us(ts) / 1e6 AS time, value FROM events""",
    "vec_events": "SELECT CAST(vec_id % 9 AS INTEGER) AS sample_id, vec_id AS event_id, "
                  + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS c{i + 1}" for i in range(64))
                  + ", CAST(label AS VARCHAR) AS cluster, CASE WHEN vec_id % 9 < 5 THEN 'g1' ELSE 'g2' END AS \"group\""
                  + " FROM embeddings",
    "vec_meta": """SELECT DISTINCT CAST(vec_id % 9 AS INTEGER) AS sample_id, 's' || CAST(vec_id % 9 AS VARCHAR) AS id,
    CASE WHEN vec_id % 9 < 5 THEN 'g1' ELSE 'g2' END AS "group" FROM embeddings""",
    "panel_fx": """SELECT sample_id, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY name) AS INTEGER) AS pos,
    name, ptype AS "desc" FROM (
      SELECT sample_id, name, ptype, row_number() OVER (PARTITION BY sample_id, name ORDER BY n DESC, ptype) AS r
      FROM (SELECT CAST(p_size % 5 AS INTEGER) AS sample_id, p_brand AS name, p_type AS ptype, count(*) AS n
            FROM part GROUP BY ALL)) WHERE r = 1""",
    "sample_files": "SELECT '/data/' || s_name || '.fcs' AS file FROM supplier",
    "covariates": """SELECT n_name AS id, CASE WHEN n_regionkey < 2 THEN 'r01' ELSE 'r24' END AS "group",
    CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE b.bal END AS balance, m.c_mktsegment AS segment
  FROM nation
  LEFT JOIN (SELECT c_nationkey, avg(c_acctbal) AS bal FROM customer GROUP BY 1) b ON n_nationkey = b.c_nationkey
  LEFT JOIN (SELECT c_nationkey, c_mktsegment FROM (
      SELECT c_nationkey, c_mktsegment, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) AS r
      FROM customer GROUP BY 1, 2) WHERE r = 1) m ON n_nationkey = m.c_nationkey""",
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs of the named views (in the given order)."""
    ctes = ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in names)
    return f"WITH {ctes}\n{sql}"
