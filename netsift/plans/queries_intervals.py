"""Interval, volume and pair-score queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsift.operators import intervals, volume
from netsift.plans import bind
from netsift.plans.catalog import query
from netsift.plans.shape import chain, openers, placed, plain

GAPS = """
WITH g AS (SELECT id_orig_h, id_resp_h, id_resp_p, t,
             (t - lag(t) OVER (PARTITION BY id_orig_h, id_resp_h, id_resp_p ORDER BY t)) / 1e6 AS iv FROM conn),
s AS (SELECT id_orig_h, id_resp_h, id_resp_p, count(*) AS n, avg(iv) AS m, stddev_pop(iv) AS sd,
        median(iv) AS med, mad(iv) AS md, min(t) AS t0, max(t) AS t1 FROM g GROUP BY ALL)
"""


@query("beacons", GAPS + """
SELECT id_orig_h AS src_ip, id_resp_h AS dst_ip, id_resp_p AS dst_port, n AS connection_count,
  round(m, 3) AS interval_mean, round(sd, 3) AS interval_std, round(med, 3) AS interval_median,
  round(md, 3) AS interval_mad, round(sd / m, 4) AS cv, round(md / med, 4) AS jitter_score,
  round(least(100, greatest(0, 1 - sd / m) * 100 + least(10, (n - 10) * 0.5)), 1) AS confidence,
  t0 AS first_us, t1 AS last_us
FROM s WHERE n >= 10 AND round(m, 3) BETWEEN 5 AND 1000000 AND round(sd / m, 4) <= 0.8
""", ["conn"])
def beacons(spark, sf):
    found = intervals.beacons(bind.conn(spark, sf), cv_threshold=0.8, max_interval=1e6)
    return (found.withColumn("first_us", F.unix_micros("first_seen")).withColumn("last_us", F.unix_micros("last_seen"))
            .drop("first_seen", "last_seen"))


PAIR_GAPS = """
WITH g AS (SELECT id_orig_h, id_resp_h, t, orig_bytes, duration,
             (t - lag(t) OVER (PARTITION BY id_orig_h, id_resp_h ORDER BY t)) / 1e6 AS iv FROM conn),
s AS (SELECT id_orig_h, id_resp_h, count(*) AS n, count(iv) AS m, round(avg(iv), 4) AS mean,
        round(stddev_pop(iv), 4) AS sd, round(stddev_pop(iv) / avg(iv), 4) AS cv, round(min(iv)::DECIMAL(24,6), 4)::DOUBLE AS lo,
        round(max(iv)::DECIMAL(24,6), 4)::DOUBLE AS hi, round(var_pop(iv), 4) AS var, round((max(iv) - min(iv))::DECIMAL(24,6), 4)::DOUBLE AS jitter,
        round(avg(orig_bytes), 2) AS bm, round(coalesce(stddev_samp(orig_bytes), 0), 2) AS bs,
        round(avg(duration)::DECIMAL(24,8), 4)::DOUBLE AS dm FROM g GROUP BY ALL)
"""
SCORE = "round(greatest(0, (0.8 - cv) / 0.8) * 50 + least(50, m), 2)"


@query("interval_summary", PAIR_GAPS + """
SELECT id_orig_h, id_resp_h, mean, sd AS std, cv, m AS count, lo AS min, hi AS max, round(var, 0) AS variance,
  jitter AS jitter_range FROM s WHERE n >= 2""", ["conn"])
def interval_summary(spark, sf):
    s = intervals.interval_summary(bind.conn(spark, sf))
    return s.withColumn("variance", F.round("variance", 0))


@query("interval_analyzer", PAIR_GAPS + f"""
SELECT id_orig_h AS src, id_resp_h AS dst, mean AS interval_mean_s, sd AS interval_std_s, cv, n AS connection_count,
  {SCORE} AS confidence_score, CASE WHEN {SCORE} > 70 THEN 'BEACON_HIGH' ELSE 'BEACON_MEDIUM' END AS verdict
FROM s WHERE n >= 10 AND cv < 0.8""", ["conn"])
def interval_analyzer(spark, sf):
    return intervals.analyze_intervals(bind.conn(spark, sf), cv_threshold=0.8)


@query("interval_predict", PAIR_GAPS + """
SELECT id_orig_h, id_resp_h, m >= 10 AND cv < 0.8 AS is_beacon FROM s WHERE n >= 2""", ["conn"])
def interval_predict(spark, sf):
    return intervals.predict_intervals(bind.conn(spark, sf), cv_threshold=0.8)


@query("pair_features", PAIR_GAPS + """
SELECT id_orig_h AS src, id_resp_h AS dst, mean AS interval_mean, sd AS interval_std, cv AS interval_cv,
  lo AS interval_min, hi AS interval_max, n AS connection_count, bm AS bytes_mean, bs AS bytes_std, dm AS duration_mean
FROM s WHERE n >= 5""", ["conn"])
def pair_features(spark, sf):
    return intervals.pair_features(bind.conn(spark, sf))


DAY = 86400
SENSOR_ROWS = """live AS (SELECT concat_ws('-', id_orig_h, id_resp_h, id_resp_p) AS key, uid, t, id_orig_h, id_resp_h, id_resp_p
  FROM conn WHERE id_resp_h IN ('203.0.113.10', '203.0.113.20', '198.51.100.7'))"""


@query("sensor_beacons", f"""
WITH {SENSOR_ROWS}, {chain("c1", "live", 20 * DAY * 10**6)}, {placed("w", "live", "c1")},
g AS (SELECT *, row_number() OVER o AS n, (t - lag(t) OVER o) / 1e6 AS raw FROM w
      WINDOW o AS (PARTITION BY key, s ORDER BY t, uid)),
k AS (SELECT * EXCLUDE (raw), CASE WHEN raw BETWEEN 5 AND 500000 THEN raw END AS iv FROM g),
st AS (SELECT *, count(iv) OVER o AS kept, avg(iv) OVER o AS m, stddev_pop(iv) OVER o AS sd FROM k
       WINDOW o AS (PARTITION BY key, s ORDER BY t, uid ROWS UNBOUNDED PRECEDING)),
hits AS (SELECT * FROM st WHERE n >= 6 AND kept >= 5 AND sd / m <= 0.7),
{chain("c2", "hits", DAY * 10**6)}, {openers("f", "hits", "c2")}
SELECT t AS ts_us, id_orig_h AS src, id_resp_h AS dst, id_resp_p AS dport, uid, round(m, 4) AS interval_mean,
  round(sd, 4) AS interval_std, round(sd / m, 4) AS interval_cv, n AS connection_count,
  round((0.7 - sd / m) / 0.7 * 50 + least(50, n / 2), 4) AS confidence_score,
  CASE WHEN (0.7 - sd / m) / 0.7 * 50 + least(50, n / 2) > 70 THEN 'BEACON_HIGH' ELSE 'BEACON_MEDIUM' END AS verdict,
  'beacon-' || key AS identifier FROM f""", ["conn"], recursive=True)
def sensor_beacons(spark, sf):
    found = intervals.sensor_beacons(bind.conn(spark, sf), cv_threshold=0.7, min_connections=6, max_gap=500000.0,
                                     window_seconds=20 * DAY, throttle_seconds=DAY, order=["uid"])
    return plain(found.drop("note"), 4)


# --- volume ------------------------------------------------------------------

HOURS = """
WITH v AS (SELECT id_orig_h AS src, id_resp_h AS dst, t - t % 3600000000 AS hour_us, sum(orig_bytes)::BIGINT AS b
  FROM conn WHERE NOT (id_resp_h LIKE '10.%' OR id_resp_h LIKE '172.16.%' OR id_resp_h LIKE '192.168.%') GROUP BY ALL)
"""


@query("volume_exfil", HOURS + """
SELECT 'VOLUME_EXFIL' AS type, 'HIGH' AS severity, src, dst, b AS bytes_out, round(b / 1048576.0, 2) AS mb_out, hour_us
FROM v WHERE b / 1048576.0 >= 100""", ["conn"])
def volume_exfil(spark, sf):
    return plain(volume.volume_exfil(bind.conn(spark, sf)).drop("detail"))


@query("volume_analyzer", HOURS + """
SELECT src, dst, hour_us AS window_us, b AS bytes_out, round(b / 1048576.0, 6) AS mb_out,
  round(least(100, b / 104857600.0 * 50), 2) AS score FROM v WHERE b >= 104857600""", ["conn"])
def volume_analyzer(spark, sf):
    return plain(volume.analyze_volume(bind.conn(spark, sf)))


@query("volume_baseline", """
SELECT id_orig_h AS src, round(avg(orig_bytes), 4) AS mean, round(stddev_samp(orig_bytes), 4) AS std,
  max(orig_bytes) AS max FROM conn GROUP BY 1""", ["conn"])
def volume_baseline(spark, sf):
    return plain(volume.volume_baseline(bind.conn(spark, sf)), 4)


@query("transfer_size_regularity", """
SELECT id_orig_h AS src, id_resp_h AS dst, count(*) AS n, round(avg(orig_bytes), 4) AS size_mean,
  round(stddev_pop(orig_bytes), 4) AS size_std, round(stddev_pop(orig_bytes) / avg(orig_bytes), 4) AS size_cv
FROM conn GROUP BY ALL HAVING count(*) >= 10 AND stddev_pop(orig_bytes) / avg(orig_bytes) <= 0.8""", ["conn"])
def transfer_size_regularity(spark, sf):
    return plain(volume.transfer_size_regularity(bind.conn(spark, sf), max_cv=0.8), 4)


@query("sensor_volume_exfil", f"""
WITH live AS (SELECT id_orig_h || '-' || id_resp_h AS key, uid, t, orig_bytes, id_orig_h, id_resp_h FROM conn
  WHERE id_resp_h IN ('203.0.113.10', '203.0.113.20', '198.51.100.7')),
{chain("c1", "live", 10 * DAY * 10**6)}, {placed("w", "live", "c1")},
tot AS (SELECT key AS pair, key || '-' || s AS key, uid, t AS tm, id_orig_h, id_resp_h,
          sum(orig_bytes) OVER (PARTITION BY key, s ORDER BY t, uid ROWS UNBOUNDED PRECEDING)::BIGINT AS t FROM w),
open0 AS (SELECT * FROM tot UNION ALL SELECT NULL, key, -1, NULL, NULL, NULL, 0 FROM (SELECT DISTINCT key FROM tot)),
{chain("c2", "open0", 200_000_000)}, {openers("x", "open0", "c2")},
crossed AS (SELECT pair AS key, uid, tm AS t, id_orig_h, id_resp_h, bytes_out FROM (SELECT *,
          t - lag(t) OVER (PARTITION BY key ORDER BY t, uid) AS bytes_out FROM x) WHERE uid >= 0),
{chain("c3", "crossed", 5 * DAY * 10**6 + 1)}, {openers("f", "crossed", "c3")}
SELECT t AS ts_us, id_orig_h AS src, id_resp_h AS dst, uid, bytes_out, 'exfil-vol-' || key AS identifier FROM f""",
       ["conn"], recursive=True)
def sensor_volume_exfil(spark, sf):
    found = volume.sensor_volume_exfil(bind.conn(spark, sf), threshold_bytes=200_000_000, window_seconds=10 * DAY,
                                       throttle_seconds=5 * DAY, order=["uid"])
    return plain(found.select("ts", "src", "dst", "uid", "bytes_out", "identifier"))
