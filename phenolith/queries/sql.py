"""SQL text of the adapters and of shared steps, for checking queries with a second engine.

``CTES`` maps a name to its text; ``with_ctes`` prepends those that a statement needs.
"""

import re

from phenolith.adapters import CALENDAR_EPOCH, CALENDAR_LEAD, RANDOM_BATCH
from phenolith.functions.geo import ELLIPSOID_FLATTENING, ELLIPSOID_MAJOR_KM, ELLIPSOID_MINOR_KM

LAT = "CASE WHEN {k} % 97 = 0 THEN 0.0::DOUBLE ELSE 25.0::DOUBLE + (({k} * 37) % 120)::DOUBLE / 10.0::DOUBLE END"
LON = "(-110.0::DOUBLE + (({k} * 53) % 210)::DOUBLE / 10.0::DOUBLE)"
TOKENS = (
    "list_transform(range(17), lambda k: "
    "floor((latitude + 90.0::DOUBLE) * pow(2.0::DOUBLE, k) / 180.0::DOUBLE)::BIGINT::VARCHAR || '_' || "
    "floor((longitude + 180.0::DOUBLE) * pow(2.0::DOUBLE, k) / 360.0::DOUBLE)::BIGINT::VARCHAR)"
)
SEASON = "CASE WHEN month(obs_date) BETWEEN 3 AND 11 THEN month(obs_date) // 3 ELSE 4 END"
SEASON_KEY = f"year(obs_date)::VARCHAR || '-' || ({SEASON})::VARCHAR || '-' || s2_tokens[3]"
MONTH_KEY = "strftime(obs_date, '%Y-%m') || '-' || s2_tokens[3]"
EQUALITY_KEY = (
    "category || '|||' || printf('%.4f', latitude) || '|||' || printf('%.4f', longitude) || '|||' || "
    "strftime(obs_date, '%Y%m%d')"
)
ROUTING = "CASE WHEN category = 'random' THEN 'random-' || split_part(example_id, '-', 2) ELSE category END"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(2.0::DOUBLE * 6371.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, "
        f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * "
        f"pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))"
    )


CTES: dict[str, str] = {
    "parsed": f"""
  SELECT *, CASE WHEN length(date_string) = 8 THEN strptime(date_string, '%Y%m%d')::DATE END AS obs_date,
         {TOKENS} AS s2_tokens
  FROM (
    SELECT CASE WHEN o_orderstatus = 'P' THEN 'r-' || (o_orderkey // {RANDOM_BATCH} + 1)::VARCHAR || '-' || o_orderkey::VARCHAR
                ELSE 'o-' || o_orderkey::VARCHAR END AS example_id,
           CASE WHEN o_orderstatus = 'P' THEN 'random' ELSE 'u' || (o_orderkey % 5)::VARCHAR END AS category,
           {LAT.format(k='o_custkey')} AS latitude,
           {LON.format(k='o_custkey')} AS longitude,
           CASE WHEN o_orderkey % 211 = 0 THEN left(strftime(o_orderdate, '%Y%m%d'), 7)
                ELSE strftime(o_orderdate, '%Y%m%d') END AS date_string,
           CASE WHEN o_custkey % 89 <> 0 THEN (o_custkey * 13) % 3000 END AS elevation,
           (o_custkey % 8 + 1)::VARCHAR AS eco_realm, (o_custkey % 14 + 1)::VARCHAR AS eco_biome,
           (o_custkey % 30 + 1)::VARCHAR AS eco_num,
           (o_orderkey % 3)::VARCHAR AS source_type, o_custkey::VARCHAR AS target_id,
           o_orderkey * 1000 AS modified_at, o_custkey % 83 <> 0 AS has_feature_set
    FROM orders)""",
    "obs": """
  SELECT example_id, category, latitude, longitude, elevation, obs_date, eco_realm, eco_biome, eco_num, s2_tokens,
         obs_date - 3 AS end_day
  FROM parsed
  WHERE has_feature_set AND latitude <> 0 AND length(date_string) = 8 AND elevation IS NOT NULL""",
    "stations": """
  SELECT s_suppkey::VARCHAR AS usaf, (s_suppkey % 10)::VARCHAR AS wban,
         25.05::DOUBLE + ((place * 61) % 120)::DOUBLE / 10.0::DOUBLE AS lat,
         -109.95::DOUBLE + ((place * 97) % 210)::DOUBLE / 10.0::DOUBLE AS lon
  FROM (SELECT s_suppkey, s_suppkey - (s_suppkey % 10) // 9 AS place FROM supplier)""",
    "readings": f"""
  SELECT s::VARCHAR AS stn, (s % 10)::VARCHAR AS wban, strftime(day, '%Y') AS year, strftime(day, '%m') AS mo,
         strftime(day, '%d') AS da, (high + low) / 2.0::DOUBLE AS temp, low AS min, high AS max,
         ((s + n) % 7)::DOUBLE / 10.0::DOUBLE AS prcp, day
  FROM (SELECT s, day, n, ((s * 7 + n * 3) % 35 + 60)::DOUBLE AS high, ((s * 5 + n) % 35 + 20)::DOUBLE AS low
        FROM (SELECT s_suppkey AS s, (day - DATE '{CALENDAR_EPOCH}') + 7000 AS n, day FROM supplier,
                (SELECT first + unnest(range(0, last - first + 1))::INTEGER AS day
                 FROM (SELECT min(o_orderdate)::DATE - {CALENDAR_LEAD} AS first, max(o_orderdate)::DATE AS last FROM orders))) c
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 50
                          AND l_suppkey = c.s AND l_shipdate::DATE = c.day))""",
    "joined": """
  SELECT r.*, s.lat, s.lon, printf('%.6f', s.lat) || '|' || printf('%.6f', s.lon) AS station_key
  FROM readings r JOIN stations s ON r.stn = s.usaf AND r.wban = s.wban""",
    "plain_days": """
  SELECT station_key, day, split_part(station_key, '|', 1)::DOUBLE AS lat, split_part(station_key, '|', 2)::DOUBLE AS lon,
         temp AS avg_temp, max AS max_temp, min AS min_temp, prcp AS precipitation
  FROM (SELECT *, row_number() OVER (PARTITION BY station_key, day ORDER BY stn DESC, wban DESC) AS rn FROM joined)
  WHERE rn = 1""",
    "days": """
  SELECT station_key, day, lat, lon, avg_temp, max_temp, min_temp, precipitation,
         CASE WHEN abs(civil) > 1 THEN 86400
              WHEN abs(rise) <= 1 THEN
                ((trunc((720.0::DOUBLE + 4.0::DOUBLE * (-lon + degrees(acos(rise))) - eq) * 60.0::DOUBLE)
                 - trunc((720.0::DOUBLE + 4.0::DOUBLE * (-lon - degrees(acos(rise))) - eq) * 60.0::DOUBLE))::BIGINT + 86400) % 86400
         END AS daylight
  FROM (SELECT *, cos(radians(90.833::DOUBLE)) / (cos(phi) * cos(dec)) - tan(phi) * tan(dec) AS rise,
               cos(radians(96.0::DOUBLE)) / (cos(phi) * cos(dec)) - tan(phi) * tan(dec) AS civil
  FROM (SELECT *, asin(sin(eps) * sin(lam)) AS dec, radians(least(greatest(lat, -89.8::DOUBLE), 89.8::DOUBLE)) AS phi,
               4.0::DOUBLE * degrees(y * sin(2 * l2) - 2 * e * sin(m) + 4 * e * y * sin(m) * cos(2 * l2)
                 - 0.5::DOUBLE * y * y * sin(4 * l2) - 1.25::DOUBLE * e * e * sin(2 * m)) AS eq
  FROM (SELECT *, radians(l0 + ctr - 0.00569::DOUBLE - 0.00478::DOUBLE * sin(om)) AS lam, pow(tan(eps / 2), 2) AS y,
               radians(l0) AS l2
  FROM (SELECT *, sin(m) * (1.914602::DOUBLE - t * (0.004817::DOUBLE + 0.000014::DOUBLE * t))
               + sin(2 * m) * (0.019993::DOUBLE - 0.000101::DOUBLE * t) + sin(3 * m) * 0.000289::DOUBLE AS ctr,
               radians(23.0::DOUBLE + (26.0::DOUBLE + sec / 60.0::DOUBLE) / 60.0::DOUBLE + 0.00256::DOUBLE * cos(om)) AS eps
  FROM (SELECT *, (280.46646::DOUBLE + t * (36000.76983::DOUBLE + 0.0003032::DOUBLE * t))
                 - 360 * floor((280.46646::DOUBLE + t * (36000.76983::DOUBLE + 0.0003032::DOUBLE * t)) / 360) AS l0,
               radians(357.52911::DOUBLE + t * (35999.05029::DOUBLE - 0.0001537::DOUBLE * t)) AS m,
               0.016708634::DOUBLE - t * (0.000042037::DOUBLE + 0.0000001267::DOUBLE * t) AS e,
               radians(125.04::DOUBLE - 1934.136::DOUBLE * t) AS om,
               21.448::DOUBLE - t * (46.8150::DOUBLE + t * (0.00059::DOUBLE - t * 0.001813::DOUBLE)) AS sec
  FROM (SELECT *, ((day - DATE '1970-01-01')::DOUBLE + 2440587.5::DOUBLE - 2451545.0::DOUBLE) / 36525.0::DOUBLE AS t
        FROM plain_days))))))""",
    "complete": """
  SELECT station_key, day AS end_day
  FROM (SELECT station_key, day,
               count(*) OVER (PARTITION BY station_key ORDER BY day RANGE BETWEEN INTERVAL 119 DAYS PRECEDING AND CURRENT ROW) AS n
        FROM plain_days)
  WHERE n = 120""",
    "near": f"""
  SELECT latitude, longitude, station_key, {haversine('latitude', 'longitude', 'slat', 'slon')} AS km
  FROM (SELECT DISTINCT latitude, longitude FROM obs),
       (SELECT DISTINCT station_key, split_part(station_key, '|', 1)::DOUBLE AS slat,
               split_part(station_key, '|', 2)::DOUBLE AS slon
        FROM (SELECT printf('%.6f', lat) || '|' || printf('%.6f', lon) AS station_key FROM stations))
  WHERE {haversine('latitude', 'longitude', 'slat', 'slon')} <= 100""",
    "best": """
  SELECT example_id, station_key, km
  FROM (SELECT o.example_id, n.station_key, round(n.km, 6) AS km,
               row_number() OVER (PARTITION BY o.example_id ORDER BY round(n.km, 6), n.station_key) AS rn
        FROM obs o JOIN near n ON o.latitude = n.latitude AND o.longitude = n.longitude
        JOIN complete c ON c.station_key = n.station_key AND c.end_day = o.end_day)
  WHERE rn = 1""",
    "win": """
  SELECT o.example_id, o.category, b.station_key, b.km, (d.day - o.end_day + 119)::BIGINT AS pos,
         d.avg_temp, d.max_temp, d.min_temp, d.precipitation, d.daylight
  FROM best b JOIN obs o ON o.example_id = b.example_id
  JOIN days d ON d.station_key = b.station_key AND d.day BETWEEN o.end_day - 119 AND o.end_day""",
    "extents": f"""
  SELECT season_region_key, count(*) AS n, min(latitude) AS south, max(latitude) AS north, min(longitude) AS west,
         max(longitude) AS east, min(obs_date) AS earliest, max(obs_date) AS latest
  FROM (SELECT *, {SEASON_KEY} AS season_region_key FROM obs) GROUP BY season_region_key""",
    "matched": """
  SELECT o.* FROM obs o WHERE o.example_id IN (SELECT example_id FROM best)""",
    "vocab_tokens": """
  SELECT 's2_token_' || k::VARCHAR AS feature, s2_tokens[k + 1] AS token, example_id FROM matched, range(17) AS t(k)
  UNION ALL SELECT 'eco_biome', eco_biome, example_id FROM matched
  UNION ALL SELECT 'eco_num', eco_num, example_id FROM matched""",
    "vocab": """
  SELECT feature, token, n, row_number() OVER (PARTITION BY feature ORDER BY n DESC, token DESC) - 1 AS id
  FROM (SELECT feature, token, count(*) AS n FROM vocab_tokens GROUP BY feature, token)""",
    "scaler": """
  SELECT (SELECT min(elevation) FROM matched)::DOUBLE AS elevation_min, (SELECT max(elevation) FROM matched)::DOUBLE AS elevation_max,
         min(min_temp) AS min_temp_min, max(min_temp) AS min_temp_max, min(max_temp) AS max_temp_min, max(max_temp) AS max_temp_max,
         min(daylight)::DOUBLE AS daylight_min, max(daylight)::DOUBLE AS daylight_max,
         min(precipitation) AS precipitation_min, max(precipitation) AS precipitation_max FROM win""",
    "scaled_win": """
  SELECT example_id, pos, (max_temp - max_temp_min) / (max_temp_max - max_temp_min) AS max_s,
         (min_temp - min_temp_min) / (min_temp_max - min_temp_min) AS min_s,
         (precipitation - precipitation_min) / (precipitation_max - precipitation_min) AS prcp_s,
         (daylight - daylight_min) / (daylight_max - daylight_min) AS day_s
  FROM win, scaler""",
    "listing": """
  SELECT unnest(['occurrences/' || source || '/' || lpad(doc_id::VARCHAR, 10, '0') || '.tfrecords',
                 'protected_areas/' || lang || '/' || lpad(doc_id::VARCHAR, 10, '0') || '.tfrecords',
                 'random/' || (doc_id % 5)::VARCHAR || '/' ||
                   (doc_id // 5 + 1 + CASE WHEN doc_id >= 100 THEN 1 ELSE 0 END)::VARCHAR || '.tfrecords']) AS path
  FROM documents""",
    "entries": """
  SELECT path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, regexp_extract(path, '([^/]*)$', 1) AS name FROM listing""",
    "sources": """
  SELECT 'u' || s_suppkey::VARCHAR AS usage_id, k::VARCHAR AS source_type, (s_suppkey * 15 + k * 5 + j)::VARCHAR AS target_id
  FROM supplier, range(3) AS a(k), range(5) AS b(j)
  WHERE s_suppkey % 11 <> 0 AND (s_suppkey + j) % 4 > 1""",
    "areas": f"""
  SELECT *, {TOKENS} AS s2_tokens FROM (
    SELECT {LAT.format(k='p_partkey')} AS latitude, {LON.format(k='p_partkey')} AS longitude, (p_partkey * 13) % 3000 AS elevation,
           (p_partkey % 8 + 1)::VARCHAR AS eco_realm, (p_partkey % 14 + 1)::VARCHAR AS eco_biome,
           (p_partkey % 30 + 1)::VARCHAR AS eco_num, p_partkey * 1000 AS modified_at FROM part)""",
    "evals": """
  SELECT user_id % 18 AS experiment_id, value / 500.0::DOUBLE AS accuracy, ((event_id * 7) % 1000)::DOUBLE / 1000.0::DOUBLE AS auc,
         ((event_id * 11) % 1000)::DOUBLE / 1000.0::DOUBLE AS auc_precision_recall, value / 250.0::DOUBLE AS average_loss,
         ((event_id * 13) % 1000)::DOUBLE / 1000.0::DOUBLE AS label_mean, ((event_id * 17) % 1000)::DOUBLE / 1000.0::DOUBLE AS prediction_mean
  FROM events""",
    "rollup": """
  SELECT experiment_id, greatest(max(accuracy), 0) AS max_accuracy, greatest(max(auc_precision_recall), 0) AS max_precision_recall,
         greatest(max(auc), 0) AS max_auc, least(min(average_loss), 1) AS min_average_loss, avg(label_mean) AS label_mean,
         avg(prediction_mean) AS prediction_mean, count(*) AS total_evals
  FROM evals GROUP BY experiment_id""",
    "grid": """
  SELECT d * 3 + p - 3 AS experiment_id, 'precipitation' AS columns, d AS days, (removed * d)::BIGINT AS days_removed,
         removed::BIGINT AS slice_index, (120 // d - removed)::BIGINT AS shape
  FROM (SELECT d, p, round((120 // d) * [0.0, 0.2, 0.4][p + 1])::BIGINT AS removed FROM range(1, 7) AS a(d), range(3) AS b(p))""",
    "scores": """
  SELECT (user_id % 3 = 0)::INTEGER::DOUBLE AS label, ((event_id * 7919) % 99991 + 1)::DOUBLE / 100000.0::DOUBLE AS score FROM events""",
}


def _inverse(source: str, lat1: str, lon1: str, lat2: str, lon2: str, rounds: int = 8) -> str:
    """Ellipsoidal distance as nested selects; adds the column ``dist``."""
    f = repr(ELLIPSOID_FLATTENING) + "::DOUBLE"
    q = (
        f"SELECT *, atan((1 - {f}) * tan(radians({lat1}))) AS u1, atan((1 - {f}) * tan(radians({lat2}))) AS u2, "
        f"radians({lon2}) - radians({lon1}) AS l, radians({lon2}) - radians({lon1}) AS lam FROM {source}"
    )
    for _ in range(rounds):
        q = (
            "SELECT * EXCLUDE (lam), l + (1 - cc) * {f} * sa * (sig + cc * ss * (c2m + cc * cs * (2 * c2m * c2m - 1))) AS lam FROM ("
            "SELECT *, CASE WHEN c2a = 0 THEN 0.0 ELSE cs - 2 * sin(u1) * sin(u2) / c2a END AS c2m, "
            "{f} / 16 * c2a * (4 + {f} * (4 - 3 * c2a)) AS cc FROM ("
            "SELECT *, 1 - sa * sa AS c2a FROM ("
            "SELECT *, atan2(ss, cs) AS sig, CASE WHEN ss = 0 THEN 0.0 ELSE cos(u1) * cos(u2) * sin(lam) / ss END AS sa FROM ("
            "SELECT * EXCLUDE (ss, cs, sig, sa, c2a, c2m, cc), "
            "sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss, "
            "sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM (" + q + ")))))"
        ).replace("{f}", f)
        if _ == 0:
            q = q.replace(" EXCLUDE (ss, cs, sig, sa, c2a, c2m, cc)", "", 1)
    major, minor = (repr(v) + "::DOUBLE" for v in (ELLIPSOID_MAJOR_KM, ELLIPSOID_MINOR_KM))
    return (
        f"SELECT * EXCLUDE (u1, u2, l, lam, ss, cs, sig, sa, c2a, c2m, cc, q, a, b), CASE WHEN ss = 0 THEN 0.0 ELSE {minor} * a * (sig - "
        "b * ss * (c2m + b / 4 * (cs * (2 * c2m * c2m - 1) - b / 6 * c2m * (4 * ss * ss - 3) * (4 * c2m * c2m - 3)))) END AS dist FROM ("
        "SELECT *, 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q))) AS a, "
        "q / 1024 * (256 + q * (-128 + q * (74 - 47 * q))) AS b FROM ("
        f"SELECT *, c2a * ({major} * {major} - {minor} * {minor}) / ({minor} * {minor}) AS q FROM (" + q + ")))"
    )


def _direct(source: str, lat: str, lon: str, bearing: float, km: str, out_lat: str, out_lon: str, rounds: int = 8) -> str:
    """Destination on the ellipsoid as nested selects; adds two columns."""
    f = repr(ELLIPSOID_FLATTENING) + "::DOUBLE"
    major, minor = (repr(v) + "::DOUBLE" for v in (ELLIPSOID_MAJOR_KM, ELLIPSOID_MINOR_KM))
    sb, cb = f"sin(radians({bearing}::DOUBLE))", f"cos(radians({bearing}::DOUBLE))"
    q = f"SELECT *, (1 - {f}) * tan(radians({lat})) AS tu FROM {source}"
    q = f"SELECT *, 1 / sqrt(1 + tu * tu) AS cu FROM ({q})"
    q = f"SELECT *, tu * cu AS su, atan2(tu, {cb}) AS s1, cu * {sb} AS sa FROM ({q})"
    q = f"SELECT *, (1 - sa * sa) * ({major} * {major} - {minor} * {minor}) / ({minor} * {minor}) AS q FROM ({q})"
    q = (
        "SELECT *, 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q))) AS a, "
        f"q / 1024 * (256 + q * (-128 + q * (74 - 47 * q))) AS b FROM ({q})"
    )
    q = f"SELECT *, {km} / ({minor} * a) AS base, {km} / ({minor} * a) AS sig FROM ({q})"
    for _ in range(rounds):
        q = (
            "SELECT * EXCLUDE (sig, c2m), base + b * sin(sig) * (c2m + b / 4 * (cos(sig) * (2 * c2m * c2m - 1) "
            "- b / 6 * c2m * (4 * sin(sig) * sin(sig) - 3) * (4 * c2m * c2m - 3))) AS sig FROM ("
            f"SELECT *, cos(2 * s1 + sig) AS c2m FROM ({q}))"
        )
    q = (
        f"SELECT *, cos(2 * s1 + sig) AS c2m, su * sin(sig) - cu * cos(sig) * {cb} AS w, "
        f"{f} / 16 * (1 - sa * sa) * (4 + {f} * (4 - 3 * (1 - sa * sa))) AS cc FROM ({q})"
    )
    dl = (
        f"(atan2(sin(sig) * {sb}, cu * cos(sig) - su * sin(sig) * {cb}) - (1 - cc) * {f} * sa * "
        "(sig + cc * sin(sig) * (c2m + cc * cos(sig) * (2 * c2m * c2m - 1))))"
    )
    return (
        f"SELECT * EXCLUDE (tu, cu, su, s1, sa, q, a, b, base, sig, c2m, w, cc), "
        f"degrees(atan2(su * cos(sig) + cu * sin(sig) * {cb}, (1 - {f}) * sqrt(sa * sa + w * w))) AS {out_lat}, "
        f"{lon} + degrees({dl}) AS {out_lon} FROM ({q})"
    )


def _boxes(extend_km: float) -> str:
    q = _inverse("extents", "south", "west", "north", "east")
    q = _direct(f"({q})", "south", "west", 45.0, "(dist / 2)", "center_lat", "center_lon")
    q = f"SELECT *, dist / 2 + {extend_km}::DOUBLE AS radius_km FROM ({q})"
    for bearing, lat, lon in ((0.0, "box_north", "x0"), (180.0, "box_south", "x1"), (90.0, "x2", "box_east"), (270.0, "x3", "box_west")):
        q = _direct(f"({q})", "center_lat", "center_lon", bearing, "radius_km", lat, lon)
    return "\n  " + q


CTES["boxes"] = _boxes(100.0)
CTES["box_best"] = f"""
  SELECT example_id, station_key, km
  FROM (SELECT o.example_id, n.station_key, round(n.km, 6) AS km,
               row_number() OVER (PARTITION BY o.example_id ORDER BY round(n.km, 6), n.station_key) AS rn
        FROM (SELECT *, {SEASON_KEY} AS season_region_key FROM obs) o
        JOIN boxes x ON x.season_region_key = o.season_region_key
        JOIN near n ON o.latitude = n.latitude AND o.longitude = n.longitude
        JOIN complete c ON c.station_key = n.station_key AND c.end_day = o.end_day
        WHERE split_part(n.station_key, '|', 1)::DOUBLE BETWEEN x.box_south AND x.box_north
          AND split_part(n.station_key, '|', 2)::DOUBLE BETWEEN x.box_west AND x.box_east)
  WHERE rn = 1"""


def with_ctes(statement: str) -> str:
    """The statement after the shared steps that it names, each behind the ones it needs itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"(?:FROM|JOIN|win,)\s+{name}\b", text):
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(statement)
    if not order:
        return statement
    # Steps read more than once are computed once.
    steps = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order)
    text = statement.strip()
    if text.startswith("WITH "):
        return f"WITH {steps},\n{text[5:]}"
    return f"WITH {steps}\n{text}"
