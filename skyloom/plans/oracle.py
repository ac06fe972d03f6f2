"""SQL twins of the registered queries, written independently for DuckDB."""

from __future__ import annotations

from skyloom.functions.text import STOP_WORDS
from skyloom.plans.inputs import REGION_RINGS, TEXT_QUERIES, _geojson  # noqa: F401

_D = "CAST({} AS DOUBLE)"

READINGS = """readings AS (
  SELECT event_id, event_type, ts AS reading_ts, CAST(date_trunc('day', ts) AS TIMESTAMP) AS measurement_time,
    CAST(5.75 AS DOUBLE) + CAST(0.25 AS DOUBLE) * (user_id % 37) AS lon,
    CAST(47.25 AS DOUBLE) + CAST(0.25 AS DOUBLE) * (user_id % 29) AS lat,
    CASE WHEN event_id % 97 <> 0 THEN CAST(268.15 AS DOUBLE) + CAST(0.1 AS DOUBLE) * value END AS temperature,
    CAST(101325 AS DOUBLE) - CAST(10 AS DOUBLE) * value AS pressure,
    CAST(0.5 AS DOUBLE) * ((event_id % 41) - 20) AS u10,
    CAST(0.5 AS DOUBLE) * ((event_id % 29) - 14) AS v10
  FROM events)"""

GEO_POINTS = """geo_points AS (
  SELECT CAST(5.75 AS DOUBLE) + CAST(0.25 AS DOUBLE) * (user_id % 37) AS lon,
    CAST(47.25 AS DOUBLE) + CAST(0.25 AS DOUBLE) * (user_id % 29) AS lat,
    min('Town_' || n_name) AS nearest_town
  FROM events JOIN nation ON user_id % 25 = n_nationkey GROUP BY 1, 2)"""


def _edge_values() -> str:
    rows = []
    for name, polygons in REGION_RINGS.items():
        for ring in (r for rings in polygons for r in rings):
            for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
                rows.append(f"('{name}', {x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE)")
    return ", ".join(rows)


EDGES = f"edges AS (SELECT * FROM (VALUES {_edge_values()}) t(region_name, x1, y1, x2, y2))"

LOCATED = """located AS (
  SELECT p.lon, p.lat, e.region_name
  FROM (SELECT DISTINCT lon, lat FROM readings) p JOIN edges e
    ON ((e.y1 > p.lat) <> (e.y2 > p.lat)) AND p.lon < (e.x2 - e.x1) * (p.lat - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)"""

ANYWHERE = "anywhere AS (SELECT DISTINCT lon, lat FROM located)"

REGION_TEXTS = """region_texts AS (
  SELECT region_id, 'R' || region_id AS region_name, tourism_info, transportation, economics, introduced_species,
    embedding
  FROM (SELECT doc_id // 4 AS region_id,
      max(CASE WHEN doc_id % 4 = 0 THEN text END) AS tourism_info,
      max(CASE WHEN doc_id % 4 = 1 THEN text END) AS transportation,
      max(CASE WHEN doc_id % 4 = 2 THEN text END) AS economics,
      max(CASE WHEN doc_id % 4 = 3 THEN text END) AS introduced_species
    FROM documents GROUP BY 1) t LEFT JOIN embeddings ON vec_id = region_id)"""

LATENCIES = "latencies AS (SELECT event_type AS query_type, CAST(floor(value * 10) AS BIGINT) AS latency_ms FROM events)"

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def _stem(w: str) -> str:
    kept = " OR ".join(f"ends_with({w}, '{e}')" for e in ("us", "ss", "aies", "eies", "aes", "ees", "oes"))
    return f"""CASE WHEN NOT ends_with({w}, 's') OR length({w}) < 3 OR {w} = 'ies' OR {kept} THEN {w}
      WHEN ends_with({w}, 'ies') THEN left({w}, length({w}) - 3) || 'y'
      ELSE left({w}, length({w}) - 1) END"""


def _terms_of(text: str) -> str:
    """List of the terms of a text expression."""
    tokens = f"regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')"
    kept = f"list_filter({tokens}, lambda w: w <> '' AND w NOT IN ({_STOP}))"
    return f"list_transform({kept}, lambda w: {_stem('w')})"


def _postings(*columns: str) -> str:
    """CTEs ``lens(doc, column, doc_len)``, ``post(doc, column, term, tf)``, ``stat``, ``dfs``."""
    parts = " UNION ALL ".join(
        f"SELECT region_id AS doc, '{c}' AS \"column\", {_terms_of(c)} AS terms FROM region_texts WHERE {c} IS NOT NULL"
        for c in columns
    )
    return f"""{REGION_TEXTS}, analyzed AS ({parts}),
  lens AS (SELECT doc, "column", len(terms) AS doc_len FROM analyzed WHERE len(terms) > 0),
  post AS (SELECT doc, "column", term, count(*) AS tf
    FROM (SELECT doc, "column", unnest(terms) AS term FROM analyzed) GROUP BY 1, 2, 3),
  stat AS (SELECT "column", count(*) AS n_docs, avg(doc_len) AS avg_len FROM lens GROUP BY 1),
  dfs AS (SELECT "column", term, count(*) AS df FROM post GROUP BY 1, 2)"""


_WEIGHT = """ln(1 + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
  / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * doc_len / avg_len))"""


def _scores(query: str, columns: tuple[str, ...], combine: str = "max") -> str:
    return f"""WITH {_postings(*columns)},
  asked AS (SELECT DISTINCT unnest({_terms_of(f"'{query}'")}) AS term),
  by_column AS (SELECT doc, "column", sum({_WEIGHT}) AS s FROM post JOIN asked USING (term)
    JOIN lens USING (doc, "column") JOIN stat USING ("column") JOIN dfs USING ("column", term) GROUP BY 1, 2),
  scores AS (SELECT doc, round({combine}(s), 6) AS score FROM by_column GROUP BY 1)"""


_ALL_TEXT = ("tourism_info", "transportation", "economics", "introduced_species")


def _batch() -> str:
    rows = ", ".join(f"('{i}', '{q}')" for i, q in TEXT_QUERIES.items())
    return f"""WITH {_postings('economics')},
  asked AS (SELECT DISTINCT query_id, unnest({_terms_of('query_text')}) AS term
    FROM (VALUES {rows}) q(query_id, query_text)),
  scores AS (SELECT query_id, doc, round(sum({_WEIGHT}), 6) AS score FROM post JOIN asked USING (term)
    JOIN lens USING (doc, "column") JOIN stat USING ("column") JOIN dfs USING ("column", term) GROUP BY 1, 2),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS rank FROM scores)
  SELECT query_id, CAST(rank AS INTEGER) AS rank, doc, score FROM ranked WHERE rank <= 3"""


def _haversine(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return f"""2 * 6371008.8::DOUBLE * asin(least(1::DOUBLE, sqrt(
      pow(sin(radians({lat2} - {lat1}) / 2), 2)
      + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"""


_IN_RANGE = "measurement_time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'"


def _inside(region: str) -> str:
    """Condition on readings ``r``: the location lies in the region, or in any."""
    only = "" if region == "ALL" else f" AND l.region_name = '{region}'"
    return f"EXISTS (SELECT 1 FROM located l WHERE l.lon = r.lon AND l.lat = r.lat{only})"


_BASE = f"WITH {READINGS}, {EDGES}, {LOCATED}"
_BASE_POINTS = f"{_BASE}, {GEO_POINTS}"
_SPEED = "sqrt(u10 * u10 + v10 * v10)"
_DIRECTION = "CASE WHEN u10 <> 0 OR v10 <> 0 THEN ((degrees(atan2(-u10, -v10)) % 360) + 360) % 360 END"


def _series(value: str, region: str) -> str:
    return f"""{_BASE} SELECT measurement_time AS time, round(min({value}), 6) AS min_value,
      round(avg({value}), 6) AS avg_value, round(max({value}), 6) AS max_value
      FROM readings r WHERE {_IN_RANGE} AND {_inside(region)} GROUP BY 1"""


def _snapshot(values: str, region: str) -> str:
    return f"""{_BASE_POINTS} SELECT r.measurement_time AS time, r.lat AS latitude, r.lon AS longitude,
      nearest_town, {values} FROM readings r JOIN geo_points g ON g.lon = r.lon AND g.lat = r.lat
      WHERE r.measurement_time = (SELECT max(measurement_time) FROM readings WHERE {_IN_RANGE})
        AND {_inside(region)}"""


_REGION_SNAPSHOT = f"""{_BASE_POINTS} SELECT {{}} r.measurement_time AS time, r.lat AS latitude,
    r.lon AS longitude, round(r.temperature - 273.15::DOUBLE, 6) AS temperature, g.nearest_town
  FROM readings r JOIN located l ON l.lon = r.lon AND l.lat = r.lat
    JOIN geo_points g ON g.lon = r.lon AND g.lat = r.lat
  WHERE r.measurement_time = (SELECT max(measurement_time) FROM readings)"""

_PROBES = """probes AS (SELECT c_custkey AS probe_id,
    CAST(5.75 AS DOUBLE) + CAST(0.25 AS DOUBLE) * (c_custkey % 41) AS lon,
    CAST(47.25 AS DOUBLE) + CAST(0.25 AS DOUBLE) * (c_custkey % 31) AS lat,
    CAST(DATE '2024-01-01' + CAST(c_custkey % 35 AS INTEGER) AS TIMESTAMP) AS probe_time FROM customer)"""


def _probe_batch(radius: float) -> str:
    return f"""WITH {READINGS}, {_PROBES}
  SELECT p.probe_id, p.lon, p.lat, p.probe_time, round(min(r.temperature), 6) AS min_t,
    round(max(r.temperature), 6) AS max_t
  FROM probes p LEFT JOIN readings r ON r.measurement_time = p.probe_time
    AND {_haversine('r.lon', 'r.lat', 'p.lon', 'p.lat')} < {radius}
  GROUP BY 1, 2, 3, 4"""


_TITLES = """titles AS (SELECT p_partkey, CASE WHEN p_partkey % 50 <> 0
    THEN p_name || ' for $' || p_type || ', ${' || p_size || '} !' ELSE '?!' END AS title FROM part),
  slugs AS (SELECT p_partkey, CASE WHEN s = '' THEN 'panel' ELSE s END AS slug FROM (
    SELECT p_partkey, lower(trim(regexp_replace(regexp_replace(title, '\\$\\{?(\\w+)\\}?', '\\1', 'g'),
      '[^A-Za-z0-9]+', '_', 'g'), '_')) AS s FROM titles))"""

_KEYED = """keyed AS (SELECT CASE WHEN event_id % 101 <> 0 THEN user_id END AS user_id, event_type, ts,
    event_id, value FROM events),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id, value) AS rn
    FROM keyed)"""

_LABEL_DECIMAL = "CAST(round(CAST({} AS DECIMAL(18, 6)), 2) AS DECIMAL(18, 2))"


def _label(kelvin: str) -> str:
    celsius = _LABEL_DECIMAL.format(f"({kelvin} - 273.15::DOUBLE)")
    return f"{celsius} || ' C (' || {_LABEL_DECIMAL.format(kelvin)} || ' K)'"


def _knn(distance: str, score: str, source: str, key: str, k: int) -> str:
    return f"""WITH q AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 42),
  d AS (SELECT {key} AS id, {distance} AS distance FROM {source}, q WHERE embedding IS NOT NULL)
  SELECT id, round({score}, 6) AS score FROM d ORDER BY distance, id LIMIT {k}"""


_D2 = "list_sum(list_transform(list_zip(embedding::DOUBLE[], qv), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _knn_batch(queries: str, k: int) -> str:
    return f"""WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS qv FROM embeddings {queries}),
  d AS (SELECT query_id, vec_id AS id, {_D2} AS distance FROM embeddings, q),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM d)
  SELECT query_id, CAST(rank AS INTEGER) AS rank, id, round(1 / (1 + distance), 6) AS score FROM r WHERE rank <= {k}"""


_BUCKETED = f"""{LATENCIES}, shifted AS (SELECT query_type, greatest(latency_ms, 0) AS v,
    CAST(1 AS BIGINT) << greatest(length(bin(greatest(latency_ms, 0))) - 11, 0) AS w FROM latencies),
  histogram AS (SELECT query_type, v - v % w AS bucket_low, v - v % w + w - 1 AS bucket_high, count(*) AS n
    FROM shifted GROUP BY 1, 2, 3)"""

_CURVE = "unnest([50.0, 75.0, 90.0, 95.0, 99.0, 99.9, 99.99]::DOUBLE[])"

_PANELS = """kinds AS (SELECT event_id AS dashboard, event_type AS kind FROM events),
  panels AS (
    SELECT dashboard, 0 AS position, 2 AS id, 'Average ' || kind || ' for ${region}' AS title,
      'average_' || kind || '_for_region' AS name,
      'SELECT ' || kind || ' FROM t WHERE $__timeFilter("ts") AND r = ''$region'' AND x > ${latitude}' AS raw_sql
    FROM kinds
    UNION ALL SELECT dashboard, 1, 3, 'Average ' || kind || ' for ${region}', 'average_' || kind || '_for_region_3',
      'SELECT ${other}, $region_name, $keyword, $keyword' FROM kinds
    UNION ALL SELECT dashboard, 2, 4, 'panel_4', 'panel_4', 'SELECT 1' FROM kinds)"""

ORACLE: dict[str, str] = {
    "region_snapshot": _REGION_SNAPSHOT.format("") + " AND l.region_name = 'Concave'",
    "region_snapshot_all": _REGION_SNAPSHOT.format("l.region_name,"),
    "within_join": f"{_BASE} SELECT event_id, region_name FROM readings JOIN located USING (lon, lat)",
    "within_join_grid": f"{_BASE} SELECT event_id, region_name FROM readings JOIN located USING (lon, lat)",
    "within_semi": f"{_BASE} SELECT event_id FROM readings r WHERE {_inside('ALL')}",
    "outside_anti": f"{_BASE} SELECT event_id FROM readings r WHERE NOT {_inside('ALL')}",
    "location_join": f"WITH {READINGS}, {GEO_POINTS} SELECT event_id, nearest_town FROM readings JOIN geo_points USING (lon, lat)",
    "polygon_edges": """WITH corners AS (SELECT c_custkey, c_custkey::DOUBLE AS k FROM customer),
  square AS (SELECT c_custkey, 0 AS ring, unnest([
      {'edge': 0, 'x1': k, 'y1': 1.0::DOUBLE, 'x2': k, 'y2': 2.0::DOUBLE},
      {'edge': 1, 'x1': k, 'y1': 2.0::DOUBLE, 'x2': 0.0::DOUBLE, 'y2': 2.0::DOUBLE},
      {'edge': 2, 'x1': 0.0::DOUBLE, 'y1': 2.0::DOUBLE, 'x2': 0.0::DOUBLE, 'y2': 1.0::DOUBLE},
      {'edge': 3, 'x1': 0.0::DOUBLE, 'y1': 1.0::DOUBLE, 'x2': k, 'y2': 1.0::DOUBLE}]) AS e FROM corners),
  both_rings AS (SELECT * FROM square UNION ALL SELECT c_custkey, 1, e FROM square WHERE c_custkey % 3 = 0)
  SELECT c_custkey, ring, e.edge AS edge, e.x1 AS x1, e.y1 AS y1, e.x2 AS x2, e.y2 AS y2 FROM both_rings
  WHERE NOT (e.x1 = e.x2 AND e.y1 = e.y2)""",
    "point_in_polygon": f"""{_BASE} SELECT event_id,
      EXISTS (SELECT 1 FROM located l WHERE l.lon = r.lon AND l.lat = r.lat AND l.region_name = 'Holed') AS inside
      FROM readings r""",
    "geo_distance": f"WITH {READINGS} SELECT event_id, round({_haversine('lon', 'lat', '10.0::DOUBLE', '50.0::DOUBLE')}, 3) AS metres FROM readings",
    "distance_filter": f"WITH {READINGS} SELECT event_id FROM readings WHERE {_haversine('lon', 'lat', '10.0::DOUBLE', '50.0::DOUBLE')} < 150000",
    "parse_wkt_point": f"""WITH {READINGS} SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN lon END AS lon,
      CASE WHEN event_id % 11 <> 0 THEN lat END AS lat FROM readings""",
    "format_wkt_point": f"WITH {READINGS} SELECT event_id, 'POINT(' || lon || ' ' || lat || ')' AS wkt FROM readings",
    "parse_point_text": f"""WITH {READINGS} SELECT event_id, CASE WHEN event_id % 4 < 2 THEN lon END AS lon,
      CASE WHEN event_id % 4 < 2 THEN lat END AS lat FROM readings""",
    "proximity_minmax": f"""WITH {READINGS} SELECT round(min(temperature), 6) AS min_t, round(max(temperature), 6) AS max_t
      FROM readings WHERE measurement_time = TIMESTAMP '2024-01-10'
        AND {_haversine('lon', 'lat', '7.75::DOUBLE', '49.25::DOUBLE')} < 1""",
    "proximity_batch": _probe_batch(30000),
    "proximity_batch_exact_point": _probe_batch(1),
    "proximity_batch_shuffled": _probe_batch(30000),
    "sample_probes": f"""WITH {READINGS},
  points AS (SELECT lon, lat, row_number() OVER (ORDER BY h) - 1 AS i FROM (SELECT lon, lat,
      md5('7:' || CAST(round(lon * 1e6) AS BIGINT) || ':' || CAST(round(lat * 1e6) AS BIGINT)) AS h
    FROM (SELECT DISTINCT lon, lat FROM readings) ORDER BY h LIMIT 200)),
  times AS (SELECT t, row_number() OVER (ORDER BY h) - 1 AS i FROM (SELECT t,
      md5('7:' || strftime(t, '%Y-%m-%d %H:%M:%S.%f')) AS h
    FROM (SELECT DISTINCT measurement_time AS t FROM readings) ORDER BY h LIMIT 200))
  SELECT g.i AS probe_id, lon, lat, t AS probe_time FROM (SELECT unnest(range(200)) AS i) g
    JOIN points p ON p.i = g.i % (SELECT count(*) FROM points)
    JOIN times s ON s.i = g.i % (SELECT count(*) FROM times)""",
    "distinct_locations": f"WITH {READINGS} SELECT DISTINCT lon, lat FROM readings",
    "distinct_times": f"WITH {READINGS} SELECT DISTINCT measurement_time FROM readings",
    "region_names": f"WITH {REGION_TEXTS} SELECT region_name FROM region_texts",
    "time_equals": f"WITH {READINGS} SELECT event_id FROM readings WHERE measurement_time = TIMESTAMP '2024-01-10'",
    "time_range": "SELECT event_id, ts AS reading_ts FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'",
    "region_or_all": f"""WITH {REGION_TEXTS} SELECT 'one' AS asked, region_name FROM region_texts WHERE region_name = 'R7'
      UNION ALL SELECT 'every', region_name FROM region_texts""",
    "latest_epoch": f"""WITH {READINGS} SELECT event_id, measurement_time FROM readings
      WHERE measurement_time = (SELECT max(measurement_time) FROM readings)""",
    "latest_epoch_in_range": f"""WITH {READINGS} SELECT event_id, measurement_time FROM readings
      WHERE measurement_time = (SELECT max(measurement_time) FROM readings WHERE {_IN_RANGE})""",
    "last_measurement_time": "SELECT max(ts) AS last_measurement_time FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'",
    "nested_field": f"WITH {READINGS} SELECT event_id, round(temperature, 6) AS temperature FROM readings",
    "kelvin_to_celsius": f"WITH {READINGS} SELECT event_id, round(temperature - 273.15::DOUBLE, 6) AS celsius FROM readings",
    "temperature_label": f"WITH {READINGS} SELECT event_id, {_label('temperature')} AS label FROM readings",
    "wind_speed": f"WITH {READINGS} SELECT event_id, round({_SPEED}, 6) AS wind_speed FROM readings",
    "wind_direction": f"WITH {READINGS} SELECT event_id, round({_DIRECTION}, 4) AS wind_direction FROM readings",
    "normalize_query_text": "SELECT doc_id, trim(replace(text, chr(10), ' '), ' ') AS query_text FROM documents",
    "slugify": f"WITH {_TITLES} SELECT p_partkey, slug FROM slugs",
    "dedupe_slug": f"""WITH {_TITLES} SELECT p_partkey,
      CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY p_partkey) = 1 THEN slug ELSE slug || '_' || p_partkey END AS name
      FROM slugs""",
    "minavgmax_temperature": _series("temperature", "Concave"),
    "minavgmax_pressure": _series("pressure", "Holed"),
    "minavgmax_wind_speed_all": _series(_SPEED, "ALL"),
    "minavgmax_total": f"""{_BASE} SELECT round(min(temperature), 6) AS min_value, round(avg(temperature), 6) AS avg_value,
      round(max(temperature), 6) AS max_value FROM readings r WHERE {_IN_RANGE} AND {_inside('ALL')}""",
    "snapshot_temperature": _snapshot("round(temperature, 6) AS temperature", "ALL"),
    "snapshot_pressure": _snapshot("round(pressure, 6) AS pressure", "Holed"),
    "snapshot_wind": _snapshot(f"round({_SPEED}, 6) AS wind_speed, round({_DIRECTION}, 4) AS wind_direction", "ALL"),
    "latest_gauge": f"""{_BASE} SELECT max(measurement_time) AS time, round(avg(temperature), 6) AS avg_value FROM readings r
      WHERE measurement_time = (SELECT max(measurement_time) FROM readings WHERE {_IN_RANGE}) AND {_inside('ALL')}""",
    "extreme_place": f"""{_BASE_POINTS} SELECT nearest_town, r.lat AS latitude, r.lon AS longitude,
      round(temperature, 6) AS value, round(temperature - 273.15::DOUBLE, 6) AS celsius, {_label('temperature')} AS label
      FROM readings r LEFT JOIN geo_points g ON g.lon = r.lon AND g.lat = r.lat
      WHERE measurement_time = (SELECT max(measurement_time) FROM readings WHERE {_IN_RANGE}) AND {_inside('ALL')}
        AND temperature IS NOT NULL
      ORDER BY temperature, r.lat, r.lon LIMIT 1""",
    "rank_places": f"""{_BASE_POINTS}, places AS (SELECT lon, lat, max({_SPEED}) AS value FROM readings r
      WHERE measurement_time = (SELECT max(measurement_time) FROM readings WHERE {_IN_RANGE}) AND {_inside('ALL')}
      GROUP BY 1, 2), ranked AS (SELECT *, row_number() OVER (ORDER BY value DESC, lat, lon) AS rank FROM places)
      SELECT CAST(rank AS INTEGER) AS rank, nearest_town, r.lat AS latitude, r.lon AS longitude, round(value, 6) AS value
      FROM ranked r LEFT JOIN geo_points g ON g.lon = r.lon AND g.lat = r.lat WHERE rank <= 10""",
    "daily_avg_at_location": f"""WITH {READINGS} SELECT CAST(date_trunc('day', reading_ts) AS TIMESTAMP) AS day,
      round(avg({_SPEED}), 6) AS avg_value FROM readings
      WHERE reading_ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'
        AND {_haversine('lon', 'lat', '7.75::DOUBLE', '49.25::DOUBLE')} < 1 GROUP BY 1""",
    "hourly_agg": f"""WITH {READINGS} SELECT CAST(date_trunc('hour', reading_ts) AS TIMESTAMP) AS hour, count(temperature) AS n,
      round(min(temperature), 6) AS min_value, round(avg(temperature), 7) AS avg_value,
      round(max(temperature), 6) AS max_value FROM readings GROUP BY 1""",
    "load_tables": f"""WITH {READINGS}, {GEO_POINTS} SELECT event_id, event_type, measurement_time, lon, lat,
      round(temperature, 6) AS temperature, nearest_town FROM readings JOIN geo_points USING (lon, lat)""",
    "dynamic_object": """SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN value END AS temperature,
      CAST(NULL AS DOUBLE) AS pressure, CASE WHEN event_id % 13 <> 0 THEN event_type END AS kind FROM events""",
    "enforce_key_kept": f"WITH {_KEYED} SELECT user_id, event_type, ts, event_id, value FROM numbered WHERE rn = 1 AND user_id IS NOT NULL AND event_type IS NOT NULL",
    "enforce_key_rejected": f"WITH {_KEYED} SELECT user_id, event_type, ts, event_id, value FROM numbered WHERE rn > 1 OR user_id IS NULL OR event_type IS NULL",
    "preview": """SELECT o_orderkey, o_custkey, o_orderstatus, (SELECT count(*) FROM orders) AS total_rows,
      greatest((SELECT count(*) FROM orders) - 50, 0) AS omitted_rows FROM orders ORDER BY o_orderkey LIMIT 50""",
    "analyze_english": f"""WITH a AS (SELECT doc_id, {_terms_of('text')} AS terms FROM documents)
      SELECT doc_id, CAST(unnest(range(len(terms))) AS INTEGER) AS pos, unnest(terms) AS term FROM a""",
    "build_postings": f"""WITH {_postings(*_ALL_TEXT)} SELECT doc, "column", term, tf, doc_len FROM post JOIN lens USING (doc, "column")""",
    "index_columns": f"""WITH {_postings(*_ALL_TEXT)} SELECT "column", n_docs, round(avg_len, 6) AS avg_len FROM stat""",
    "match_bm25": _scores("tion ther thon", ("economics",)) + " SELECT doc, score FROM scores",
    "match_bm25_multi": _scores("Tion erin", _ALL_TEXT) + " SELECT doc, score FROM scores",
    "match_bm25_sum": _scores("Tion erin", _ALL_TEXT, "sum") + " SELECT doc, score FROM scores",
    "fts_topk": _scores("thon", ("economics",)) + " SELECT doc, score FROM scores ORDER BY score DESC, doc LIMIT 3",
    "ranked_result": _scores("tion ther", _ALL_TEXT) + """ SELECT CAST(row_number() OVER (ORDER BY score DESC, region_name) AS INTEGER) AS rank,
      region_name, round(score, 4) AS score FROM scores JOIN region_texts ON region_id = doc
      ORDER BY rank LIMIT 5""",
    "match_batch": _batch(),
    "match_batch_shuffled": _batch(),
    "keyword_relevance": _scores("ther", ("economics",)) + " SELECT region_name, score FROM scores JOIN region_texts ON region_id = doc",
    "keyword_relevance_name": f"WITH {REGION_TEXTS} SELECT region_name, 1::DOUBLE AS score FROM region_texts WHERE region_name = 'R9'",
    "category_for_region": f"WITH {REGION_TEXTS} SELECT region_name, transportation AS text FROM region_texts",
    "knn_exact": _knn(_D2, "1 / (1 + distance)", "embeddings", "vec_id", 5),
    "knn_exact_cosine": _knn("1 - list_cosine_similarity(embedding::DOUBLE[], qv)", "(2 - distance) / 2",
        "(SELECT embedding, vec_id AS region_id FROM embeddings WHERE vec_id IN (SELECT doc_id // 4 FROM documents))",
        "region_id", 10),
    "knn_batch": _knn_batch("WHERE vec_id IN (7, 42, 99)", 5),
    "knn_batch_blocks": _knn_batch("", 3),
    "count_non_null": f"WITH {REGION_TEXTS} SELECT count(embedding) AS n FROM region_texts",
    "percentile_summary": f"""WITH {LATENCIES} SELECT query_type, count(*) AS n, round(avg(latency_ms), 6) AS avg,
      round(quantile_cont(latency_ms, 0.5), 6) AS p50, round(quantile_cont(latency_ms, 0.99), 6) AS p99,
      round(quantile_cont(latency_ms, 0.999), 6) AS p999, max(latency_ms) AS max FROM latencies GROUP BY 1""",
    "percentile_curve": f"""WITH {LATENCIES}, qs AS (SELECT query_type, quantile_cont(latency_ms::DOUBLE,
        [0.5, 0.75, 0.9, 0.95, 0.99, 0.999, 0.9999]) AS vs FROM latencies GROUP BY 1),
      flat AS (SELECT query_type, {_CURVE} AS percentile, unnest(vs) AS v FROM qs)
      SELECT query_type, percentile, round(1 / (1 - percentile / 100), 6) AS tail,
        round(log10(1 / (1 - percentile / 100)), 6) AS log_tail, round(greatest(v, 1), 6) AS value FROM flat""",
    "log_histogram": f"WITH {_BUCKETED} SELECT * FROM histogram",
    "merge_histograms": f"WITH {_BUCKETED} SELECT * FROM histogram",
    "histogram_percentiles": f"""WITH {_BUCKETED}, running AS (SELECT *,
        sum(n) OVER (PARTITION BY query_type ORDER BY bucket_low) AS upto,
        sum(n) OVER (PARTITION BY query_type) AS total FROM histogram)
      SELECT query_type, percentile, CAST(min(bucket_high) AS BIGINT) AS value
      FROM running, (SELECT {_CURVE} AS percentile)
      WHERE upto * 100 >= percentile * total GROUP BY 1, 2""",
    "load_panels": f"WITH {_PANELS} SELECT dashboard, position, CAST(id AS BIGINT) AS id, title, name, raw_sql FROM panels",
    "panel_variables": f"""WITH {_PANELS} SELECT dashboard, name, unnest(['region', 'latitude', 'time_from', 'time_to']) AS parameter,
      unnest(['string', 'number', 'string', 'string']) AS type FROM panels WHERE position = 0
      UNION ALL SELECT dashboard, name, 'keyword', 'string' FROM panels WHERE position = 1""",
    "panel_query": f"""WITH {READINGS} SELECT event_type AS kind, measurement_time AS time, round(min(temperature), 6) AS min_t,
      count(*) AS n FROM readings WHERE {_IN_RANGE} AND lat < 51 GROUP BY 1, 2""",
    "panel_query_column": f"""WITH {REGION_TEXTS} SELECT region_name, length(economics) AS chars FROM region_texts
      WHERE contains(economics, 'tion')""",
    "query_sql": f"""WITH {READINGS} SELECT event_type, count(*) AS n, max(measurement_time) AS latest FROM readings
      WHERE lon >= 8 GROUP BY 1""",
}

ORACLE |= {
    f"stored_{name}": ORACLE[name]
    for name in (
        "region_snapshot", "minavgmax_temperature", "snapshot_temperature", "rank_places", "proximity_minmax",
        "proximity_batch",
    )
}
ORACLE["sql_geo_point"] = f"""WITH {READINGS}, t AS (SELECT *, event_id % 11 = 0 OR event_id % 13 = 0 AS missing FROM readings)
  SELECT event_id, CASE WHEN NOT missing THEN lon END AS lon, CASE WHEN NOT missing THEN lat END AS lat, missing FROM t"""
