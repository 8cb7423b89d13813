"""DuckDB SQL for every registered pixel query, built from a few shared table expressions."""

from __future__ import annotations

from pixelseries.operators import metrics

BANDS = [f"b{k}" for k in range(1, 8)]
ALL = [*BANDS, "b31"]
B8 = [*BANDS, "ndvi"]
T = "h, v, season_year, pixel"

BASE = """
base AS (
  SELECT n_nationkey::INT AS h, n_regionkey::INT AS v, l_suppkey::BIGINT AS pixel,
         year(l_shipdate) AS yr, dayofyear(l_shipdate) - 1 - (dayofyear(l_shipdate) - 1) % 16 + 1 AS cd,
         l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_shipdate AS ship, l_linestatus AS status, l_returnflag AS flag,
         floor(l_quantity)::INT AS q, floor(l_extendedprice)::INT AS x,
         round(l_discount * 100)::INT AS d, round(l_tax * 100)::INT AS t
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
dated AS (
  SELECT *, (yr * 1000 + cd)::INT AS day, (CASE WHEN cd >= 65 THEN yr ELSE yr - 1 END)::INT AS season_year,
         (CASE WHEN cd >= 65 THEN (cd - 65) // 16 ELSE (cd - 1) // 16 + 19 END)::INT AS idx FROM base)"""

OBS = (
    BASE
    + """,
ch AS (
  SELECT h, v, season_year, pixel, day, idx, CASE WHEN o % 53 = 0 THEN -28672 ELSE q * 60 + d * 7 END AS b3, q * 55 + t * 9 AS b4,
         x % 5000 AS b5, x % 4000 + d AS b6, x % 3000 + t AS b7, CASE WHEN o % 97 = 0 THEN 0 ELSE 14000 + x % 1500 END AS b31
  FROM dated QUALIFY row_number() OVER (PARTITION BY pixel, day ORDER BY o DESC, n DESC, p DESC, ship DESC) = 1),
cq AS (
  SELECT h, v, pixel, day, CASE WHEN p % 53 = 0 THEN -28672 ELSE q * 20 - 100 END AS b1, x % 6000 AS b2,
         (CASE WHEN d = 10 AND n % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN t = 8 AND n % 2 = 1 THEN 4 ELSE 0 END
          + CASE WHEN p % 32 = 0 THEN 192 ELSE (p % 3) * 64 END + CASE WHEN o % 32 = 0 THEN 8192 ELSE 0 END)::INT AS state,
         (CASE WHEN o % 101 = 0 THEN 255 ELSE 20 + p % 54 END)::INT AS zenith
  FROM dated QUALIFY row_number() OVER (PARTITION BY pixel, day ORDER BY p DESC, o DESC, n DESC, ship DESC) = 1),
obs AS (
  SELECT h, v, season_year, pixel, day, idx, b1::INT AS b1, b2::INT AS b2, b3::INT AS b3, b4::INT AS b4, b5::INT AS b5,
         b6::INT AS b6, b7::INT AS b7, b31::INT AS b31, state, zenith FROM ch JOIN cq USING (h, v, pixel, day)),
filled AS (
  SELECT h, v, season_year, pixel, day, idx, nullif(b1, -28672) AS b1, nullif(b2, -28672) AS b2, nullif(b3, -28672) AS b3,
         nullif(b4, -28672) AS b4, nullif(b5, -28672) AS b5, nullif(b6, -28672) AS b6, nullif(b7, -28672) AS b7,
         nullif(b31, 0) AS b31, state, nullif(zenith, 255) AS zenith FROM obs),
judged AS (
  SELECT *, coalesce(zenith, -10001) < 72 AS high,
         coalesce((state & 3) = 0 AND (state & 4) = 0 AND ((state & 192) >> 6) <> 3 AND (state & 8192) = 0
                  AND coalesce(zenith, -10001) < 72, false) AS ok FROM filled)"""
)

CALENDAR = (
    OBS
    + """,
dates AS (
  SELECT DISTINCT h, v, season_year, day, idx FROM obs
  WHERE (h, v, season_year) IN (SELECT (h, v, season_year) FROM obs GROUP BY h, v, season_year HAVING count(DISTINCT day) = 23)),
periods AS (
  SELECT h, v, season_year, day, period, (min(day) OVER (PARTITION BY h, v, season_year, period))::INT AS first_day
  FROM (SELECT *, (ntile(12) OVER (PARTITION BY h, v, season_year ORDER BY day) - 1)::INT AS period FROM dates))"""
)

_masked = ", ".join(f"CASE WHEN ok THEN CASE WHEN high THEN j.{b} ELSE 16000 END END AS {b}" for b in ALL)
GRID = (
    CALENDAR
    + """,
pixels AS (SELECT DISTINCT h, v, season_year, pixel FROM obs),
grid AS (SELECT h, v, season_year, pixel, day, idx FROM pixels JOIN dates USING (h, v, season_year))"""
)
COMP = (
    GRID
    + f""",
clean AS (
  SELECT g.h, g.v, g.season_year, g.pixel, g.day, g.idx, {_masked}
  FROM grid g LEFT JOIN judged j ON g.h = j.h AND g.v = j.v AND g.season_year = j.season_year AND g.pixel = j.pixel AND g.day = j.day),
means AS (
  SELECT {T}, period, min(first_day)::INT AS first_day, {", ".join(f"avg({b}) AS {b}" for b in ALL)}
  FROM clean JOIN periods USING (h, v, season_year, day) GROUP BY {T}, period),
comp AS (
  SELECT *, CASE WHEN b1 IS NULL OR b2 IS NULL OR b1 + b2 = 0 THEN 0 ELSE trunc((b2 - b1) / (b2 + b1) * 1000)::INT END AS ndvi,
         coalesce(trunc(b31)::INT, -10001) AS therm FROM means)"""
)


def _unpivot(source: str, bands: list[str], keep: str, value: str = "{b}::DOUBLE", name: str = "v") -> str:
    return " UNION ALL ".join(f"SELECT {keep}, '{b}' AS band, {value.format(b=b)} AS {name} FROM {source}" for b in bands)


LONG = (
    COMP
    + f""",
long AS ({_unpivot('comp', [*B8, 'b31'], f'{T}, period, ndvi, therm', name='val')}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {T}, band ORDER BY ndvi, period) AS g_up,
         row_number() OVER (PARTITION BY {T}, band ORDER BY ndvi DESC, period DESC) AS g_down,
         row_number() OVER (PARTITION BY {T}, band ORDER BY therm, period) AS t_up,
         row_number() OVER (PARTITION BY {T}, band ORDER BY therm DESC, period DESC) AS t_down,
         row_number() OVER (PARTITION BY {T}, band ORDER BY val NULLS LAST, period) AS own_up,
         row_number() OVER (PARTITION BY {T}, band ORDER BY val DESC NULLS FIRST, period) AS own_down
  FROM long)"""
)
IN8 = "band IN (" + ", ".join(f"'{b}'" for b in B8) + ")"
IN7 = "band IN (" + ", ".join(f"'{b}'" for b in BANDS) + ")"
FULL = "count(val) = count(*)"


def _metric(value: str, where: str = IN8, extra: str = "") -> str:
    return f"SELECT {T}, band, {value} AS value{extra} FROM ranked WHERE {where} GROUP BY {T}, band"


def _mean_of(rank: str, k: int) -> str:
    return f"CASE WHEN count(val) FILTER (WHERE {rank} <= {k}) = {k} THEN sum(val) FILTER (WHERE {rank} <= {k}) / {k} END"


VALUES = {
    "band_min": ("min(val)", IN8),
    "band_median": (f"CASE WHEN {FULL} THEN median(val) END", IN8),
    "band_max": (f"CASE WHEN {FULL} THEN max(val) END", IN8),
    "band_amplitude": (f"CASE WHEN {FULL} THEN max(val) - min(val) END", IN8),
    "green_max": ("max(val) FILTER (WHERE g_down = 1)", IN8),
    "green_median": ("max(val) FILTER (WHERE g_up = 7)", IN8),
    "green_min": ("max(val) FILTER (WHERE g_up = 1)", IN8),
    "temp_max": ("max(val) FILTER (WHERE t_down = 1)", IN8),
    "temp_median": ("max(val) FILTER (WHERE t_up = 7)", IN8),
    "temp_min": ("max(val) FILTER (WHERE t_up = 1)", IN8),
    "temp_mean_warmest3": (_mean_of("own_down", 3), "band = 'b31'"),
    "lowest_3_mean": (_mean_of("own_up", 3), IN7),
}

GRANULES = (
    BASE
    + """,
two AS (
  SELECT *, 'h' || lpad(h::VARCHAR, 2, '0') || 'v' || lpad(v::VARCHAR, 2, '0') AS tile FROM dated),
files AS (
  SELECT 'CH' AS product, h, v, tile, day, max(o) AS stamp FROM two GROUP BY h, v, tile, day, status
  UNION ALL SELECT 'CQ', h, v, tile, day, max(o) FROM two GROUP BY h, v, tile, day, flag),
named AS (
  SELECT product, h, v, tile, day, lpad(stamp::VARCHAR, 13, '0') AS stamp, day // 1000 AS yr, day % 1000 AS doy,
         'REF44' || product || '.A' || day || '.' || tile || '.006.' || lpad(stamp::VARCHAR, 13, '0') || '.hdf' AS path FROM files),
roots AS (SELECT DISTINCT yr::INT AS season_year, tile FROM named WHERE doy = 65),
wanted AS (
  SELECT season_year, tile, (CASE WHEN i < 19 THEN season_year * 1000 + 65 + 16 * i
           ELSE (season_year + 1) * 1000 + 1 + 16 * (i - 19) END)::INT AS day FROM roots, range(23) r(i))"""
)
_PATH = "'REF44' || {p} || '.A' || day || '.' || {t} || '.006.' || stamp || '.hdf'"
NAMES = f"""
SELECT product, tile, day, stamp, path, true AS valid FROM named
UNION ALL SELECT 'CX', tile, day, stamp, {_PATH.format(p="'CX'", t="tile")}, false FROM named
UNION ALL SELECT product, 'y' || tile[2:], day, stamp, {_PATH.format(p="product", t="'y' || tile[2:]")}, false FROM named
UNION ALL SELECT product, 'h0' || tile[2:], day, stamp, {_PATH.format(p="product", t="'h0' || tile[2:]")}, false FROM named"""


def _feature_rows() -> str:
    """(pixel key, metric, band, value) of all 263 features."""

    def rows(name: str, value: str, where: str = IN8) -> str:
        return f"SELECT {T}, '{name}' AS metric, band, value FROM ({_metric(value, where)})"

    parts = [f"SELECT {T}, 'unsorted_monthly' AS metric, band || '-p' || lpad(period::VARCHAR, 2, '0') AS band, val AS value FROM ranked WHERE {IN8}"]
    parts += [rows(n, *VALUES[n]) for n in VALUES if n != "lowest_3_mean"]
    parts += [rows(n, *VALUES["band_amplitude"]) for n in ("amp_greenest", "amp_warmest")]
    for k in (3, 6, 8):
        parts += [rows(f"lowest_{k}_mean", _mean_of("own_up", k), IN7)]
        parts += [rows(f"greenest_{k}_mean", _mean_of("g_down", k)), rows(f"warmest_{k}_mean", _mean_of("t_down", k))]
    parts += [rows("temp_mean_greenest3", _mean_of("g_down", 3), "band = 'b31'")]
    return " UNION ALL ".join(parts)


def _wide() -> str:
    """One row per pixel, a column for each of the 263 features."""
    cells = ", ".join(
        f"max(value) FILTER (WHERE metric = '{name}' AND band = '{b}') AS {f'{name}__{b}'.replace('-', '_')}"
        for name, m in metrics.built_in().items()
        for b in m.bands
    )
    return f"SELECT {T}, {cells} FROM ({_feature_rows()}) GROUP BY {T}"


#: Descriptions are the registry's own words.
SAYS = "(VALUES " + ", ".join(f"('{n}', '{m.says}')" for n, m in metrics.built_in().items()) + ") says(metric, description)"


def statements(slice_days: list[int], dump_day: int, dump_band: str) -> dict[str, str]:
    with_ = lambda tables, body: f"WITH {tables}\n{body}"
    stages = _unpivot("judged", ALL, f"{T}, day, state, zenith, ok, high", "{b}", "raw")
    staged = f"SELECT *, CASE WHEN high THEN raw ELSE 16000 END AS clamped, CASE WHEN ok THEN CASE WHEN high THEN raw ELSE 16000 END END AS masked FROM ({stages})"
    layers = {"b1": ("CQ", 4), "b2": ("CQ", 5)} | {f"b{k}": ("CH", k - 3) for k in range(3, 8)} | {"b31": ("CH", 9)}
    routed = " UNION ALL ".join(
        f"SELECT {T}, day, '{b}' AS band, '{p}' AS product, {layer} AS layer, {b} AS value FROM obs" for b, (p, layer) in layers.items()
    )
    stack = " UNION ALL ".join(
        f"SELECT {T}, (row_number() OVER (PARTITION BY {T} ORDER BY day) - 1)::INT AS pos, day, '{b}' AS band, {value} AS value, {qa} AS qa FROM judged"
        for b in ALL
        for qa, value in (
            ("true", f"CASE WHEN ok THEN CASE WHEN high THEN {b} ELSE 16000 END END"),
            ("false", f"CASE WHEN high THEN {b} ELSE 16000 END"),
        )
    )
    index = "CASE WHEN b1 IS NULL OR b2 IS NULL OR b1 + b2 = 0 THEN 0 ELSE trunc((b2 - b1) / (b2 + b1) * 1000)::INT END"
    wide = ", ".join(f"max({b}::DOUBLE) FILTER (WHERE period = {k}) AS {b}_p{k:02d}" for k in range(12) for b in B8)
    k_means = lambda rank, where: " UNION ALL ".join(_metric(_mean_of(rank, k), where, f", {k} AS k") for k in (3, 6, 8))
    amp = lambda up, down: (
        _metric(VALUES["band_amplitude"][0], IN8, ", false AS ranked")
        + " UNION ALL "
        + _metric(f"max(val) FILTER (WHERE {down} = 1) - max(val) FILTER (WHERE {up} = 1)", IN8, ", true AS ranked")
    )
    out = {
        "granule_catalog": with_(
            GRANULES, f"SELECT product, tile, day, (day // 1000)::INT AS year, (day % 1000)::INT AS doy, '006' AS collection, stamp, path, valid FROM ({NAMES})"
        ),
        "parse_tile_id": with_(
            GRANULES,
            f"""SELECT DISTINCT tile, valid, CASE WHEN valid THEN tile[2:3]::INT END AS h, CASE WHEN valid THEN tile[5:6]::INT END AS v
                FROM (SELECT tile, regexp_matches(tile, '^h[0-9][0-9]v[0-9][0-9]$') AS valid FROM ({NAMES}))""",
        ),
        "season_calendar": with_(
            GRANULES,
            """SELECT y::INT AS season_year, i::INT AS idx, (CASE WHEN i < 19 THEN y * 1000 + 65 + 16 * i ELSE (y + 1) * 1000 + 1 + 16 * (i - 19) END)::INT AS day
               FROM (SELECT DISTINCT yr AS y FROM named), range(23) r(i)""",
        ),
        "latest_granule": with_(
            GRANULES,
            "SELECT product, tile, day, stamp, path FROM named QUALIFY row_number() OVER (PARTITION BY product, tile, day ORDER BY stamp DESC, path DESC) = 1",
        ),
        "pair_granules": with_(
            GRANULES,
            """SELECT tile, day, a.path AS ch_path, b.path AS cq_path
               FROM (SELECT tile, day, max(path) AS path FROM named WHERE product = 'CH' GROUP BY tile, day) a
               JOIN (SELECT tile, day, max(path) AS path FROM named WHERE product = 'CQ' GROUP BY tile, day) b USING (tile, day)""",
        ),
        "discover_tile_years": with_(GRANULES, "SELECT season_year, tile FROM roots"),
        "missing_granules": with_(
            GRANULES,
            """SELECT season_year, tile, day, product FROM wanted, (VALUES ('CH'), ('CQ')) p(product)
               WHERE (tile, day, product) NOT IN (SELECT (tile, day, product) FROM named)""",
        ),
        "incomplete_tiles": with_(
            GRANULES,
            """SELECT season_year, tile, count(both_days.day) AS days FROM wanted LEFT JOIN
               (SELECT tile, day FROM named GROUP BY tile, day HAVING count(DISTINCT product) = 2) both_days USING (tile, day)
               GROUP BY season_year, tile HAVING count(both_days.day) < 23""",
        ),
        "band_long": with_(OBS, routed),
        "day_slice": with_(OBS, f"SELECT {T}, day, {dump_band} AS value FROM obs WHERE day IN ({', '.join(map(str, slice_days))})"),
        "stack_band": with_(OBS, stack),
        "write_read_bands": with_(COMP, f"SELECT {T}, day, {', '.join(ALL)} FROM clean"),
        "write_metrics": with_(
            LONG, f"SELECT {T}, metric, band, coalesce(value, -10001) AS value, description FROM ({_feature_rows()}) JOIN {SAYS} USING (metric)"
        ),
        "reuse_or_compute": with_(
            LONG, f"SELECT {T}, 'band_min' AS metric, band, value, season_year % 2 = 0 AS reused FROM ({_metric(*VALUES['band_min'])})"
        ),
        "reuse_or_compute_bands": with_(
            OBS,
            f"""SELECT {T}, step, band, value, season_year % 2 = 0 OR (season_year % 3 = 0 AND band IN ('b1', 'b2')) AS reused
                FROM ({_unpivot('judged', ALL, f'{T}, day AS step', "(CASE WHEN ok THEN CASE WHEN high THEN {b} ELSE 16000 END END)::DOUBLE", 'value')})""",
        ),
        "reuse_or_compute_band": with_(
            OBS,
            f"""SELECT {T}, day AS step, '{dump_band}' AS band, (CASE WHEN ok THEN CASE WHEN high THEN {dump_band} ELSE 16000 END END)::DOUBLE AS value,
                season_year % 2 = 0 AS reused FROM judged""",
        ),
        "collate_batch": with_(
            OBS,
            """SELECT h, v, season_year, count(DISTINCT day) AS dates, count_if((day % 1000 - 1) % 16 <> 0) AS off_calendar,
               CASE WHEN count(DISTINCT day) < 23 THEN 'incomplete' WHEN season_year % 2 = 0 THEN 'stored' ELSE 'written' END AS status
               FROM obs GROUP BY h, v, season_year""",
        ),
        "write_mask": with_(OBS, f"SELECT {T}, day, CASE WHEN ok THEN 1 ELSE -10001 END AS mask FROM judged"),
        "normalize_nodata": with_(OBS, f"SELECT {T}, day, {', '.join(ALL)}, zenith FROM filled"),
        "zenith_clamp": with_(OBS, f"SELECT {T}, day, band, clamped AS value FROM ({staged})"),
        "qa_bits": with_(
            OBS, f"SELECT {T}, day, state, state & 3 AS cloud, state & 4 AS shadow, state & 8192 AS adjacency, (state & 192) >> 6 AS aerosol FROM obs"
        ),
        "qa_mask": with_(OBS, f"SELECT {T}, day, ok FROM judged"),
        "apply_qa": with_(OBS, f"SELECT {T}, day, band, CASE WHEN ok THEN raw END AS value FROM ({stages})"),
        "missing_to_null": with_(OBS, f"SELECT {T}, day, band, coalesce(raw, -10001) AS stored, raw AS value FROM ({stages})"),
        "ndvi": with_(OBS, f"SELECT {T}, day, {index} AS ndvi FROM filled"),
        "thermal_key": with_(OBS, f"SELECT {T}, day, coalesce(b31, -10001) AS therm FROM filled"),
        "period_map": with_(CALENDAR, "SELECT h, v, season_year, day, period, first_day FROM periods"),
        "composite_mean": with_(COMP, f"SELECT {T}, period, first_day, {', '.join(ALL)} FROM comp"),
        "stored_composites": with_(COMP, f"SELECT {T}, period, first_day, {', '.join(ALL)}, ndvi, therm FROM comp"),
        "composite_ndvi": with_(COMP, f"SELECT {T}, period, ndvi, therm FROM comp"),
        "dense_grid": with_(
            GRID, f"SELECT {T}, day, g.idx AS idx, {', '.join(ALL)}, state, zenith FROM grid g LEFT JOIN obs USING (h, v, season_year, pixel, day)"
        ),
        "unsorted_monthly": with_(COMP, f"SELECT {T}, {wide} FROM comp GROUP BY {T}"),
        "sort_by_self": with_(LONG, f"SELECT {T}, band, (own_up - 1)::INT AS pos, val AS value FROM ranked WHERE {IN8}"),
        "lowest_k_mean": with_(LONG, k_means("own_up", IN7)),
        "greenest_k_mean": with_(LONG, k_means("g_down", IN8)),
        "warmest_k_mean": with_(LONG, k_means("t_down", IN8)),
        "temp_mean_greenest3": with_(
            LONG,
            " UNION ALL ".join(f"SELECT {T}, {k}::INT AS k, {_mean_of('g_down', k)} AS value FROM ranked WHERE band = 'b31' GROUP BY {T}" for k in (1, 3)),
        ),
        "amp_greenest": with_(LONG, amp("g_up", "g_down")),
        "amp_warmest": with_(LONG, amp("t_up", "t_down")),
        "metric_catalog": with_(
            LONG,
            f"""SELECT metric, band, metric || '-' || band AS layer, description, count(*) AS pixels, count(value) AS present
                FROM ({_feature_rows()}) JOIN {SAYS} USING (metric) GROUP BY metric, band, description""",
        ),
        "run_metrics": with_(LONG, _feature_rows()),
        "feature_table": with_(LONG, _wide()),
        "training_table": with_(
            LONG
            + f""",
samples AS (
  SELECT n_nationkey::INT AS h, n_regionkey::INT AS v, y::INT AS season_year, s_suppkey::BIGINT AS pixel, (floor(abs(s_acctbal)) % 101)::INT AS label
  FROM supplier JOIN nation ON s_nationkey = n_nationkey,
       (SELECT unnest(range(min(year(l_shipdate)) - 1, max(year(l_shipdate)) + 1)) AS y FROM lineitem)),
feats AS (SELECT *, true AS matched FROM ({_wide()}))""",
            f"SELECT {T}, label, feats.* EXCLUDE ({T}, matched), coalesce(matched, false) AS matched FROM samples LEFT JOIN feats USING ({T})",
        ),
        "qa_component_counts": with_(
            OBS,
            " UNION ALL ".join(
                f"SELECT day, '{n}' AS component, {e} AS value, count(*) AS pixels FROM obs GROUP BY 1, 2, 3"
                for n, e in (("cloud", "state & 3"), ("shadow", "state & 4"), ("adjacency", "state & 8192"), ("aerosol", "(state & 192) >> 6"))
            ),
        ),
        **dict.fromkeys(("qa_component_layers", "write_dump"), with_(
            OBS,
            f"SELECT {T}, day, state & 3 AS cloud, state & 4 AS shadow, state & 8192 AS adjacency, (((state & 192) >> 6) = 3)::INT AS aerosol FROM obs",
        )),
        "band_day_report": with_(
            OBS,
            f"""SELECT day, band, count_if(raw IS NULL) AS missing_raw, count_if(clamped IS NULL) AS missing_without_qa,
                count_if(masked IS NULL) AS missing_with_qa, count_if(zenith IS NULL) AS missing_zenith,
                count_if(coalesce(state, -10001) = -10001) AS missing_state, count_if(zenith >= 72) AS clamps_expected,
                count_if(clamped = 16000) AS clamps_without_qa, count_if(masked = 16000) AS clamps_with_qa,
                array_to_string(list_sort(list(DISTINCT ok::INT::VARCHAR)), ',') AS mask_values FROM ({staged}) GROUP BY day, band""",
        ),
        "stage_dump": with_(
            COMP,
            f"""SELECT {T}, s.day AS day, period, raw, clamped, masked, ok::INT AS mask, zenith, state, comp.{dump_band} AS composite
                FROM ({staged}) s LEFT JOIN (SELECT h, v, season_year, day, period FROM periods) p USING (h, v, season_year, day)
                LEFT JOIN comp USING (h, v, season_year, pixel, period) WHERE s.day = {dump_day} AND s.band = '{dump_band}'""",
        ),
    }
    for name, (value, where) in VALUES.items():
        if name != "lowest_3_mean":
            out[name] = with_(LONG, _metric(value, where))
    return out
