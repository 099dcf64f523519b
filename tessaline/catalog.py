"""Named queries over the driver's tables, one or more for each operator family, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bindings as B
from .functions import crs, geometry as G, scalars as S
from .operators import composite, extraction, fetch, focal, inference, raster, sampling, scenes, stack, tiles, validation, zones
from .sources.manifests import Grid

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL for its rows."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- scenes ---------------------------------------------------------------------------------------------------------

SEASON_SQL = "CASE WHEN month(ts) BETWEEN 3 AND 5 THEN 'SPR' WHEN month(ts) BETWEEN 6 AND 8 THEN 'SUM' WHEN month(ts) BETWEEN 9 AND 11 THEN 'FAL' END"


@query(f"""WITH {B.SCENES} SELECT item_id, tile_id, ts, cloud_cover, ord FROM scenes
WHERE cloud_cover < 60 AND ((year(ts) IN (1996, 1997) AND month(ts) BETWEEN 6 AND 8) OR (year(ts) = 1998 AND month(ts) BETWEEN 3 AND 5))""")
def sc1_fetch_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scenes.fetch_items(B.scenes(spark, sf_dir), [(1996, "SUM"), (1997, "SUM"), (1998, "SPR")], 60.0)
    return found.select("item_id", "tile_id", "ts", "cloud_cover", "ord")


@query("""SELECT y AS year, s AS season, strftime(make_date(y, m1, 1), '%Y-%m-%d') AS start_date, strftime(make_date(y, m2, d2), '%Y-%m-%d') AS end_date
FROM range(1995, 2002) a(y), (VALUES ('SPR', 3, 5, 31), ('SUM', 6, 8, 31), ('FAL', 9, 11, 30)) b(s, m1, m2, d2)""")
def sc2_season_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = spark.range(1995, 2002).select(F.col("id").alias("year"), F.explode(F.array(*map(F.lit, S.SEASONS))).alias("season"))
    year = F.col("year").cast("int")
    return years.select("year", "season", S.season_start(year, F.col("season")).cast("string").alias("start_date"), S.season_end(year, F.col("season")).cast("string").alias("end_date"))


@query(f"""WITH {B.SCENES}, a AS (SELECT *, coalesce(cloud_cover, 100) AS c, min(ord) OVER (PARTITION BY tile_id) AS tord, count(*) OVER (PARTITION BY tile_id) AS nt,
 row_number() OVER (PARTITION BY tile_id ORDER BY coalesce(cloud_cover, 100), ord) AS rn, count(*) OVER () AS total FROM scenes),
t AS (SELECT tile_id, tord, least(greatest(1, 100 // (2 * (SELECT count(DISTINCT tile_id) FROM scenes))), any_value(nt)) AS take FROM a GROUP BY tile_id, tord),
u AS (SELECT *, coalesce(sum(take) OVER (ORDER BY tord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev FROM t),
b AS (SELECT a.*, rn <= least(take, greatest(100 - prev, 0)) AS p1 FROM a JOIN u USING (tile_id)),
g AS (SELECT *, row_number() OVER (PARTITION BY p1 ORDER BY c, ord) AS gr, sum(CASE WHEN p1 THEN 1 ELSE 0 END) OVER () AS n1 FROM b)
SELECT item_id, tile_id, cloud_cover, ord, row_number() OVER (ORDER BY c, CASE WHEN p1 THEN 0 ELSE 1 END, CASE WHEN p1 THEN tord END, CASE WHEN p1 THEN rn END, ord) AS place
FROM g WHERE p1 OR gr <= 100 - n1""")
def tk1_best_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.best_scenes(B.scenes(spark, sf_dir), 100).withColumn("place", F.col("place").cast("long"))


@query(f"WITH {B.SCENES} SELECT tile_id, count(*) AS n FROM scenes WHERE cloud_cover < 60 GROUP BY tile_id")
def ag13_tile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.tile_counts(B.scenes(spark, sf_dir).where("cloud_cover < 60"))


@query("""SELECT o_custkey AS key, min(o_orderkey) AS ord, arg_min(o_totalprice, o_orderkey) AS price FROM orders GROUP BY o_custkey""")
def st2_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("ord"), F.col("o_totalprice").alias("price"))
    return scenes.deduplicated(rows, "key", "ord")


@query(f"""WITH {B.SCENES}, n AS (SELECT 'S2A_' || CAST(tile_id AS VARCHAR) || '_' || CAST(item_id AS VARCHAR) AS name FROM scenes)
SELECT name, coalesce(nullif(split_part(name, '_', 2), ''), 'unknown') AS tile, 'S2_SPR_' || split_part(name, '_', 2) AS label, CAST(32600 + CAST(split_part(name, '_', 2) AS INT) AS INT) AS epsg,
 translate(name, ' /:', '_--') || '.tif' AS filename FROM n""")
def pj9_scene_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = B.scenes(spark, sf_dir).select(F.concat_ws("_", F.lit("S2A"), F.col("tile_id").cast("string"), F.col("item_id").cast("string")).alias("name"))
    tile = S.tile_of(F.col("name"))
    return n.select("name", tile.alias("tile"), S.band_label(F.lit("SPR"), tile).alias("label"), S.epsg_of(F.concat(F.lit("EPSG:"), (F.lit(32600) + tile.cast("int")).cast("string"))).alias("epsg"), S.safe_filename(F.col("name")).alias("filename"))


@query("""WITH p AS (SELECT o_orderkey AS id, o_custkey % 3 AS priority, o_custkey % 5 AS area, nullif(o_orderpriority, '5-LOW') AS url FROM orders),
q AS (SELECT *, min(priority) OVER (PARTITION BY area) AS best FROM p WHERE url IS NOT NULL)
SELECT area, id, priority, url FROM q WHERE priority = best""")
def sc17_first_nonempty_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.table(spark, sf_dir, "orders")
    products = t.select((F.col("o_custkey") % 5).alias("area"), F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 3).alias("priority"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("url"))
    return fetch.first_nonempty(products, "area").select("area", "id", "priority", "url")


# --- composites -----------------------------------------------------------------------------------------------------

MEDIAN_SQL = f"""{B.OBSERVATIONS}, o AS (SELECT *, {SEASON_SQL} AS season, dn * (1 / 10000.0::DOUBLE) AS refl, NOT (scl IN (3, 8, 9, 10, 11)) AND scl <> 0 AND dn <> 0 AS clear FROM obs),
g AS (SELECT row, col, season, count(*) FILTER (clear) AS n_clear, median(CASE WHEN clear THEN refl END) AS v FROM o WHERE season IS NOT NULL GROUP BY ALL),
k AS (SELECT row, col, season, n_clear, CASE WHEN n_clear >= 3 THEN v END AS value FROM g),
r AS (SELECT season, max(value) > 1.001 OR min(value) < -0.001 AS exceeded FROM k GROUP BY season),
m AS (SELECT row, col, k.season, n_clear, CASE WHEN value IS NULL THEN NULL WHEN exceeded THEN greatest(least(value, 1.0::DOUBLE), 0.0::DOUBLE) ELSE value END AS value FROM k JOIN r ON k.season = r.season)"""


def composite_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite.seasonal_median(B.observations(spark, sf_dir))


@query(f"WITH {MEDIAN_SQL} SELECT row, col, season, n_clear, round(value, 9) AS value FROM m")
def ag1_seasonal_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(composite_of(spark, sf_dir).select("row", "col", "season", "n_clear", "value"), "value")


@query(f"""WITH {B.OBSERVATIONS}, o AS (SELECT *, {SEASON_SQL} AS season, dn * (1 / 10000.0::DOUBLE) AS refl, scl NOT IN (3, 8, 9, 10, 11) AS clear FROM obs)
SELECT row, col, season, count(*) FILTER (clear) AS n_clear, round(CASE WHEN count(*) FILTER (clear) >= 2 THEN median(CASE WHEN clear THEN refl END) END, 9) AS value
FROM o WHERE season IS NOT NULL GROUP BY row, col, season""")
def ag2_lazy_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = composite.seasonal_median(B.observations(spark, sf_dir), min_clear=2, strict=False, clip=False)
    return rounded(out.select("row", "col", "season", "n_clear", "value"), "value")


@query(f"WITH {MEDIAN_SQL} SELECT season, min(n_clear) AS least, round(avg(n_clear), 9) AS mean, max(n_clear) AS most FROM m GROUP BY season")
def ag5_count_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(composite.count_statistics(composite_of(spark, sf_dir), ["season"]), "mean")


@query(f"WITH {MEDIAN_SQL} SELECT season, round(min(value), 9) AS lowest, round(max(value), 9) AS highest, count(value) AS n_valid FROM m GROUP BY season")
def ag6_value_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(composite.value_range(composite_of(spark, sf_dir), ["season"]), "lowest", "highest")


@query(f"WITH {MEDIAN_SQL} SELECT row, col FROM m WHERE value IS NOT NULL GROUP BY row, col HAVING count(DISTINCT season) = 3")
def fi11_complete_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite.complete(composite_of(spark, sf_dir), ["row", "col"], list(S.SEASONS))


@query(f"""WITH {MEDIAN_SQL}, w AS (SELECT row, col, coalesce(max(value) FILTER (season = 'SPR'), -9999) AS a, coalesce(max(value) FILTER (season = 'SUM'), -9999) AS b,
 coalesce(max(value) FILTER (season = 'FAL'), -9999) AS c FROM m GROUP BY row, col) SELECT row, col, round(a, 9) AS spr, round(b, 9) AS sum_, round(c, 9) AS fal FROM w""")
def st3_concatenated_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = composite.concatenated(composite_of(spark, sf_dir), ["row", "col"], list(S.SEASONS))
    return rounded(bands.select("row", "col", *(F.col("bands")[k].alias(n) for k, n in enumerate(["spr", "sum_", "fal"]))), "spr", "sum_", "fal")


@query(f"""WITH {B.OBSERVATIONS}, s AS (SELECT scene % 8 AS scene, row, col, max(CASE WHEN scl IN (3, 8, 9, 10, 11) THEN 1 ELSE 0 END) AS cloudy FROM obs GROUP BY ALL),
a AS (SELECT *, max(cloudy) OVER (PARTITION BY scene, row ORDER BY col RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS c1 FROM s)
SELECT scene, row, col, max(c1) OVER (PARTITION BY scene, col ORDER BY row RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS cloudy FROM a""")
def fo5_dilated_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = B.observations(spark, sf_dir).withColumn("scene", F.col("scene") % 8)
    mask = obs.groupBy("scene", "row", "col").agg(F.max(F.when(S.is_clear(F.col("scl")), 0).otherwise(1)).alias("cloudy"))
    return composite.dilated(mask, 2, ["scene"])


@query(f"""WITH {B.OBSERVATIONS}, t AS (SELECT row, col, scl AS tile_ord, min(nullif(CASE WHEN scl % 3 = 0 THEN NULL ELSE dn END, 0)) AS value FROM obs GROUP BY ALL)
SELECT row, col, arg_min(value, tile_ord) FILTER (value IS NOT NULL) AS value FROM t GROUP BY row, col""")
def st4_mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.observations(spark, sf_dir).groupBy("row", "col", F.col("scl").alias("tile_ord")).agg(F.min(F.when(F.col("scl") % 3 != 0, F.nullif("dn", F.lit(0.0)))).alias("value"))
    return composite.mosaicked(t)


# --- terrain --------------------------------------------------------------------------------------------------------

SLOPE_SQL = """s AS (SELECT row, col, z,
 CASE WHEN lag(col) OVER r IS NULL AND lead(col) OVER r IS NULL THEN 0 WHEN lag(col) OVER r IS NULL THEN lead(z) OVER r - z WHEN lead(col) OVER r IS NULL THEN z - lag(z) OVER r ELSE (lead(z) OVER r - lag(z) OVER r) / 2 END AS gx,
 CASE WHEN lag(row) OVER c IS NULL AND lead(row) OVER c IS NULL THEN 0 WHEN lag(row) OVER c IS NULL THEN lead(z) OVER c - z WHEN lead(row) OVER c IS NULL THEN z - lag(z) OVER c ELSE (lead(z) OVER c - lag(z) OVER c) / 2 END AS gy
 FROM dem WINDOW r AS (PARTITION BY row ORDER BY col), c AS (PARTITION BY col ORDER BY row))"""


def box_sql(radius: int, name: str) -> str:
    """A direct mean over the square, edges replicated: each cell joined to the clamped neighbours."""
    return f"""b{name} AS (SELECT o.row, o.col, avg(n.z) AS mean FROM (SELECT d.row, d.col, greatest(least(d.row + i, e.r1), e.r0) AS rr, greatest(least(d.col + j, e.c1), e.c0) AS cc
 FROM dem d, (SELECT min(row) AS r0, max(row) AS r1, min(col) AS c0, max(col) AS c1 FROM dem) e, range({-radius}, {radius + 1}) x(i), range({-radius}, {radius + 1}) y(j)) o
 JOIN dem n ON n.row = o.rr AND n.col = o.cc GROUP BY o.row, o.col)"""


CLOSING_SQL = """mx AS (SELECT o.row, o.col, max(n.z) AS z FROM dem o JOIN dem n ON abs(n.row - o.row) <= 1 AND abs(n.col - o.col) <= 1 GROUP BY o.row, o.col),
mn AS (SELECT o.row, o.col, min(n.z) AS z FROM mx o JOIN mx n ON abs(n.row - o.row) <= 1 AND abs(n.col - o.col) <= 1 GROUP BY o.row, o.col)"""


@query(f"WITH {B.ELEVATION}, {SLOPE_SQL} SELECT row, col, z, round(degrees(atan(sqrt(gx * gx + gy * gy))), 9) AS slope FROM s")
def fo1_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(focal.slope(B.elevation(spark, sf_dir), 1.0), "slope")


@query(f"WITH {B.ELEVATION}, {box_sql(3, 'm')} SELECT row, col, z, round(mean, 7) AS box_mean FROM dem LEFT JOIN bm USING (row, col)")
def fo2_box_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(focal.box_mean(B.elevation(spark, sf_dir), 3), "box_mean", digits=7)


@query(f"WITH {B.ELEVATION}, {box_sql(2, 'm')} SELECT row, col, z, round(z - mean, 7) AS tpi FROM dem LEFT JOIN bm USING (row, col)")
def fo3_position_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(focal.position_index(B.elevation(spark, sf_dir), 20.0, 10.0), "tpi", digits=7)


@query(f"WITH {B.ELEVATION}, {CLOSING_SQL} SELECT row, col, dem.z AS z, round(CASE WHEN dem.z IS NOT NULL THEN greatest(mn.z - dem.z, 0) END, 9) AS depth FROM dem LEFT JOIN mn USING (row, col)")
def fo4_depression_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(focal.depression_depth(B.elevation(spark, sf_dir)), "depth")


@query(f"""WITH {B.ELEVATION}, {SLOPE_SQL}, {box_sql(1, 's')}, {box_sql(4, 'l')}, {CLOSING_SQL}
SELECT row, col, round(CASE WHEN s.z IS NULL THEN -9999 ELSE coalesce(degrees(atan(sqrt(gx * gx + gy * gy))), -9999) END, 7) AS slope,
 round(coalesce(s.z - bs.mean, -9999), 7) AS tpi_small, round(coalesce(s.z - bl.mean, -9999), 7) AS tpi_large, round(coalesce(CASE WHEN s.z IS NOT NULL THEN greatest(mn.z - s.z, 0) END, -9999), 7) AS depth
FROM s LEFT JOIN bs USING (row, col) LEFT JOIN bl USING (row, col) LEFT JOIN mn USING (row, col)""")
def sk11_terrain_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = focal.terrain_bands(B.elevation(spark, sf_dir), 1.0, 1.0, 4.0)
    names = ["slope", "tpi_small", "tpi_large", "depth"]
    return rounded(bands.select("row", "col", *(F.col("bands")[k].alias(n) for k, n in enumerate(names))), *names, digits=7)


# --- windows, grids and spatial joins ---------------------------------------------------------------------------------


@query("""WITH p AS (SELECT DISTINCT p_size AS size, 1 + p_partkey % 17 AS win, p_partkey % 7 AS ov FROM part),
q AS (SELECT *, CASE WHEN size <= win THEN [0] ELSE list_sort(list_distinct(list_concat(range(0, size - win + 1, greatest(win - ov, 1)), [size - win]))) END AS o FROM p)
SELECT size, win, ov, array_to_string(o, ',') AS starts FROM q""")
def fo7_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = B.table(spark, sf_dir, "part").select(F.col("p_size").alias("size"), (1 + F.col("p_partkey") % 17).alias("win"), (F.col("p_partkey") % 7).alias("ov")).distinct()
    starts = tiles.offsets(F.col("size"), F.col("win").cast("int"), F.col("ov").cast("int"))
    return p.withColumn("starts", F.array_join(F.transform(starts, lambda s: s.cast("string")), ","))


@query(f"""WITH {B.ELEVATION}, h AS (SELECT max(row) + 1 AS h FROM dem), ro AS (SELECT DISTINCT o AS row_off FROM (SELECT unnest(range(0, h - 3, 3)) AS o FROM h UNION ALL SELECT h - 4 FROM h)),
co AS (SELECT DISTINCT o AS col_off FROM (SELECT unnest(range(0, 50 - 8 + 1, 5)) AS o UNION ALL SELECT 42))
SELECT row, col, CAST(row_off AS INT) AS row_off, CAST(col_off AS INT) AS col_off FROM dem, ro, co WHERE row_off <= row AND row < row_off + 4 AND col_off <= col AND col < col_off + 8""")
def fo8_window_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells in all windows that hold them, along both axes: 4 rows that advance by 3, then 8 columns that advance by 5."""
    dem = B.elevation(spark, sf_dir)
    height = dem.agg(F.max("row")).first()[0] + 1
    out = dem.withColumn("row_off", F.explode(tiles.holding(F.col("row"), height, 4, 1))).withColumn("col_off", F.explode(tiles.holding(F.col("col"), B.GRID_COLUMNS, 8, 3)))
    return out.select("row", "col", "row_off", "col_off")


@query(f"WITH {B.GRID} SELECT id, minx, miny, maxx, maxy FROM grid")
def fo10_metre_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_of(spark)


def grid_of(spark: SparkSession) -> DataFrame:
    low, high = B.EXTENT
    bounds = spark.range(1).select(*(F.lit(float(v)).alias(n) for n, v in (("minx", low), ("miny", low), ("maxx", high), ("maxy", high))))
    return tiles.metre_grid(bounds, 512.0)


@query("SELECT CAST(r AS INT) AS row_off, CAST(c AS INT) AS col_off, CAST(least(512, 5000 - r) AS INT) AS h, CAST(least(512, 3300 - c) AS INT) AS w FROM range(0, 5000, 512) a(r), range(0, 3300, 512) b(c)")
def fo11_chunk_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.chunks(spark, 5000, 3300, 512)


TOUCH = "a.minx <= b.maxx AND a.maxx >= b.minx AND a.miny <= b.maxy AND a.maxy >= b.miny"
NEAR = "sqrt(pow(greatest(0, a.minx - b.maxx, b.minx - a.maxx), 2) + pow(greatest(0, a.miny - b.maxy, b.miny - a.maxy), 2)) < 100"
INNER = "a.minx < b.maxx AND a.maxx > b.minx AND a.miny < b.maxy AND a.maxy > b.miny"


@query(f"WITH {B.GRID}, {B.LABEL_BOXES} SELECT id, minx, miny, maxx, maxy FROM grid a WHERE EXISTS (SELECT 1 FROM lab b WHERE {TOUCH})")
def jo1_tiles_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.semi(grid_of(spark), B.label_boxes(spark, sf_dir)).select("id", "minx", "miny", "maxx", "maxy")


@query(f"WITH {B.GRID}, {B.LABEL_BOXES} SELECT id, minx, miny, maxx, maxy FROM grid a WHERE NOT EXISTS (SELECT 1 FROM lab b WHERE {TOUCH})")
def jo2_tiles_without_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.anti(grid_of(spark), B.label_boxes(spark, sf_dir)).select("id", "minx", "miny", "maxx", "maxy")


SAFE_SQL = f"NOT EXISTS (SELECT 1 FROM lab b WHERE {NEAR}) AND NOT EXISTS (SELECT 1 FROM inv b WHERE {INNER})"


@query(f"WITH {B.GRID}, {B.LABEL_BOXES}, {B.INVENTORY_BOXES} SELECT id FROM grid a WHERE {SAFE_SQL}")
def jo3_safe_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.safe(grid_of(spark), B.label_boxes(spark, sf_dir), B.inventory_boxes(spark, sf_dir), 100.0).select("id")


@query(f"WITH {B.LABEL_BOXES}, {B.INVENTORY_BOXES} SELECT id FROM inv a WHERE EXISTS (SELECT 1 FROM lab b WHERE {TOUCH})")
def jo4_footprints_on_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.semi(B.inventory_boxes(spark, sf_dir), B.label_boxes(spark, sf_dir)).select("id")


@query(f"WITH {B.GRID}, {B.LABEL_BOXES} SELECT a.id AS id, min(b.id) AS manifest_ord FROM grid a JOIN lab b ON {TOUCH} GROUP BY a.id")
def jo5_first_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.first_match(grid_of(spark), B.label_boxes(spark, sf_dir).withColumn("ord", F.col("id")))


@query("""WITH t AS (SELECT doc_id, lang FROM documents), l AS (SELECT doc_id, quality FROM labels) SELECT t.doc_id AS doc_id, lang, coalesce(quality, -1) AS quality, quality IS NOT NULL AS paired FROM t LEFT JOIN l ON t.doc_id = l.doc_id""")
def jo9_paired_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return fetch.paired(t, B.table(spark, sf_dir, "labels"), "doc_id", "quality", -1).select("doc_id", "lang", "quality", "paired")


@query("SELECT r_name AS area, s AS season FROM region, (VALUES ('SPR'), ('SUM'), ('FAL')) v(s)")
def jo11_area_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.area_seasons(B.table(spark, sf_dir, "region").select(F.col("r_name").alias("area")), list(S.SEASONS))


@query(f"""WITH {B.GRID}, {B.LABEL_BOXES}, {B.INVENTORY_BOXES}, l AS (SELECT a.id AS id, count(*) AS n FROM grid a JOIN lab b ON {TOUCH} GROUP BY a.id),
i AS (SELECT a.id AS id, count(*) AS n FROM grid a JOIN inv b ON {TOUCH} GROUP BY a.id)
SELECT grid.id AS id, coalesce(l.n, 0) AS n_labels, coalesce(i.n, 0) AS n_inventory FROM grid LEFT JOIN l ON l.id = grid.id LEFT JOIN i ON i.id = grid.id""")
def jo12_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density(spark, sf_dir)


def density(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = grid_of(spark)
    out = grid.select("id").join(tiles.match_counts(grid, B.label_boxes(spark, sf_dir), "n_labels"), "id", "left")
    out = out.join(tiles.match_counts(grid, B.inventory_boxes(spark, sf_dir), "n_inventory"), "id", "left")
    return out.select("id", F.coalesce("n_labels", F.lit(0)).alias("n_labels"), F.coalesce("n_inventory", F.lit(0)).alias("n_inventory"))


@query(f"""WITH {B.GRID}, {B.LABEL_BOXES}, {B.INVENTORY_BOXES}, l AS (SELECT a.id AS id, count(*) AS n_labels FROM grid a JOIN lab b ON {TOUCH} GROUP BY a.id),
i AS (SELECT a.id AS id, count(*) AS n_inventory FROM grid a JOIN inv b ON {TOUCH} GROUP BY a.id)
SELECT l.id AS id, n_labels, n_inventory FROM l JOIN i ON l.id = i.id WHERE n_labels >= 1 AND n_inventory > n_labels AND n_inventory / n_labels > 1.5 ORDER BY n_inventory DESC, l.id LIMIT 1""")
def tk6_challenge_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.best_area(density(spark, sf_dir), 1)


@query(f"""WITH {B.GRID}, {B.LABEL_BOXES}, {B.INVENTORY_BOXES}, c AS (SELECT id, minx + 256 AS minx, minx + 256 AS maxx, miny + 256 AS miny, miny + 256 AS maxy FROM grid)
SELECT id FROM c a WHERE {SAFE_SQL} AND id NOT IN (SELECT a.id FROM grid a WHERE {SAFE_SQL})""")
def jo13_edge_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid, labels, inventory = grid_of(spark), B.label_boxes(spark, sf_dir), B.inventory_boxes(spark, sf_dir)
    x, y = F.col("minx") + 256, F.col("miny") + 256
    centres = grid.select("id", x.alias("minx"), x.alias("maxx"), y.alias("miny"), y.alias("maxy"))
    return tiles.safe(centres, labels, inventory, 100.0).join(tiles.safe(grid, labels, inventory, 100.0), "id", "left_anti").select("id")


@query(f"WITH {B.LABEL_BOXES} SELECT min(minx) - 1000 AS minx, min(miny) - 1000 AS miny, max(maxx) + 1000 AS maxx, max(maxy) + 1000 AS maxy FROM lab")
def ge4_acquisition_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.grown(G.total_bounds(B.label_boxes(spark, sf_dir)), 1000.0)


@query(f"""WITH {B.LABEL_BOXES}, p AS (SELECT c_custkey AS id, c_acctbal AS x, CAST((c_custkey * 7919) % 10000 AS DOUBLE) AS y FROM customer)
SELECT id, x, y, CASE WHEN EXISTS (SELECT 1 FROM lab WHERE x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy) THEN 1 ELSE 0 END AS burned FROM p""")
def ge7_rasterised_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"), ((F.col("c_custkey") * 7919) % 10000).cast("double").alias("y"))
    return tiles.burned(p, B.label_boxes(spark, sf_dir))


@query(f"""WITH {B.LABEL_BOXES} SELECT a.id AS id, b.id AS other, round((least(a.maxx, b.maxx) - greatest(a.minx, b.minx)) * (least(a.maxy, b.maxy) - greatest(a.miny, b.miny)), 6) AS area
FROM lab a JOIN lab b ON a.id < b.id AND {TOUCH}""")
def ge6_clipped_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = B.label_boxes(spark, sf_dir)
    box = G.clipped_box("a", "b")
    area = (box["maxx"] - box["minx"]) * (box["maxy"] - box["miny"])
    return tiles.pairs(labels, labels, G.overlaps("a", "b") & (F.col("a.id") < F.col("b.id"))).select(F.col("a.id").alias("id"), F.col("b.id").alias("other"), F.round(area, 6).alias("area")).distinct()


@query(f"""WITH {B.LABEL_BOXES} SELECT id, round((maxx - minx) * (maxy - miny) / 2, 6) AS area, abs((minx + maxx) / 2 - 3000) + abs((miny + maxy) / 2 - 4000) < 2500.5 AS inside FROM lab""")
def ge11_ring_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of rings that are no boxes, and whether their middles lie in a large one."""
    area = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((3000, 1499.5), (5500.5, 4000), (3000, 6500.5), (499.5, 4000))))
    x, y = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2
    return B.diamonds(spark, sf_dir).select("id", F.round(G.ring_area(F.col("ring")), 6).alias("area"), G.in_ring(x, y, area).alias("inside"))


DIAMOND = "(lab.maxx - lab.minx) / 2"


@query(f"""WITH {B.GRID}, {B.LABEL_BOXES} SELECT DISTINCT grid.id AS id FROM grid JOIN lab ON greatest(0, grid.minx - (lab.minx + lab.maxx) / 2, (lab.minx + lab.maxx) / 2 - grid.maxx)
 + greatest(0, grid.miny - (lab.miny + lab.maxy) / 2, (lab.miny + lab.maxy) / 2 - grid.maxy) <= {DIAMOND}""")
def jo4_tiles_on_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles that rings touch, not only their boxes."""
    return tiles.semi(grid_of(spark), B.diamonds(spark, sf_dir)).select("id")


ALBERS = {"n": crs._N, "c": crs._C, "rho0": crs._RHO0, "e": crs.E, "e2": crs.E2, "a": crs.A, "lon0": crs.LON0}


@query("""WITH p AS (SELECT c_custkey AS id, -125 + (c_custkey % 580) / 10.0::DOUBLE AS lon, 25 + (c_custkey % 240) / 10.0::DOUBLE AS lat FROM customer),
q AS (SELECT *, sin(radians(lat)) AS s FROM p),
r AS (SELECT *, (1 - {e2}) * (s / (1 - {e2} * s * s) - ln((1 - {e} * s) / (1 + {e} * s)) / (2 * {e})) AS qq FROM q),
t AS (SELECT *, {a} * sqrt({c} - {n} * qq) / {n} AS rho, {n} * (radians(lon) - ({lon0})) AS theta FROM r)
SELECT id, round(lon, 6) AS lon, round(lat, 6) AS lat, round(rho * sin(theta), 4) AS x, round({rho0} - rho * cos(theta), 4) AS y FROM t""".format(**{k: f"CAST({v!r} AS DOUBLE)" for k, v in ALBERS.items()}))
def ge10_albers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward projection; lon and lat are those that the inverse gives back."""
    k = F.col("c_custkey")
    p = B.table(spark, sf_dir, "customer").select(k.alias("id"), (-125 + (k % 580) / 10.0).alias("lon"), (25 + (k % 240) / 10.0).alias("lat"))
    x, y = crs.to_albers(F.col("lon"), F.col("lat"))
    p = p.withColumns({"x": x, "y": y})
    lon, lat = crs.from_albers(F.col("x"), F.col("y"))
    return p.select("id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"), F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


# --- stacks -----------------------------------------------------------------------------------------------------------


@query(f"""WITH {B.STACK}, {B.ELEVATION}, w AS (SELECT CAST(r AS INT) AS row, CAST(c AS INT) AS col FROM range(2, 14) a(r), range(20, 32) b(c))
SELECT w.row AS row, w.col AS col, round(coalesce(bands[1], -9999), 6) AS b1, round(coalesce(bands[29], -9999), 6) AS b29, coalesce(z, -9999) AS z
FROM w LEFT JOIN stack ON w.row = stack.row AND w.col = stack.col LEFT JOIN dem ON w.row = dem.row AND w.col = dem.col""")
def sc14_read_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    surface = B.elevation(spark, sf_dir).select("row", "col", F.array(F.coalesce("z", F.lit(S.NODATA))).alias("bands"))
    out = stack.read_window(spark, [(B.stack(spark, sf_dir), 29), (surface, 1)], 2, 20, 12, 12)
    return out.select("row", "col", F.round(F.col("bands")[0], 6).alias("b1"), F.round(F.col("bands")[28], 6).alias("b29"), F.col("bands")[29].alias("z"))


@query(f"""WITH {B.STACK}, {B.ELEVATION}, c AS (SELECT row, col FROM stack UNION SELECT row, col FROM dem)
SELECT c.row AS row, c.col AS col, round(coalesce(bands[3], -9999), 6) AS b3, coalesce(z, -9999) AS z FROM c LEFT JOIN stack ON c.row = stack.row AND c.col = stack.col LEFT JOIN dem ON c.row = dem.row AND c.col = dem.col""")
def jo7_aligned_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    surface = B.elevation(spark, sf_dir).select("row", "col", F.array(F.coalesce("z", F.lit(S.NODATA))).alias("bands"))
    out = stack.aligned([(B.stack(spark, sf_dir), 29), (surface, 1)])
    return out.select("row", "col", F.round(F.col("bands")[2], 6).alias("b3"), F.col("bands")[29].alias("z"))


@query(f"""WITH {B.STACK} SELECT row, col, round(CASE WHEN bands[1] = -9999 THEN bands[1] ELSE (bands[1] + 0.5) / 1.5 END, 6) AS own_range, round((bands[2] + 0.25) / 0.75, 6) AS source_range, round(bands[3] / 0.5, 6) AS by_max, round(bands[4], 6) AS unscaled FROM stack""")
def pj3_source_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("double")
    b = F.col("bands")
    cases = {
        "own_range": S.source_scaled(b[0], F.lit(-0.5), F.lit(1.0), F.lit(7.0), none),
        "source_range": S.source_scaled(b[1], none, none, F.lit(0.5), F.lit(-0.25)),
        "by_max": S.source_scaled(b[2], none, none, F.lit(0.5), none),
        "unscaled": S.source_scaled(b[3], none, none, none, none),
    }
    return B.stack(spark, sf_dir).select("row", "col", *(F.round(c, 6).alias(n) for n, c in cases.items()))


@query(f"""WITH {B.STACK}, n AS (SELECT row, col, list_transform(bands, lambda v: greatest(0.0::DOUBLE, least(1.0::DOUBLE, v * 2))) AS b FROM stack)
SELECT row, col, round(list_sum(b), 6) AS total, CAST(trunc(b[1] * 255) AS INT) AS byte1, round(CAST(trunc(b[1] * 255) AS INT) / 255.0::DOUBLE, 9) AS back1 FROM n""")
def pj4_normalised_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = B.stack(spark, sf_dir).withColumn("b", F.transform("bands", lambda v: S.normalised(v * 2)))
    byte = S.to_byte(F.col("b")[0])
    return n.select("row", "col", F.round(F.aggregate("b", F.lit(0.0), lambda a, v: a + v), 6).alias("total"), byte.alias("byte1"), F.round(S.from_byte(byte), 9).alias("back1"))


@query(f"""WITH {B.STACK} SELECT row, col, 32 AS n, round(greatest(0, least(1, bands[29])) / 255, 9) AS last_band, 0.0::DOUBLE AS padded FROM stack""")
def pj7_prepared_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = B.stack(spark, sf_dir).withColumn("p", S.prepared(F.col("bands"), 32, byte_scale=True))
    return out.select("row", "col", F.size("p").alias("n"), F.round(F.col("p")[28], 9).alias("last_band"), F.col("p")[31].alias("padded"))


@query(f"""WITH {B.STACK}, e AS (SELECT row, col, exp(logits[1] - greatest(logits[1], logits[2])) AS a, exp(logits[2] - greatest(logits[1], logits[2])) AS b FROM stack)
SELECT row, col, round(a / (a + b), 9) AS p0, round(b / (a + b), 9) AS p1, CASE WHEN b > a THEN 1 ELSE 0 END AS likeliest, CASE WHEN b / (a + b) >= 0.55 THEN 1 ELSE 0 END AS over FROM e""")
def pj8_softmax_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = B.stack(spark, sf_dir).withColumn("p", S.softmax(F.col("logits")))
    return out.select("row", "col", F.round(F.col("p")[0], 9).alias("p0"), F.round(F.col("p")[1], 9).alias("p1"), S.class_of(F.col("p")).alias("likeliest"), S.class_of(F.col("p"), 0.55).alias("over"))


@query(f"""WITH {B.STACK}, b AS (SELECT row, col, list_transform(bands, lambda v: CASE WHEN v < 0 THEN -9999.0::DOUBLE ELSE v END) AS b FROM stack)
SELECT row, col, len(list_filter(b[1:4], lambda v: v <> -9999)) > 0 AS any_of_first, len(list_filter(b, lambda v: v = -9999)) = 0 AS all_bands FROM b""")
def fi7_valid_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.transform("bands", lambda v: F.when(v < 0, S.NODATA).otherwise(v))
    return B.stack(spark, sf_dir).select("row", "col", S.is_valid_pixel(b, S.NODATA, 4).alias("any_of_first"), S.is_valid_pixel(b, S.NODATA).alias("all_bands"))


TARGETS = "t AS (SELECT p_partkey AS id, (p_partkey // 50) * 0.8::DOUBLE + 0.3::DOUBLE AS y, (p_partkey % 50) * 0.9::DOUBLE + 0.15::DOUBLE AS x FROM part)"


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return B.table(spark, sf_dir, "part").select(k.alias("id"), (F.floor(k / 50) * 0.8 + 0.3).alias("y"), ((k % 50) * 0.9 + 0.15).alias("x"))


@query(f"""WITH {B.ELEVATION}, {TARGETS}, c AS (SELECT id, CAST(floor(y) AS INT) + dr AS row, CAST(floor(x) AS INT) + dc AS col,
 (CASE WHEN dr = 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) * (CASE WHEN dc = 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) AS w FROM t, range(2) a(dr), range(2) b(dc))
SELECT id, round(sum(z * w) / sum(CASE WHEN z IS NOT NULL THEN w END), 7) AS value FROM c LEFT JOIN dem ON dem.row = c.row AND dem.col = c.col WHERE w > 0 GROUP BY id""")
def rs1_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stack.bilinear(B.elevation(spark, sf_dir), targets(spark, sf_dir)), "value", digits=7)


@query(f"WITH {B.ELEVATION}, {TARGETS} SELECT id, z AS value FROM t LEFT JOIN dem ON dem.row = CAST(floor(y + 0.5) AS INT) AND dem.col = CAST(floor(x + 0.5) AS INT)")
def rs2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stack.nearest(B.elevation(spark, sf_dir), targets(spark, sf_dir))


@query("SELECT count(DISTINCT p_brand) <= 1 AS same_crs, max(p_size) - min(p_size) <= 1e-6 AS same_res, count(DISTINCT p_partkey % 2) <= 1 AS same_bands FROM part")
def ag16_uniform_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stack.uniform(B.table(spark, sf_dir, "part").select(F.col("p_brand").alias("crs"), F.col("p_size").alias("res"), (F.col("p_partkey") % 2).alias("bands")))


# --- sampling ---------------------------------------------------------------------------------------------------------


@query(f"""WITH {B.GRID}, {B.LABEL_BOXES}, {B.INVENTORY_BOXES}, p AS (SELECT id FROM grid a WHERE EXISTS (SELECT 1 FROM lab b WHERE {TOUCH})),
c AS (SELECT id FROM grid a WHERE id NOT IN (SELECT id FROM p) AND {SAFE_SQL}),
d AS (SELECT id FROM c QUALIFY row_number() OVER (ORDER BY (id * 2654435761 + 42) % 4294967296, id) <= (SELECT CAST(floor(count(*) * 0.5) AS BIGINT) FROM p)),
l AS (SELECT id, 1 AS class_label FROM p UNION ALL SELECT id, 0 FROM d)
SELECT grid.id AS id, minx, miny, maxx, maxy, class_label FROM grid JOIN l ON l.id = grid.id""")
def ud7_training_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.training_manifest(grid_of(spark), B.label_boxes(spark, sf_dir), B.inventory_boxes(spark, sf_dir), 100.0, 0.5)


BALANCED_SQL = """p AS (SELECT doc_id AS id FROM labels WHERE quality = 0), c AS (SELECT doc_id AS id FROM labels WHERE quality = 1 AND toxic = 0),
d AS (SELECT id FROM c QUALIFY row_number() OVER (ORDER BY (id * 2654435761 + 42) % 4294967296, id) <= (SELECT 2 * count(*) FROM p))"""


def label_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = B.table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    return t.where("quality = 0").select("id"), t.where("quality = 1 and toxic = 0").select("id")


@query(f"WITH {BALANCED_SQL} SELECT id, 1 AS class_label FROM p UNION ALL SELECT id, 0 FROM d")
def ud8_balanced_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.balanced(*label_parts(spark, sf_dir), 2.0)


@query(f"WITH {BALANCED_SQL} SELECT (SELECT count(*) FROM p) AS num_pos, (SELECT count(*) FROM d) AS num_neg, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT id FROM p UNION SELECT id FROM d)) AS num_removed")
def ag14_sampling_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    positives, candidates = label_parts(spark, sf_dir)
    chosen = sampling.balanced(positives, candidates, 2.0)
    universe = B.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return sampling.sampling_totals(positives, chosen.where("class_label = 0").select("id"), universe)


@query("""WITH t AS (SELECT p_brand AS tile, avg(CASE WHEN p_size % 2 > 0 THEN 1.0::DOUBLE ELSE 0 END) AS cover FROM part GROUP BY p_brand ORDER BY tile LIMIT 256)
SELECT round(avg(CASE WHEN cover >= 0.999 THEN 1.0::DOUBLE ELSE 0 END), 9) AS all_one, round(avg(CASE WHEN cover > 0 THEN cover END), 9) AS mean_cover, count(*) AS n FROM t""")
def ag9_label_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = B.table(spark, sf_dir, "part").select(F.col("p_brand").alias("tile"), (F.col("p_size") % 2).alias("v"))
    return rounded(sampling.label_cover(pixels), "all_one", "mean_cover")


# --- inference --------------------------------------------------------------------------------------------------------

HEIGHT_SQL = "(SELECT max(row) + 1 FROM stack)"


def windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 10 with an overlap of 4 over the stack; logits shift with the window, so that averaging matters."""
    pixels = B.stack(spark, sf_dir)
    height = pixels.agg(F.max("row")).first()[0] + 1
    scorer = lambda p: F.transform("logits", lambda v, i: v + F.when(i == 1, F.col("row_off") * 0.01 - F.col("col_off") * 0.005).otherwise(0.0))
    return inference.window_scores(pixels, height, B.STACK_COLUMNS, 10, 4, scorer)


WINDOWED_SQL = f"""{B.STACK}, ro AS (SELECT DISTINCT least(CAST(o AS INT), greatest({HEIGHT_SQL} - 10, 0)) AS ro FROM range(0, 100000, 6) x(o) WHERE o < {HEIGHT_SQL} + 6 AND o - 6 <= {HEIGHT_SQL} - 10),
co AS (SELECT unnest([0, 6, 12, 15]) AS co),
s AS (SELECT row, col, ro, co, logits[1] AS a, logits[2] + (ro * 0.01::DOUBLE - co * 0.005::DOUBLE) AS b FROM stack, ro, co WHERE ro <= row AND row < ro + 10 AND co <= col AND col < co + 10),
p AS (SELECT row, col, exp(b - greatest(a, b)) / (exp(a - greatest(a, b)) + exp(b - greatest(a, b))) AS p1 FROM s),
m AS (SELECT row, col, count(*) AS n, sum(p1) / count(*) AS p1 FROM p GROUP BY row, col)"""


@query(f"WITH {WINDOWED_SQL} SELECT row, col, n, round(1 - p1, 7) AS p0, round(p1, 7) AS p1 FROM m")
def ag7_overlap_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = inference.averaged(windowed(spark, sf_dir))
    return mean.select("row", "col", "n", F.round(F.col("probabilities")[0], 7).alias("p0"), F.round(F.col("probabilities")[1], 7).alias("p1"))


@query(f"WITH {WINDOWED_SQL} SELECT row, col, CASE WHEN p1 >= 0.5 AND row % 7 <> 0 THEN 1 ELSE 0 END AS class_id FROM m")
def ag8_final_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = inference.averaged(windowed(spark, sf_dir))
    return inference.finalised(mean, F.col("row") % 7 != 0, 0.5).select("row", "col", "class_id")


@query(f"""WITH RECURSIVE {B.STACK}, c AS (SELECT row, col, CAST(row AS BIGINT) * 25 + col AS cell FROM stack WHERE label % 2 = 0),
r(cell, row, col, region) AS (SELECT cell, row, col, cell FROM c UNION SELECT d.cell, d.row, d.col, r.region FROM r JOIN c d ON abs(d.row - r.row) + abs(d.col - r.col) = 1),
l AS (SELECT row, col, min(region) AS region FROM r GROUP BY row, col)
SELECT region, count(*) AS area, min(row) AS row_min, min(col) AS col_min, max(row) AS row_max, max(col) AS col_max FROM l GROUP BY region HAVING count(*) >= 2""")
def ag11_mask_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = B.stack(spark, sf_dir).where("label % 2 = 0").select("row", "col")
    return inference.region_boxes(inference.regions(mask, B.STACK_COLUMNS), 2)


# --- report and scalars -------------------------------------------------------------------------------------------------


@query(f"""WITH {MEDIAN_SQL}, px AS (SELECT 'ul' AS pixel_name, 0 AS row, 0 AS col, -85.0::DOUBLE AS lon, 42.0::DOUBLE AS lat UNION ALL SELECT 'ur', 0, 49, -84.0, 42.0),
q AS (SELECT * FROM o WHERE season = 'SUM'), b AS (SELECT px.*, m.value AS median_value FROM px LEFT JOIN m ON m.row = px.row AND m.col = px.col AND m.season = 'SUM')
SELECT 's2_sum' AS season_raster, 'SUM' AS season_label, '1996,1997' AS years, pixel_name, 'B08' AS band, 'S2_SUM_B08' AS band_label, 'observation' AS source_type, CAST(scene AS VARCHAR) AS item_id,
 strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS observation_datetime, 'nir' AS asset_id, CASE WHEN abs(dn) <= 1e-8 THEN NULL ELSE dn END AS raw_value, round(CASE WHEN abs(dn) <= 1e-8 THEN NULL ELSE dn * (1 / 10000.0::DOUBLE) END, 9) AS scaled_value,
 round(median_value, 9) AS median_value, lon, lat, b.row AS row, b.col AS col FROM b JOIN q ON q.row = b.row AND q.col = b.col
UNION ALL SELECT 's2_sum', 'SUM', '1996,1997', pixel_name, 'B08', 'S2_SUM_B08', 'median', NULL, NULL, 'nir', NULL, round(median_value, 9), round(median_value, 9), lon, lat, row, col FROM b""")
def ud12_pixel_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = spark.range(2).select(
        F.when(F.col("id") == 0, "ul").otherwise("ur").alias("pixel_name"), F.lit(0).alias("row"), F.when(F.col("id") == 0, 0).otherwise(49).alias("col"), (F.col("id") - 85.0).alias("lon"), F.lit(42.0).alias("lat")
    )
    obs = B.observations(spark, sf_dir).where(S.season_of(F.col("ts")) == "SUM").select("row", "col", F.col("scene").alias("item_id"), "ts", F.col("dn").alias("raw"), F.lit(0.0).alias("nodata"))
    out = validation.report(pixels, obs, composite_of(spark, sf_dir).where("season = 'SUM'"), "SUM", [1996, 1997], "B08", "nir")
    return rounded(out, "scaled_value", "median_value")


@query("""WITH e AS (SELECT event_id, ts, CAST(json_extract(props, '$.k') AS INT) AS k, event_type, value FROM events)
SELECT event_id, event_type, k, round(CASE WHEN k = 7 THEN NULL ELSE value * (1 / 10000.0::DOUBLE) END, 9) AS scaled, strftime(ts, '%Y-%m-%d') AS day FROM e""")
def pj19_json_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = B.table(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k int")["k"])
    return e.select("event_id", "event_type", "k", F.round(S.sampled(F.col("value"), F.when(F.col("k") == 7, F.col("value"))), 9).alias("scaled"), F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query("""WITH b AS (SELECT c_custkey AS id, -85.0::DOUBLE AS minx, 41.0::DOUBLE AS miny, -85 + 0.001::DOUBLE * (1 + c_custkey % 900) AS maxx, 41 + 0.002::DOUBLE * (1 + c_custkey % 700) AS maxy FROM customer),
p AS (SELECT *, floor(greatest(floor((maxx - minx) * 111320 * cos(radians((miny + maxy) / 2)) / 10), floor((maxy - miny) * 111320 / 10)) / 4) AS q FROM b)
SELECT id, CAST(CASE WHEN q <= 0 THEN 256 ELSE greatest(256, least(1024, pow(2, round_even(log2(q), 0)))) END AS INT) AS chunk FROM p""")
def pj13_chunk_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    size = S.chunk_size(F.lit(-85.0), F.lit(41.0), F.lit(-85.0) + 0.001 * (1 + k % 900), F.lit(41.0) + 0.002 * (1 + k % 700))
    return B.table(spark, sf_dir, "customer").select(k.alias("id"), size.alias("chunk"))


@query("""WITH s AS (SELECT p_partkey AS id, p_size AS p, p_partkey % 6 AS k, CASE p_partkey % 6 WHEN 0 THEN p_size * 700 WHEN 1 THEN p_size * 3 ELSE p_size * 90 END AS s FROM part)
SELECT id, CASE WHEN k > 2 THEN printf('%d.0', p) || ['ms', 'us', 'ns'][k - 2] WHEN s >= 3600 THEN printf('%dh%02dm', s // 3600, s % 3600 // 60) WHEN s >= 60 THEN printf('%dm%02ds', s // 60, s % 60) ELSE printf('%d.0s', s) END AS shown FROM s""")
def pj17_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size").cast("double")
    seconds = F.when(k % 6 == 0, size * 700).when(k % 6 == 1, size * 3).when(k % 6 == 2, size * 90)
    for n, unit in ((3, 1e3), (4, 1e6), (5, 1e9)):
        seconds = seconds.when(k % 6 == n, size / unit)
    return B.table(spark, sf_dir, "part").select(k.alias("id"), S.duration(seconds).alias("shown"))


@query("""WITH t AS (SELECT p_partkey AS id, p_size AS a, p_size + 1 AS b, p_partkey % 4 AS k FROM part)
SELECT id, a AS height, CASE WHEN k = 3 THEN a ELSE b END AS width, k IN (0, 1) AS flag FROM t""")
def pj15_parsed_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, k = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    b = (F.col("p_size") + 1).cast("string")
    text = F.when(k == 0, F.concat(a, F.lit(" by "), b)).when(k == 1, F.concat(a, F.lit("x"), b)).when(k == 2, F.concat(F.lit(" "), a, F.lit(", "), b)).otherwise(a)
    flag = F.when(k == 0, " Yes").when(k == 1, "TRUE").when(k == 2, "no").otherwise("")
    size = S.target_size(text)
    return B.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), size[0].alias("height"), size[1].alias("width"), S.is_true(flag).alias("flag"))


@query("""WITH t AS (SELECT p_partkey AS id, 1 + (p_partkey % 40) / 2.0::DOUBLE AS s FROM part), o AS (SELECT unnest([2, 4, 8, 16]) AS v)
SELECT id, CAST(arg_min(v, abs(v - s) * 1000 + v / 1000.0::DOUBLE) AS INT) AS overview FROM t, o GROUP BY id""")
def tk8_nearest_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return B.table(spark, sf_dir, "part").select(k.alias("id"), S.nearest_overview(F.array(*map(F.lit, (2, 4, 8, 16))), 1 + (k % 40) / 2.0).alias("overview"))


# --- scans, sets and the rest of the report -----------------------------------------------------------------------------


SCENE_BOXES_SQL = "w AS (SELECT o_orderkey AS item_id, (o_custkey % 100) * 50.0::DOUBLE AS x, o_totalprice AS dn, o_orderstatus AS s FROM orders)"


def scene_items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Items with boxes and assets, and their readings."""
    t = B.table(spark, sf_dir, "orders")
    x = (F.col("o_custkey") % 100) * 50.0
    name = F.when(F.col("o_orderstatus") != "P", "nir").otherwise("red")
    key = F.col("o_orderkey")
    items = t.select(key.alias("item_id"), key.alias("time_index"), x.alias("minx"), (x + 400).alias("maxx"), F.lit(0.0).alias("miny"), F.lit(400.0).alias("maxy"), F.create_map(name, F.lit("u")).alias("assets"))
    readings = t.select(key.alias("item_id"), F.lit(0).alias("row"), (F.col("o_custkey") % 50).cast("int").alias("col"), F.create_map(name, F.col("o_totalprice")).alias("dn"))
    return items, readings


@query(f"""WITH {SCENE_BOXES_SQL} SELECT item_id, x < 2500 AND x + 400 > 1000 AND s <> 'P' AS success, CASE WHEN NOT (x < 2500 AND x + 400 > 1000) THEN 'no overlap' WHEN s = 'P' THEN 'asset missing' END AS error FROM w""")
def sc5_fetch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per scene of a chunk: a failure is a record with its reason, not an error."""
    return fetch.fetched(scene_items(spark, sf_dir)[0], (1000, 100, 2500, 300), ["nir"]).select("item_id", "success", "error")


@query(f"""WITH {SCENE_BOXES_SQL} SELECT item_id, item_id AS time_index, CAST(o_custkey % 50 AS INT) AS col, round(dn * (1 / 10000.0::DOUBLE), 9) AS nir FROM w JOIN orders ON o_orderkey = item_id WHERE x < 2500 AND x + 400 > 1000 AND s <> 'P'""")
def sc6_fetched_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings of all scenes of a chunk that could be read, with their place in time."""
    items, readings = scene_items(spark, sf_dir)
    values = fetch.fetched_values(fetch.fetched(items, (1000, 100, 2500, 300), ["nir"]), readings, ["nir"])
    return values.select("item_id", "time_index", "col", F.round(F.col("bands")[0], 9).alias("nir"))


STACK_SQL = """i AS (SELECT o_orderkey AS item_id, row_number() OVER (ORDER BY o_orderkey) - 1 AS time_index FROM orders WHERE o_orderkey % 4 = 0),
r AS (SELECT item_id, time_index, CAST(l_linenumber AS INT) AS row, CAST(l_partkey % 50 AS INT) AS col, * FROM lineitem JOIN i ON l_orderkey = item_id)"""


def scene_stack(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Items of a stack, and readings of some of its assets."""
    orders, lines = B.table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0"), B.table(spark, sf_dir, "lineitem")
    assets = F.map_from_arrays(F.array(*map(F.lit, [*S.ASSETS, "scl"])), F.array_repeat(F.lit("u"), len(S.ASSETS) + 1))
    items = orders.select(F.col("o_orderkey").alias("item_id"), F.col("o_orderkey").alias("ord"), F.lit(32616).alias("epsg"), assets.alias("assets"))
    n = F.col("l_linenumber")
    values = {"green": F.col("l_quantity").cast("double"), "nir": F.when(n % 2 == 0, F.col("l_extendedprice").cast("double")), "scl": F.when(n % 3 == 0, (F.col("l_suppkey") % 12).cast("double"))}
    dn = F.map_filter(F.create_map(*(x for k, v in values.items() for x in (F.lit(k), v))), lambda k, v: v.isNotNull())
    return items, lines.select(F.col("l_orderkey").alias("item_id"), n.cast("int").alias("row"), (F.col("l_partkey") % 50).cast("int").alias("col"), dn.alias("dn"))


@query(f"""WITH {STACK_SQL} SELECT item_id, time_index, row, col, round(l_quantity * (1 / 10000.0::DOUBLE), 9) AS green, round(CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice * (1 / 10000.0::DOUBLE) ELSE 0 END, 9) AS nir FROM r""")
def sc3_scene_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of a stack of scenes: fixed band order, 0 where a reading is missing, places in time."""
    bands, _ = fetch.stacked_bands(*scene_stack(spark, sf_dir))
    return bands.select("item_id", "time_index", "row", "col", *(F.round(F.col("bands")[S.ASSETS.index(a)], 9).alias(a) for a in ("green", "nir")))


@query(f"""WITH {STACK_SQL} SELECT item_id, time_index, row, col, CAST(CASE WHEN l_linenumber % 3 = 0 THEN l_suppkey % 12 ELSE 0 END AS INT) AS scl FROM r""")
def sc4_scene_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.stacked_classes(*scene_stack(spark, sf_dir))[0]


@query("""SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 = 0 THEN 'http://a/' || o_orderkey WHEN o_custkey % 3 = 1 THEN 'https://b/' || o_orderkey END AS url FROM orders""")
def sc18_primary_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("o_custkey") % 3, F.col("o_orderkey").cast("string")
    record = lambda lower, upper: F.struct(lower.cast("string").alias("lower"), upper.cast("string").alias("upper"))
    none = F.lit(None)
    urls = F.array(record(F.when(k == 0, F.concat(F.lit("http://a/"), name)), none), record(F.lit("ftp://x"), none), record(none, F.when(k == 1, F.concat(F.lit("https://b/"), name))))
    return B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), S.first_url(urls).alias("url"))


@query("""SELECT n_nationkey AS id, CAST(p AS INT) AS place, CASE p WHEN 0 THEN 'naip' ELSE 's2' END AS type, CASE p WHEN 0 THEN 4 ELSE 7 END AS bands, -9999.0::DOUBLE AS nodata, CASE p WHEN 0 THEN 'nearest' ELSE 'bilinear' END AS resample
FROM nation, range(2) r(p)""")
def sc10_manifest_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests as JSON text, read with the stack's schema and its defaults."""
    from .sources import manifests

    source = lambda kind, labels, resample: F.struct(F.lit(kind).alias("type"), F.concat(F.lit(f"{kind}/"), F.col("n_name")).alias("path"), F.array(*map(F.lit, labels)).alias("band_labels"), resample.alias("resample"))
    grid = F.struct(F.array(*(F.lit(float(v)) for v in (1, 0, 0, 0, -1, 0))).alias("transform"), F.lit(4).alias("width"), F.lit(4).alias("height"))
    text = F.to_json(F.struct(F.lit(1).alias("version"), grid.alias("grid"), F.array(source("naip", ["R", "G", "B", "N"], F.lit("nearest")), source("s2", S.BANDS, F.lit(None).cast("string"))).alias("sources")))
    raw = B.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("manifest"), F.from_json(text, manifests.schema()).alias("m")).select("manifest", "m.*")
    rows = manifests.sources_of(raw)
    return rows.select(F.col("manifest").alias("id"), "place", "type", F.size("band_labels").alias("bands"), "nodata", "resample")


@query(f"""WITH {MEDIAN_SQL}, c AS (SELECT CAST(r AS INT) AS row, CAST(k AS INT) AS col, season FROM range(48) a(r), range(56) b(k), (SELECT DISTINCT season FROM m))
SELECT c.row // 16 AS chunk_row, c.col // 16 AS chunk_col, c.row AS row, c.col AS col, c.season AS season, coalesce(n_clear, 0) AS n_clear, round(coalesce(value, -9999), 9) AS value FROM c LEFT JOIN m ON m.row = c.row AND m.col = c.col AND m.season = c.season""")
def ag3_chunk_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells of a grid that reaches beyond the observations, by chunk."""
    return rounded(composite.chunk_medians(B.observations(spark, sf_dir), 48, 56, 16), "value")


@query(f"""WITH {B.ELEVATION} SELECT row, col, CASE WHEN z IS NOT NULL AND row + 0.5 > 1 AND col + 0.5 > 2 * (row + 0.5) AND col + 0.5 < 40 THEN z ELSE -9999 END AS z FROM dem""")
def fi6_polygon_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels whose centre lies in a triangle keep their value; others become nodata."""
    ring = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((2, 1), (40, 1), (40, 20))))
    inside = G.in_ring(F.col("col") + 0.5, F.col("row") + 0.5, ring)
    return B.elevation(spark, sf_dir).withColumn("z", F.when(inside & F.col("z").isNotNull(), F.col("z")).otherwise(S.NODATA))


@query(f"""WITH {B.STACK} SELECT row // 5 AS tile_row, col // 5 AS tile_col, count(*) AS pixels, CAST(sum(list_sum(list_transform(bands, lambda v: CAST(trunc(greatest(0.0::DOUBLE, least(1.0::DOUBLE, v)) * 255) AS INT)))) AS BIGINT) AS total
FROM stack GROUP BY ALL""")
def sk6_tile_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of the stack, normalised and quantised, as sums that a rewrite of the tiles would store."""
    tiles_ = B.stack(spark, sf_dir).select(F.floor(F.col("row") / 5).cast("int").alias("tile_row"), F.floor(F.col("col") / 5).cast("int").alias("tile_col"), F.transform("bands", lambda v: S.to_byte(S.normalised(v))).alias("b"))
    return tiles_.groupBy("tile_row", "tile_col").agg(F.count("*").alias("pixels"), F.sum(F.aggregate("b", F.lit(0), lambda a, v: a + v)).cast("long").alias("total"))


@query("""SELECT doc_id AS id, (doc_id * 2654435761 + 42) % 4294967296 < 0.2 * 4294967296 AS validation FROM documents""")
def tk7_validation_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = B.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return ids.withColumn("validation", sampling.shuffled(F.col("id"), 42) < 0.2 * 4294967296)


@query("""SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels WHERE quality = 0 INTERSECT SELECT doc_id FROM labels""")
def st6_index_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = B.table(spark, sf_dir, "labels")
    removed = labels.where("quality = 0").select("doc_id").intersect(labels.select("doc_id"))
    return B.table(spark, sf_dir, "documents").select("doc_id").subtract(removed)


@query(f"""WITH {B.OBSERVATIONS}, t AS (SELECT row, col, scl AS tile_ord, min(dn) AS value FROM obs WHERE scl < 4 GROUP BY ALL), m AS (SELECT row, col, arg_min(value, tile_ord) AS z FROM t GROUP BY row, col),
g AS (SELECT p_partkey AS id, (p_partkey // 50) + 0.25::DOUBLE AS y, (p_partkey % 50) + 0.5::DOUBLE AS x FROM part), c AS (SELECT id, CAST(floor(y) AS INT) + dr AS row, CAST(floor(x) AS INT) + dc AS col,
 (CASE WHEN dr = 1 THEN 0.25::DOUBLE ELSE 0.75::DOUBLE END) * 0.5::DOUBLE AS w FROM g, range(2) a(dr), range(2) b(dc))
SELECT id, round(sum(z * w) / sum(CASE WHEN z IS NOT NULL THEN w END), 7) AS value FROM c LEFT JOIN m ON m.row = c.row AND m.col = c.col GROUP BY id""")
def rs6_mosaic_to_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.observations(spark, sf_dir).where("scl < 4").groupBy("row", "col", F.col("scl").alias("tile_ord")).agg(F.min("dn").alias("value"))
    k = F.col("p_partkey")
    grid = B.table(spark, sf_dir, "part").select(k.alias("id"), (F.floor(k / 50) + 0.25).alias("y"), ((k % 50) + 0.5).alias("x"))
    return rounded(stack.bilinear(composite.mosaicked(t).withColumnRenamed("value", "z"), grid), "value", digits=7)


@query("""SELECT event_id, event_type, count(*) OVER w AS done, round(sum(value) OVER w, 4) AS total, CASE WHEN epoch_us(ts) > min(epoch_us(ts)) OVER w THEN round(count(*) OVER w * 1000000.0::DOUBLE / (epoch_us(ts) - min(epoch_us(ts)) OVER w), 9) END AS rate FROM events WINDOW w AS (PARTITION BY event_type, user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def fo12_running_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fetch.progress(B.table(spark, sf_dir, "events"), ["event_type", "user_id"], ["ts", "event_id"], "value", whole=1000)
    return out.select("event_id", "event_type", "done", F.round("total", 4).alias("total"), F.round("rate", 9).alias("rate"))


@query("""SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 0 ELSE 9 END AS row, CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 19 WHEN 2 THEN 0 ELSE 19 END AS col,
 CASE p_partkey % 3 WHEN 0 THEN 255.0::DOUBLE WHEN 1 THEN 65535.0::DOUBLE END AS scale FROM part""")
def pj16_corners_and_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.element_at(F.array(*map(F.lit, ("ul", "ur", "ll", "lr"))), (k % 4 + 1).cast("int"))
    dtype = F.element_at(F.array(*map(F.lit, ("uint8", "uint16", "float32"))), (k % 3 + 1).cast("int"))
    at = S.corner(name, 20, 10)
    return B.table(spark, sf_dir, "part").select(k.alias("id"), at["row"].alias("row"), at["col"].alias("col"), S.dtype_scale(dtype).alias("scale"))


@query("""SELECT c_custkey AS id, CAST(floor((c_acctbal + 1000) / 10) AS INT) AS col, CAST(floor((10000 - (c_custkey * 7919) % 10000) / 10) AS INT) AS row, floor((c_acctbal + 1000) / 10) * 10 - 1000 + 5.0::DOUBLE AS x,
 10000 - floor((10000 - (c_custkey * 7919) % 10000) / 10) * 10 - 5.0::DOUBLE AS y FROM customer""")
def sc15_cells_of_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cell of a point by the inverse transform, and that cell's centre."""
    k = F.col("c_custkey")
    row, col = S.cell_of(F.col("c_acctbal"), ((k * 7919) % 10000).cast("double"), (10.0, 0.0, -1000.0, 0.0, -10.0, 10000.0))
    x, y = S.pixel_centre(F.col("row"), F.col("col"), -1000.0, 10000.0, 10.0)
    cells = B.table(spark, sf_dir, "customer").select(k.alias("id"), col.alias("col"), row.alias("row"))
    return cells.withColumns({"x": x, "y": y})


# --- rasters, zones, extraction and vectorised functions -------------------------------------------------------------------


@query(f"""WITH {B.STACK}, h AS (SELECT max(row) + 1 AS h FROM stack),
w AS (SELECT DISTINCT s_suppkey % 40 AS id, (s_suppkey % 40) % 13 - 2 + 0.25::DOUBLE * ((s_suppkey % 40) % 4) AS ro, (s_suppkey % 40) % 23 - 1.5::DOUBLE AS co FROM supplier),
c AS (SELECT id, r, k, greatest(floor(ro), 0) AS r0, least(ceil(ro + 3.5), h) AS r1, greatest(floor(co), 0) AS c0, least(ceil(co + 2.25), 25) AS c1, ro, co FROM w, h, range(4) a(r), range(3) b(k)),
a AS (SELECT id, CAST(r AS INT) AS row, CAST(k AS INT) AS col, r0 + r - round_even(r0 - ro, 0) AS ar, c0 + k - round_even(c0 - co, 0) AS ac, r0, r1, c0, c1 FROM c)
SELECT a.id, a.row, a.col, round(coalesce(bands[1] / 0.5, -9999), 7) AS one, round(coalesce((bands[2] + 1) / 3, -9999), 7) AS two, round(coalesce(bands[3], -9999), 7) AS three
FROM a LEFT JOIN stack s ON s.row = a.ar AND s.col = a.ac AND ar >= r0 AND ar < r1 AND ac >= c0 AND ac < c1""")
def sc14_scaled_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows with fractions of cells, some beyond the grid, from two sources with a scaling of their own."""
    whole = B.stack(spark, sf_dir)
    height = whole.agg(F.max("row")).first()[0] + 1
    first, second = raster.Layer(whole.select("row", "col", F.slice("bands", 1, 1).alias("bands")), ("one",), scale_max=0.5), raster.Layer(whole.select("row", "col", F.slice("bands", 2, 2).alias("bands")), ("two", "three"), band_scaling={"two": (-1.0, 2.0)})
    key = F.col("s_suppkey") % 40
    windows = B.table(spark, sf_dir, "supplier").select(key.alias("id")).distinct().select(
        "id", (F.col("id") % 13 - 2 + 0.25 * (F.col("id") % 4)).alias("row_off"), (F.col("id") % 23 - 1.5).alias("col_off"), F.lit(3.5).alias("height"), F.lit(2.25).alias("width"), F.lit(height).alias("grid_h"), F.lit(B.STACK_COLUMNS).alias("grid_w")
    )
    out = raster.read_windows(windows, [first, second], ["id"])
    return out.select("id", "row", "col", *(F.round(F.col("bands")[k], 7).alias(n) for k, n in enumerate(("one", "two", "three"))))


GRIDS_SQL = "g(stack, a, c, e, f, grid_w, grid_h) AS (VALUES (0, 64.0::DOUBLE, -1000.0::DOUBLE, -64.0::DOUBLE, 10000.0::DOUBLE, 50, 100), (1, 64.0::DOUBLE, 1900.0::DOUBLE, -64.0::DOUBLE, 9000.0::DOUBLE, 120, 160))"
PLACED_SQL = f"""{B.GRID}, {GRIDS_SQL}, m AS (SELECT id, min(stack) AS stack FROM grid JOIN g ON minx <= c + a * grid_w AND maxx >= c AND miny <= f AND maxy >= f + e * grid_h GROUP BY id),
p AS (SELECT 'tile_' || lpad(CAST(grid.id AS VARCHAR), 5, '0') AS tile, g.*, (maxy - f) / e AS row_off, (minx - c) / a AS col_off, (miny - maxy) / e AS height, (maxx - minx) / a AS width FROM grid JOIN m ON m.id = grid.id JOIN g ON g.stack = m.stack)"""


def grids(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, 64.0, -1000.0, -64.0, 10000.0, 50, 100), (1, 64.0, 1900.0, -64.0, 9000.0, 120, 160)], "stack int, a double, c double, e double, f double, grid_w int, grid_h int")


@query(f"WITH {PLACED_SQL} SELECT tile, stack, round(row_off, 7) AS row_off, round(col_off, 7) AS col_off, height, width FROM p")
def ge13_tile_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles with the first stack that they touch, and their windows there."""
    out = extraction.placed(grid_of(spark), grids(spark))
    return out.select("tile", "stack", F.round("row_off", 7).alias("row_off"), F.round("col_off", 7).alias("col_off"), "height", "width")


@query(f"""WITH {PLACED_SQL}, {B.ELEVATION}, {B.LABEL_BOXES}, d AS (SELECT 0 AS stack, row, col, z FROM dem UNION ALL SELECT 1, row, col + 3, z / 2 FROM dem),
c AS (SELECT p.*, CAST(r AS INT) AS r, CAST(k AS INT) AS k, greatest(floor(row_off), 0) AS r0, least(ceil(row_off + height), grid_h) AS r1, greatest(floor(col_off), 0) AS c0, least(ceil(col_off + width), grid_w) AS c1 FROM p, range(8) x(r), range(8) y(k)),
t AS (SELECT *, r0 + r - round_even(r0 - row_off, 0) AS ar, c0 + k - round_even(c0 - col_off, 0) AS ac, c + (col_off + k + 0.5) * a AS x, f + (row_off + r + 0.5) * e AS y FROM c),
l AS (SELECT DISTINCT tile, r, k FROM t JOIN lab ON x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy)
SELECT t.tile AS tile, t.r AS row, t.k AS col, round(coalesce(z / 5000, -9999), 9) AS z, CASE WHEN l.tile IS NULL THEN 0 ELSE 1 END AS label FROM t
LEFT JOIN d ON d.stack = t.stack AND d.row = ar AND d.col = ac AND ar >= r0 AND ar < r1 AND ac >= c0 AND ac < c1 LEFT JOIN l ON l.tile = t.tile AND l.r = t.r AND l.k = t.k""")
def ud9_extracted_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training tiles: each tile's cells from its stack, scaled, and its burned labels."""
    dem = B.elevation(spark, sf_dir).withColumn("bands", F.when(F.col("z").isNotNull(), F.array("z")).otherwise(F.array(F.lit(S.NODATA))))
    cells = dem.select(F.lit(0).alias("stack"), "row", "col", "bands").unionByName(dem.select(F.lit(1).alias("stack"), "row", (F.col("col") + 3).alias("col"), F.transform("bands", lambda v: F.when(v == S.NODATA, v).otherwise(v / 2)).alias("bands")))
    windows = extraction.placed(grid_of(spark), grids(spark))
    images = extraction.images(windows, [raster.Layer(cells, ("z",), scale_max=5000.0)])
    masks = extraction.masks(windows, B.label_boxes(spark, sf_dir))
    return images.join(masks, ["tile", "row", "col"]).select("tile", "row", "col", F.round(F.col("bands")[0], 9).alias("z"), "label")


def surface(spark: SparkSession, sf_dir: str, size: float = 10.0, epsg: int = 5070) -> raster.Raster:
    """The elevation table as a raster."""
    dem = B.elevation(spark, sf_dir)
    height = dem.agg(F.max("row")).first()[0] + 1
    cells = dem.select("row", "col", F.array(F.coalesce("z", F.lit(S.NODATA))).alias("bands"))
    return raster.Raster(cells, Grid(f"EPSG:{epsg}", (size, 0.0, 0.0, 0.0, -size, 0.0), B.GRID_COLUMNS, height), ("z",))


def warped_sql(source: str, columns: str, y: str, x: str) -> str:
    """Targets t (row, col and what y and x need), each with the bilinear mean of the source's neighbours."""
    return f"""q AS (SELECT row, col, round({y}, 9) AS y, round({x}, 9) AS x FROM t), c AS (SELECT row, col, CAST(floor(y) AS INT) + dr AS sr, CAST(floor(x) AS INT) + dc AS sc,
 (CASE WHEN dr = 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) * (CASE WHEN dc = 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) AS w FROM q, range(2) a(dr), range(2) b(dc))
SELECT c.row AS row, c.col AS col, {columns} FROM c LEFT JOIN {source} d ON d.row = c.sr AND d.col = c.sc WHERE w > 0 GROUP BY c.row, c.col"""


MEAN_SQL = "round(coalesce(sum(z * w) / sum(CASE WHEN z IS NOT NULL THEN w END), -9999), 6) AS z"


@query(f"""WITH {B.ELEVATION}, h AS (SELECT max(row) + 1 AS h FROM dem), t AS (SELECT CAST(r AS INT) AS row, CAST(k AS INT) AS col FROM h, range(0, CAST(ceil(h * 10 / 25.0::DOUBLE - 1e-9) AS BIGINT)) a(r), range(20) b(k)),
{warped_sql('dem', MEAN_SQL, '((row + 0.5::DOUBLE) * 25) / 10 - 0.5', '((col + 0.5::DOUBLE) * 25) / 10 - 0.5')}""")
def rs3_resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster of 10 m in cells of 25 m."""
    return raster.resampled(surface(spark, sf_dir), 25.0).cells.select("row", "col", F.round(F.col("bands")[0], 6).alias("z"))


@query(f"""WITH {B.ELEVATION}, h AS (SELECT max(row) + 1 AS h FROM dem), u AS (SELECT 0 AS o, row, col, z FROM dem UNION ALL SELECT 1, row + 2, col + 30, z + 1000 FROM dem),
m AS (SELECT row, col, arg_min(z, o) FILTER (z IS NOT NULL) AS z FROM u GROUP BY row, col), t AS (SELECT CAST(r AS INT) AS row, CAST(k AS INT) AS col FROM h, range(0, CAST(ceil((h + 2) * 10 / 20.0::DOUBLE - 1e-9) AS BIGINT)) a(r), range(40) b(k)),
{warped_sql('m', MEAN_SQL, '((row + 0.5::DOUBLE) * 20) / 10 - 0.5', '((col + 0.5::DOUBLE) * 20) / 10 - 0.5')}""")
def rs5_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping tiles, mosaicked and resampled into one reference."""
    one = surface(spark, sf_dir)
    other = raster.Raster(one.cells.withColumn("bands", F.transform("bands", lambda v: F.when(v == S.NODATA, v).otherwise(v + 1000))), Grid(one.grid.crs, (10.0, 0.0, 300.0, 0.0, -10.0, -20.0), one.grid.width, one.grid.height), one.labels)
    return raster.prepared_reference([one, other], resolution=20.0).cells.select("row", "col", F.round(F.col("bands")[0], 6).alias("z"))


FORWARD_SQL = """f AS (SELECT *, sin(radians(lat)) AS s FROM p),
e AS (SELECT *, {a} * sqrt({c} - {n} * ((1 - {e2}) * (s / (1 - {e2} * s * s) - ln((1 - {e} * s) / (1 + {e} * s)) / (2 * {e})))) / {n} AS rho, {n} * (radians(lon) - {lon0}) AS theta FROM f),
v AS (SELECT *, rho * sin(theta) AS px, {rho0} - rho * cos(theta) AS py FROM e)""".format(**{k: f"{v!r}::DOUBLE" for k, v in ALBERS.items()})


@query(f"""WITH {B.ELEVATION}, p AS (SELECT CAST(r AS INT) AS row, CAST(k AS INT) AS col, -96 + (k + 0.5::DOUBLE) * 0.01 AS lon, 23.2 - (r + 0.5::DOUBLE) * 0.01 AS lat FROM range(25) a(r), range(55) b(k)), {FORWARD_SQL},
t AS (SELECT row, col, px, py FROM v), {warped_sql('dem', MEAN_SQL, '(py - 30000) / -1000 - 0.5', 'px / 1000 - 0.5')}""")
def rs4_reprojected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster in metres on a grid in degrees."""
    own = surface(spark, sf_dir, 1000.0)
    own = raster.Raster(own.cells, Grid("EPSG:5070", (1000.0, 0.0, 0.0, 0.0, -1000.0, 30000.0), own.grid.width, own.grid.height), own.labels)
    return raster.warped(own, Grid("EPSG:4326", (0.01, 0.0, -96.0, 0.0, -0.01, 23.2), 55, 25)).cells.select("row", "col", F.round(F.col("bands")[0], 6).alias("z"))


@query(f"""WITH {B.ELEVATION}, k AS (SELECT row, col, z, (col + 0.5::DOUBLE) * 10 AS x, -(row + 0.5::DOUBLE) * 10 AS y FROM dem WHERE row BETWEEN 1 AND 29 AND col BETWEEN 2 AND 40)
SELECT row - 1 AS row, col - 2 AS col, CASE WHEN z IS NOT NULL AND x > 23 AND x < 404 AND y < -12 AND y > -293 AND NOT (x > 100 AND x < 200 AND y < -100 AND y > -200) THEN z ELSE -9999 END AS z FROM k""")
def ge8_clipped_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster cropped to an area with a hole."""
    area = [(23.0, -12.0), (23.0, -293.0), (404.0, -293.0), (404.0, -12.0)]
    hole = [(100.0, -100.0), (200.0, -100.0), (200.0, -200.0), (100.0, -200.0)]
    own = surface(spark, sf_dir)
    tall = raster.Raster(own.cells, Grid(own.grid.crs, own.grid.transform, own.grid.width, max(own.grid.height, 30)), own.labels)
    return raster.clipped(tall, [area, hole], 5070).cells.select("row", "col", F.col("bands")[0].alias("z"))


@query(f"""WITH b AS (SELECT c_custkey AS id, -120 + (c_custkey % 400) / 10.0::DOUBLE AS minx, 26 + (c_custkey % 190) / 10.0::DOUBLE AS miny FROM customer),
p AS (SELECT id, k, CASE WHEN k IN (0, 3) THEN minx ELSE minx + 0.5 END AS lon, CASE WHEN k IN (0, 1) THEN miny ELSE miny + 0.25 END AS lat FROM b, range(4) c(k)), {FORWARD_SQL}
SELECT id, round(min(px), 4) AS minx, round(min(py), 4) AS miny, round(max(px), 4) AS maxx, round(max(py), 4) AS maxy FROM v GROUP BY id""")
def ge9_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes in degrees as rings in metres, and the rings' boxes."""
    k = F.col("c_custkey")
    x, y = -120 + (k % 400) / 10.0, 26 + (k % 190) / 10.0
    boxes = B.table(spark, sf_dir, "customer").select(k.alias("id"), x.alias("minx"), y.alias("miny"), (x + 0.5).alias("maxx"), (y + 0.25).alias("maxy"))
    return rounded(raster.footprints(boxes, 4326, 5070).drop("ring"), "minx", "miny", "maxx", "maxy", digits=4)


def cover_sql(boxes: str, clip: str = "true") -> str:
    """Area that boxes cover, by cell of 1024: strips between their vertical sides, stretches merged within each."""
    return f"""k AS (SELECT cx, cy, greatest(minx, cx * 1024) AS x0, greatest(miny, cy * 1024) AS y0, least(maxx, (cx + 1) * 1024) AS x1, least(maxy, (cy + 1) * 1024) AS y1 FROM {boxes}, range(-3, 12) a(cx), range(-3, 12) b(cy)),
n AS (SELECT * FROM k WHERE x1 > x0 AND y1 > y0 AND {clip}), sx AS (SELECT cx, cy, x, lead(x) OVER (PARTITION BY cx, cy ORDER BY x) AS nx FROM (SELECT cx, cy, x0 AS x FROM n UNION SELECT cx, cy, x1 FROM n)),
st AS (SELECT sx.cx AS cx, sx.cy AS cy, x, nx, y0, y1, max(y1) OVER (PARTITION BY sx.cx, sx.cy, x ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM sx JOIN n ON n.cx = sx.cx AND n.cy = sx.cy AND n.x0 <= x AND n.x1 >= nx WHERE nx IS NOT NULL),
cov AS (SELECT cx, cy, sum((nx - x) * greatest(0, y1 - greatest(y0, coalesce(far, y0)))) AS area FROM st GROUP BY cx, cy)"""


@query(f"WITH {B.LABEL_BOXES}, {cover_sql('lab')} SELECT CAST(cx AS BIGINT) AS cx, CAST(cy AS BIGINT) AS cy, round(area, 4) AS area FROM cov")
def ag10_union_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area that label boxes cover together, by cell."""
    return rounded(zones.area_of(zones.union(B.label_boxes(spark, sf_dir)), "cx", "cy"), "area", digits=4)


@query(f"""WITH {B.LABEL_BOXES}, {B.INVENTORY_BOXES}, hol AS (SELECT greatest(minx - 100, 0) AS minx, greatest(miny - 100, 0) AS miny, least(maxx + 100, 6000) AS maxx, least(maxy + 100, 6000) AS maxy FROM lab
 UNION ALL SELECT greatest(minx, 0), greatest(miny, 0), least(maxx, 6000), least(maxy, 6000) FROM inv), {cover_sql('hol')},
w AS (SELECT cx, cy, (least((cx + 1) * 1024, 6000) - cx * 1024) * (least((cy + 1) * 1024, 6000) - cy * 1024.0::DOUBLE) AS whole FROM range(6) a(cx), range(6) b(cy))
SELECT CAST(w.cx AS BIGINT) AS cx, CAST(w.cy AS BIGINT) AS cy, round(whole - coalesce(area, 0), 4) AS area FROM w LEFT JOIN cov ON cov.cx = w.cx AND cov.cy = w.cy WHERE whole - coalesce(area, 0) > 1e-6""")
def ge5_safe_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an area keeps outside its grown labels and the inventory, by cell."""
    area = spark.createDataFrame([(0.0, 0.0, 6000.0, 6000.0)], "minx double, miny double, maxx double, maxy double")
    holes = G.grown(B.label_boxes(spark, sf_dir), 100.0).select(*zones.SIDES).unionByName(B.inventory_boxes(spark, sf_dir).select(*zones.SIDES))
    return rounded(zones.area_of(zones.difference(area, holes), "cx", "cy"), "area", digits=4)


@query(f"""WITH RECURSIVE {B.ELEVATION}, c AS (SELECT row, col, row * 50 + col AS cell FROM dem WHERE z % 3 < 1.7 AND z IS NOT NULL AND row < 12), r(cell, row, col, part) AS (SELECT cell, row, col, cell FROM c UNION SELECT d.cell, d.row, d.col, r.part FROM r JOIN c d ON abs(d.row - r.row) + abs(d.col - r.col) = 1),
l AS (SELECT row, col, min(part) AS part FROM r GROUP BY row, col), a AS (SELECT part, count(*) * 300.0::DOUBLE AS area FROM l GROUP BY part)
SELECT round(area, 4) AS area, count(*) AS parts FROM a WHERE area > 900 GROUP BY area""")
def fi9_large_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected parts of many rectangles, without slivers: how many there are of each area."""
    cells = B.elevation(spark, sf_dir).where("z % 3 < 1.7 and z is not null and row < 12")
    boxes = cells.select((F.col("col") * 20.0).alias("minx"), (F.col("row") * 15.0).alias("miny"), (F.col("col") * 20.0 + 20).alias("maxx"), (F.col("row") * 15.0 + 15).alias("maxy"))
    kept = zones.without_slivers(zones.parts(zones.union(boxes)))
    return rounded(zones.area_of(kept, "part"), "area", digits=4).groupBy("area").agg(F.count("*").alias("parts"))


@query(f"""WITH {B.LABEL_BOXES} SELECT id, round((maxx - minx) * (maxy - miny) + 2 * 50 * (maxx - minx + maxy - miny) + 4 * 16 * 0.5 * 2500 * sin(pi() / 32), 6) AS area, 68 AS points FROM lab""")
def ge2_rounded_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes grown by a distance, with arcs of 16 segments at the corners."""
    ring = G.rounded_ring(50.0)
    return B.label_boxes(spark, sf_dir).select("id", F.round(G.ring_area(ring), 6).alias("area"), F.size(ring).alias("points"))


@query("SELECT array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS systems, count(DISTINCT p_brand) AS n FROM part")
def ag15_distinct_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scenes.distinct_values(B.table(spark, sf_dir, "part"), "p_brand")
    return found.agg(F.array_join(F.array_sort(F.collect_list("p_brand")), ",").alias("systems"), F.count("*").alias("n"))


@query(f"WITH {B.INVENTORY_BOXES} SELECT id FROM inv WHERE minx <= 6000 AND maxx >= 1000 AND miny <= 7000 AND maxy >= 500 AND 2018 + id % 3 = 2019 ORDER BY id LIMIT 25")
def sc20_catalog_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog tiles of an area and a year, the first of them."""
    catalog = B.inventory_boxes(spark, sf_dir).withColumn("year", 2018 + F.col("id") % 3)
    return fetch.catalog_tiles(catalog, (1000, 500, 6000, 7000), 2019, 25).select("id")


@query(f"WITH {B.LABEL_BOXES} SELECT id, greatest(minx, 1000) AS minx, greatest(miny, 500) AS miny, least(maxx, 6000) AS maxx, least(maxy, 7000) AS maxy FROM lab WHERE minx < 6000 AND maxx > 1000 AND miny < 7000 AND maxy > 500")
def sc21_clipped_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.clipped_shapes(B.label_boxes(spark, sf_dir), (1000, 500, 6000, 7000)).select("id", *zones.SIDES)


@query("""SELECT p_partkey AS id, ['1/3', '1', '1/9'][1 + p_partkey % 3] || ' ' || ['10m', '30m', '10m'][1 + p_partkey % 3] AS wanted, [1, 1, 2][1 + p_partkey % 3] AS place FROM part""")
def sc22_dataset_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a dataset stands among those asked for at a resolution."""
    from .sources import services

    short = {services.NINTH: "1/9", services.THIRD: "1/3", services.WHOLE: "1"}
    places = [(f"{short[d]} {r}", k + 1) for r in ("10m", "30m") for k, d in enumerate(services.datasets_for(r))]
    k = F.col("p_partkey") % 3
    wanted = F.when(k == 0, "1/3 10m").when(k == 1, "1 30m").otherwise("1/9 10m")
    parts = B.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), wanted.alias("wanted"))
    return parts.join(spark.createDataFrame(places, "wanted string, place int"), "wanted").select("id", "wanted", "place")


@query("""SELECT p_partkey AS id, CAST(32600 + p_size % 20 AS INT) AS epsg, CASE WHEN p_size % 20 IN (16, 17) THEN 'zone ' || (p_size % 20) END AS labels, CASE WHEN p_partkey % 2 = 0 THEN 5 ELSE 29 END AS channels FROM part""")
def jo14_labels_by_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles with the label set of their reference system, and the channels of their model."""
    parts = B.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (32600 + F.col("p_size") % 20).cast("int").alias("epsg"))
    sets = spark.createDataFrame([(32616, "zone 16"), (32617, "zone 17")], "epsg int, labels string")
    out = extraction.labels_by_system(parts, sets)
    own = F.when(F.col("id") % 2 == 0, raster.channels(("b",) * 29, 5)).otherwise(raster.channels(("b",) * 29))
    return out.select("id", "epsg", "labels", own.alias("channels"))


@query(f"""WITH RECURSIVE {B.STACK}, c AS (SELECT row, col, CAST(row AS BIGINT) * 25 + col AS cell FROM stack WHERE label % 2 = 0),
r(cell, row, col, region) AS (SELECT cell, row, col, cell FROM c UNION SELECT d.cell, d.row, d.col, r.region FROM r JOIN c d ON abs(d.row - r.row) + abs(d.col - r.col) = 1),
l AS (SELECT row, col, min(region) AS region FROM r GROUP BY row, col), n AS (SELECT l.region AS region, count(*) AS shared FROM l JOIN l m ON m.region = l.region AND abs(m.row - l.row) + abs(m.col - l.col) = 1 GROUP BY l.region)
SELECT l.region AS region, count(*) * 4.0::DOUBLE AS area, round(2.0::DOUBLE * (4 * count(*) - coalesce(any_value(shared), 0)), 6) AS border FROM l LEFT JOIN n ON n.region = l.region GROUP BY l.region""")
def sk9_region_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as rings: their area, and the length of all their borders, holes included."""
    mask = B.stack(spark, sf_dir).where("label % 2 = 0").select("row", "col")
    shapes = inference.outlines(inference.regions(mask, B.STACK_COLUMNS), 0.0, (0.0, 0.0), 2.0)
    length = lambda ring: F.aggregate(
        F.zip_with(ring, F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1)), lambda p, q: F.abs(p["x"] - q["x"]) + F.abs(p["y"] - q["y"])), F.lit(0.0), lambda a, v: a + v
    )
    return shapes.select("region", "area", F.round(F.aggregate(F.transform("rings", length), F.lit(0.0), lambda a, v: a + v), 6).alias("border"))


@query(f"""WITH {B.STACK}, e AS (SELECT row, col, 1 / (1 + exp(greatest(0, least(1, bands[1])) - 2 * greatest(0, least(1, bands[2])))) AS p1 FROM stack) SELECT row, col, round(p1, 5) AS p1, CASE WHEN p1 >= 0.5 THEN 1 ELSE 0 END AS class_id FROM e""")
def ud3_window_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vectorised model over overlapping windows, averaged."""
    import numpy as np

    pixels = B.stack(spark, sf_dir).select("row", "col", S.prepared(F.slice("bands", 1, 2), 2).alias("bands"))
    height = pixels.agg(F.max("row")).first()[0] + 1
    scores = inference.model_scores(pixels, height, B.STACK_COLUMNS, 10, 4, lambda x: np.stack([x[0], 2 * x[1]]), 2, 2)
    mean = inference.finalised(inference.averaged(scores), F.lit(True), 0.5)
    return mean.select("row", "col", F.round(F.col("probabilities")[1], 5).alias("p1"), "class_id")


@query(f"WITH {B.ELEVATION} SELECT row, col, round(z - max(z) OVER (PARTITION BY row // 6, col // 6), 6) AS below FROM dem")
def ud1_block_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function of arrays on blocks of a surface."""
    import numpy as np

    out = inference.block_function(B.elevation(spark, sf_dir), 6, lambda a: a - (np.nanmax(a) if np.isfinite(a).any() else 0.0), "z", "below")
    return out.select("row", "col", F.round(F.nanvl("below", F.lit(None)), 6).alias("below"))


@query(f"WITH {B.STACK} SELECT row, col, 4 AS n, round(greatest(0, least(1, bands[4])), 9) AS last_band FROM stack")
def pj7_truncated_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = B.stack(spark, sf_dir).withColumn("p", S.prepared(F.col("bands"), 4))
    return out.select("row", "col", F.size("p").alias("n"), F.round(F.col("p")[3], 9).alias("last_band"))


@query("""WITH r AS (SELECT DISTINCT least(o, 1000 - 128) AS o FROM range(0, 1000, 96) x(o)), c AS (SELECT DISTINCT least(o, 700 - 128) AS o FROM range(0, 700, 96) x(o))
SELECT CAST(greatest(r.o - 8, 0) AS INT) AS row_off, CAST(greatest(c.o - 8, 0) AS INT) AS col_off, CAST(least(r.o + 136, 1000) - greatest(r.o - 8, 0) AS INT) AS h, CAST(least(c.o + 136, 700) - greatest(c.o - 8, 0) AS INT) AS w FROM r, c""")
def fo9_training_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of 128 that advance by 96, with a margin of 8."""
    return tiles.training_grid(spark, 1000, 700, 128, 96, 8)


@query(f"""WITH {B.LABEL_BOXES}, {B.INVENTORY_BOXES}, d AS (SELECT id, (minx + maxx) / 2 AS x, (miny + maxy) / 2 AS y FROM lab ORDER BY (id % 2147483648 * 2654435761 + 42) % 4294967296, id LIMIT 50),
a AS (SELECT id, x - 400 AS minx, y - 400 AS miny, x + 400 AS maxx, y + 400 AS maxy FROM d), l AS (SELECT a.id AS id, count(*) AS n_labels FROM a JOIN lab b ON {TOUCH} GROUP BY a.id), i AS (SELECT a.id AS id, count(*) AS n_inventory FROM a JOIN inv b ON {TOUCH} GROUP BY a.id)
SELECT id, n_labels, n_inventory FROM l JOIN i USING (id) WHERE n_labels >= 1 AND n_inventory > n_labels AND n_inventory / n_labels > 1.5 ORDER BY n_inventory DESC, id LIMIT 1""")
def tk6_challenge_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of 50 boxes around labels."""
    return sampling.challenge_area(B.label_boxes(spark, sf_dir), B.inventory_boxes(spark, sf_dir), 800.0, 1).select("id", "n_labels", "n_inventory")
