"""Films medallion on hand-written raw JSON (FIXTURES §1) and dedup properties."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import films as ops
from lakestrata.operators.dedup import dedup_first
from lakestrata.plans import films_job
from lakestrata.session import scratch_path, local_fs_path


def film(id, rating, date, genre, studio, budget, box, vote):
    return {"id": id, "rating": rating, "release_date": date, "genre": genre, "studio": studio,
            "budget": budget, "box_office": box, "vote_average": vote}


ARRAY_FILE = [
    film(1, "G", "2020-05-01", "Drama", "A", 100, 250.5, 7.1),
    film(2, "PG", "2019-12-31", "Drama", "B", 50.25, 80, 6.0),
    film(3, "PG-13", "", "Comedy", "A", None, 10, 5.5),
    film(4, "R", "not a date", None, None, 20, 30, 8.0),
    film(5, "NC-17", None, "Horror", "C", None, None, None),
    film(6, "X", "2021-01-01", "Horror", "C", None, 5, 4.0),
    film(7, "pg", "2021-06-15", "Comedy", "B", 10, 12, 6.5),
    film(8, None, "2020-02-29", "Drama", "A", 30, 45, 7.0),
    film(9, "G", "2018-03-03", "Drama", "A", 1, 2, 3),
    film(9, "PG", "2018-03-04", "Comedy", "B", 2, 3, 4),
    film(None, "G", "2020-01-01", "Comedy", "B", 40, 60, 6),
    film(None, "R", "2020-01-02", "Drama", "A", 41, 61, 7),
]
OBJECT_FILE = film(9, "R", "2018-03-05", "Drama", "C", 3, 4, 5)
TRUNCATED = '[{"id": 10, "rating": "G",'


@pytest.fixture(scope="module")
def film_tables(spark):
    root = scratch_path(spark, "films_fixture")
    base = local_fs_path(root)
    import os
    os.makedirs(f"{base}/raw/2024-01", exist_ok=True)
    os.makedirs(f"{base}/raw/2024-02", exist_ok=True)
    with open(f"{base}/raw/2024-01/movies.json", "w") as f:
        json.dump(ARRAY_FILE, f, indent=2)
    with open(f"{base}/raw/2024-02/one.json", "w") as f:
        json.dump(OBJECT_FILE, f, indent=2)
    with open(f"{base}/raw/2024-02/broken.json", "w") as f:
        f.write(TRUNCATED)
    tag = os.path.basename(base).replace("-", "_")
    cfg = films_job.FilmsConfig(raw_glob=f"{base}/raw/*/*.json", bronze_db=f"b_{tag}",
                                silver_db=f"s_{tag}", gold_db=f"g_{tag}", db_root=f"{base}/lake")
    report = films_job.run_films(spark, cfg)
    return cfg, report


def test_bronze_keeps_everything_and_quarantines(spark, film_tables):
    cfg, report = film_tables
    assert report["quarantined"] == 1
    assert spark.table(f"{cfg.bronze_db}.movies_info").count() == len(ARRAY_FILE) + 2


def test_silver_rules(spark, film_tables):
    cfg, _ = film_tables
    s = {r["id"]: r for r in spark.table(f"{cfg.silver_db}.movies_info").collect()}
    assert len(s) == 10                      # ids 1..9 plus one null-id row
    assert s[9]["rating"] == "G"             # deterministic survivor (smallest row)
    assert s[None]["rating"] == "G"          # null ids collapse to one row
    cats = {i: s[i]["rating_category"] for i in s}
    assert cats[1] == "General" and cats[2] == "Parental Guidance"
    assert cats[3] == "Parents Strongly Cautioned" and cats[4] == "Restricted"
    assert cats[5] == "Adults Only" and cats[6] == "Not Rated"
    assert cats[7] == "Not Rated" and cats[8] == "Not Rated"   # lower-case and null
    assert s[3]["release_date"] is None and s[4]["release_date"] is None
    assert s[5]["release_year"] is None and s[8]["release_year"] == 2020
    assert str(s[8]["release_date"]) == "2020-02-29"


def test_gold_tables(spark, film_tables):
    cfg, _ = film_tables
    g = {r["genre"]: r for r in spark.table(f"{cfg.gold_db}.genre_metrics").collect()}
    assert g["Drama"]["movie_count"] == 4 and g["Drama"]["avg_budget"] == 45.31
    assert g["Comedy"]["movie_count"] == 2 and g["Comedy"]["avg_budget"] == 25.0  # null id not counted
    assert g["Horror"]["avg_budget"] is None                                       # all-null group
    assert g[None]["movie_count"] == 1
    st = {r["studio"]: r for r in spark.table(f"{cfg.gold_db}.studio_metrics").collect()}
    assert st["A"]["total_box_office"] == round(250.5 + 45 + 2 + 10, 2)
    y = {r["release_year"]: r for r in spark.table(f"{cfg.gold_db}.year_metrics").collect()}
    assert y[None]["movie_count"] == 3   # '', junk, null dates
    # gold counts add up to the non-null silver ids
    silver = spark.table(f"{cfg.silver_db}.movies_info")
    assert sum(r["movie_count"] for r in g.values()) == silver.where(F.col("id").isNotNull()).count()


def test_gold_single_scan_equals_three_aggregates(spark, film_tables):
    cfg, _ = film_tables
    movies = spark.table(f"{cfg.silver_db}.movies_info")
    sets = films_job.split_gold_sets(ops.gold_grouping_sets(movies))
    three = {"genre_metrics": ops.genre_metrics(movies),
             "studio_metrics": ops.studio_metrics(movies, sort=False),
             "year_metrics": ops.year_metrics(movies, sort=False)}
    for name, df in three.items():
        assert sorted(map(tuple, df.collect()), key=str) == sorted(map(tuple, sets[name].collect()), key=str)


def test_sorted_views(spark, film_tables):
    cfg, _ = film_tables
    movies = spark.table(f"{cfg.silver_db}.movies_info")
    totals = [r["total_box_office"] for r in ops.studio_metrics(movies).collect()]
    non_null = [t for t in totals if t is not None]
    assert totals == sorted(non_null, reverse=True) + [None] * (len(totals) - len(non_null))
    years = [r["release_year"] for r in ops.year_metrics(movies).collect()]
    assert years[0] is None and years[1:] == sorted(years[1:])


def test_schema_change_is_refused(spark, film_tables):
    from lakestrata.sources.tables import SchemaChangeError, write_table
    cfg, _ = film_tables
    with pytest.raises(SchemaChangeError):
        write_table(spark.range(3), f"{cfg.gold_db}.genre_metrics")


def test_dedup_properties(spark):
    rnd = random.Random(7)
    hot = [(1, rnd.randint(0, 5), rnd.random()) for _ in range(300)]   # one key = 1/3 of rows
    rest = [(rnd.randint(2, 60), rnd.randint(0, 5), rnd.random()) for _ in range(600)]
    df = spark.createDataFrame(hot + rest + [(None, 1, 0.5), (None, 0, 0.25)], "k long, a int, b double")
    order = [("a", "desc"), "b"]
    agg = dedup_first(df, ["k"], order, method="aggregate")
    win = dedup_first(df, ["k"], order, method="window")
    rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert rows(agg) == rows(win)
    assert rows(dedup_first(agg, ["k"], order)) == rows(agg)          # idempotent
    brute = {}
    for k, a, b in hot + rest + [(None, 1, 0.5), (None, 0, 0.25)]:
        if k not in brute or (-a, b) < (-brute[k][1], brute[k][2]):
            brute[k] = (k, a, b)
    assert rows(agg) == sorted(brute.values(), key=str)


def test_dedup_descending_string_is_an_aggregate(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (1, None, 3), (2, "a", 4)],
                               "k int, s string, v int")
    out = {r["k"]: r["v"] for r in dedup_first(df, ["k"], [("s", "desc")]).collect()}
    assert out == {1: 2, 2: 4}                     # 'c' wins; desc puts null last
    for method in ("aggregate", "window"):
        same = {r["k"]: r["v"] for r in dedup_first(df, ["k"], [("s", "desc")], method=method).collect()}
        assert same == out
    nulls_first = {r["k"]: r["v"] for r in dedup_first(df, ["k"], [("s", "desc", False)]).collect()}
    assert nulls_first == {1: 3, 2: 4}


def test_landing_mode_infers_schema(spark, film_tables):
    """S1 without a schema (landing): columns come back alphabetical and the
    truncated file is one row holding only _corrupt_record."""
    from lakestrata.sources import raw_json
    cfg, _ = film_tables
    raw = raw_json.read_raw_json(spark, cfg.raw_glob, schema=None).cache()
    data_cols = [c for c in raw.columns if c != "_corrupt_record"]
    assert data_cols == sorted(data_cols)
    assert "_corrupt_record" in raw.columns
    assert raw.where(F.col("_corrupt_record").isNotNull()).count() == 1
    assert raw.count() == len(ARRAY_FILE) + 2


def test_raw_films_are_landed_compressed_and_read_back_whole(spark):
    from lakestrata.sources import raw_json
    landing = local_fs_path(scratch_path(spark, "landed_films"))
    films = spark.range(3000).selectExpr("id", "'PG-13' AS rating", "cast(id % 7 AS string) AS studio", "id / 4D AS budget")
    raw_json.land_json_arrays(films, landing, 4)
    import glob
    import os
    files = glob.glob(f"{landing}/bucket=*/*.txt.gz")
    assert len(files) == 4
    text = sum(len(r[0]) + 1 for r in films.selectExpr("to_json(struct(*))").collect())
    assert sum(map(os.path.getsize, files)) * 2 < text
    raw = raw_json.read_raw_json(spark, f"{landing}/*/*.txt*", films.schema, multi_line=True)
    assert sorted(map(tuple, raw.collect())) == sorted((*r, None) for r in films.collect())      # none is corrupt


def test_silver_carries_an_ordering_column_once(spark):
    from lakestrata.plans import standins
    lines = [(k % 9, k % 5, str(k % 3), float(k % 4), f"2024-01-0{1 + k % 7}") for k in range(60)]
    df = spark.createDataFrame(lines, "id long, seq long, studio string, budget double, ingested_at string") \
        .selectExpr("id", "'G' rating", "studio", "'2020-01-01' release_date", "budget", "seq",
                    "cast(ingested_at as timestamp_ntz) ingested_at")
    best = dedup_first(df, ["id"], standins.FILM_DEDUP_ORDER)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "min_by" not in plan                  # which takes the row and its place
    want = dedup_first(df, ["id"], standins.FILM_DEDUP_ORDER, method="window")
    assert sorted(map(tuple, best.collect())) == sorted(map(tuple, want.select(*best.columns).collect()))
