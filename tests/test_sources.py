import json

import pytest
from pyspark.sql import functions as F

from starsift.operators import mismatch, ratings
from starsift.sources import indicator, reviews, sinks, workspace

# Invented values.
INDICATOR = '''"Data Source","World Development Indicators",

"Last Updated Date","2025-01-01",

"Country Name","Country Code","Indicator Name","Indicator Code","1995","1996","1997","1998","1999","2000","2001",
"Korea, Rep.","KOR","Inflation, consumer prices (annual %)","FP.CPI.TOTL.ZG","4.0","4.0","4.0","7.0","0.8","2.2","4.0",
"United States","USA","Inflation, consumer prices (annual %)","FP.CPI.TOTL.ZG","2.8","2.9","2.3","","2.2","3.4","2.8",
"United States","USA","Something else","ZZ.OTHER","1","1","1","1","1","1","oops",
'''


def test_indicator(spark, rows, tmp_path):
    path = tmp_path / "rates.csv"
    path.write_text(INDICATOR)
    assert rows(indicator.read_indicator(spark, str(path))) == [
        (1995, 2.8), (1996, 2.9), (1997, 2.3), (1999, 2.2), (2000, 3.4), (2001, 2.8),
    ]
    assert len(rows(indicator.read_indicator(spark, str(path), "KOR"))) == 7
    other = indicator.read_indicator(spark, str(path), "USA", "ZZ.OTHER")
    assert [y for y, _ in rows(other)] == [1995, 1996, 1997, 1998, 1999, 2000]
    assert rows(indicator.read_indicator(spark, str(path), "XXX")) == []


def test_ingest_keeps_broken_lines_and_names_the_category(spark, rows, tmp_path):
    good = {"rating": 4.0, "text": "fine", "user_id": "u", "timestamp": 5, "asin": "a", "helpful_vote": 2}
    (tmp_path / "Gift_Cards.jsonl").write_text(json.dumps(good) + "\nnot json\n")
    folder = tmp_path / "All_Beauty_reviews"
    folder.mkdir()
    (folder / "part-0.json").write_text(json.dumps({**good, "rating": "many"}) + "\n")
    df = reviews.ingest_jsonl(spark, [str(tmp_path / "Gift_Cards.jsonl"), str(folder)])
    got = rows(df, "category", "rating", F.col("_corrupt_record").isNotNull())
    assert got == [("All_Beauty", None, True), ("Gift_Cards", 4.0, False), ("Gift_Cards", None, True)]


def test_stage_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "category STRING, year INT, text STRING")
    path = str(tmp_path / "stage")
    sinks.write_parquet(df, path, ["category", "year"])
    back = reviews.read_reviews(spark, path)
    assert rows(back, "category", "year", "text") == rows(df)
    assert (tmp_path / "stage" / "category=a" / "year=2").is_dir()
    sinks.write_parquet(df.limit(0), path)
    assert reviews.read_reviews(spark, path).count() == 0


def test_report_is_one_file_in_order(spark, tmp_path):
    path = tmp_path / "report"
    df = spark.createDataFrame([(3, 'say "hi"'), (1, "a,b"), (2, None)], "rating INT, text STRING")
    sinks.write_report(df.repartition(3), str(path), order_by=["rating"])
    (part,) = path.glob("part-*.csv")
    assert part.read_text().splitlines() == ["rating,text", '1,"a,b"', "2,", '3,"say ""hi"""']
    sinks.write_report(df.repartition(3), str(path), order_by=["rating"], single_file=False)
    assert spark.read.option("header", True).csv(str(path)).count() == 3


def test_report_formats(spark, tmp_path):
    scored = spark.createDataFrame(
        [(1, 1.0, 5, 0.75, "good, really"), (2, 1.0, 1, 0.5, "bad"), (3, 2.0, 2, 0.25, "so so")],
        "review_id INT, rating DOUBLE, sentiment_star INT, sentiment_conf FLOAT, text STRING",
    )

    def written(df, columns, **options):
        path = tmp_path / columns[1]
        sinks.write_report(df.select(*columns), str(path), **options)
        (part,) = path.glob("part-*.csv")
        return part.read_text().splitlines()

    summary = written(ratings.rating_summary(scored), ratings.REPORT_COLUMNS, order_by=["rating"])
    assert summary == ["rating,avg_sentiment_star,avg_abs_diff,count", "1.0,3.0,2.0,2", "2.0,2.0,0.0,1"]
    assert written(mismatch.top_mismatches(scored), mismatch.REPORT_COLUMNS) == [
        "rating,sentiment_star,sentiment_conf,diff,abs_diff,text",
        '1.0,5,0.75,4.0,4.0,"good, really"',
    ]


def test_topic_sinks_keep_arrays(spark, tmp_path):
    df = spark.createDataFrame([(1, ["c"]), (0, ["a", "b"])], "Topic INT, Representation ARRAY<STRING>")
    sinks.write_topics(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).orderBy("Topic").first()["Representation"] == ["a", "b"]
    sinks.write_topics_csv(df, str(tmp_path / "c"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    assert [json.loads(r["Representation"]) for r in back.collect()] == [["a", "b"], ["c"]]


def test_written_tables_come_and_go(spark):
    table = workspace.materialize(spark.range(10), "numbers")
    assert table.count() == 10
    assert all(workspace.shared_folder(spark) in f for f in table.inputFiles())
    folder = table.inputFiles()[0].rsplit("/", 1)[0]
    workspace.discard(table)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)


def test_indicator_reads_every_year(spark, tmp_path):
    years = list(range(1000, 2000))
    lines = ['"Source","x",', "", ",".join(["Country Name", "Country Code", "Name", "Code", *map(str, years)])]
    lines += [",".join([c, c, "n", "i", *[str(y / 10 + k) for y in years]]) for k, c in enumerate(("USA", "FRA"))]
    (tmp_path / "wide.csv").write_text("\n".join(lines))
    got = indicator.read_indicator(spark, str(tmp_path / "wide.csv")).orderBy("year").collect()
    assert [(r["year"], r["rate"]) for r in got] == [(y, y / 10) for y in years]


@pytest.mark.parametrize("write, suffix", [("write_parquet", "zstd.parquet"), ("write_lines", "txt.gz")])
def test_partitioned_writes_move_no_row(spark, tmp_path, rows, write, suffix, monkeypatch):
    """Each task writes its own values, compressed and in its order; too many values are sorted."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    df = spark.range(60).selectExpr("string(id) || ' text' AS value", "id % 4 AS k").repartition(3)
    for writers in (64, 2):
        monkeypatch.setattr(sinks, "WRITERS", writers)
        path = tmp_path / str(writers)
        getattr(sinks, write)(df, str(path), ["k"])
        back = (spark.read.parquet if write == "write_parquet" else spark.read.text)(str(path))
        assert rows(back, "value", "k") == rows(df, "value", "k")
        files = [f.name for f in path.glob("k=*/part-*")]
        assert len(files) == 12 and all(f.endswith(suffix) for f in files)
    assert spark.conf.get(setting) == before
