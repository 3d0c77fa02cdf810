"""The command-line programs on small raw files."""

import glob
import json

from quarry.cli import main
from tests.test_parsing import SAMPLE_LOG


def _read_parts(path, pattern="part-*"):
    out = []
    for f in sorted(glob.glob(f"{path}/{pattern}")):
        with open(f) as h:
            out += [ln.rstrip("\n") for ln in h if ln.strip()]
    return out


def test_wordcount(spark, tmp_path):
    src = tmp_path / "in.txt"
    src.write_text("The cat, the dog.\n dog!\n")
    main(["wordcount", str(src), str(tmp_path / "out")])
    assert _read_parts(tmp_path / "out") == ["cat 1", "dog 2", "the 2"]


def test_shortest_path(spark, tmp_path):
    d = tmp_path / "graph"
    d.mkdir()
    (d / "dijkstra.txt").write_text("1: 3 5\n2: 4\n3: 2 5\n4: 3\n5:\n6: 1 5\n")
    out = tmp_path / "sp"
    main(["shortest_path", str(d), str(out), "1", "4", "--trace"])
    assert _read_parts(out / "path") == ["1", "3", "2", "4"]
    assert _read_parts(out / "iter-0") == ["1,0.0,-1"]


def test_reddit_programs(spark, tmp_path):
    src = tmp_path / "c.json"
    src.write_text(
        '{"subreddit": "python", "author": "alice", "score": 5}\n{"subreddit": "python", "author": "bob", "score": 3}\n'
        '{"subreddit": "datascience", "author": "carol", "score": 10}\n{"subreddit": "datascience", "author": "dave", "score": 2}\n'
        'bad line\n'
    )
    main(["reddit_averages", str(src), str(tmp_path / "avg")])
    assert sorted(_read_parts(tmp_path / "avg")) == ['["datascience", 6.0]', '["python", 4.0]']
    main(["reddit_etl", str(src), str(tmp_path / "etl")])
    pos = [json.loads(x)["author"] for x in _read_parts(tmp_path / "etl/bucket=positive")]
    assert sorted(pos) == ["carol", "dave"]
    main(["relative_score", str(src), str(tmp_path / "rel"), "--broadcast"])
    rel = [x.split("\t") for x in _read_parts(tmp_path / "rel")]
    assert [a for _, a in rel] == ["carol", "alice", "bob", "dave"]
    assert [float(r) for r, _ in rel] == [10 / 6, 5 / 4, 3 / 4, 2 / 6]


def test_temp_range_and_logs(spark, tmp_path, capsys):
    src = tmp_path / "w.csv"
    src.write_text("S1,20240101,TMAX,251,,,,\nS1,20240101,TMIN,113,,,,\n")
    main(["temp_range", str(src), str(tmp_path / "tr"), "--sql"])
    assert _read_parts(tmp_path / "tr") == ["date,station,range", "20240101,S1,13.8"]
    logs = tmp_path / "logs.txt"
    logs.write_text("\n".join(SAMPLE_LOG) + "\n")
    main(["correlate_logs", str(logs)])
    out = capsys.readouterr().out
    assert "r = " in out and "r^2 = " in out
    main(["load_logs", str(logs), "ks", str(tmp_path / "table"), "--format", "parquet", "--spread", "2"])
    assert spark.read.parquet(str(tmp_path / "table")).count() == 10


def test_weather_programs(spark, tmp_path, capsys):
    from quarry.plans.q_models import daily_tmax
    from tests.conftest import SF_SMALL

    csv = str(tmp_path / "tmax")
    daily_tmax(spark, SF_SMALL).write.csv(csv)
    model = str(tmp_path / "model")
    main(["weather_train", csv, model])
    main(["weather_test", model, csv])
    main(["weather_tomorrow", model, "--station", "3", "--date", "2024-01-20", "--latitude", "0.3",
          "--longitude", "-0.43", "--elevation", "9", "--tmax", "120"])
    out = capsys.readouterr().out
    assert [x.split(":")[0] for x in out.splitlines() if x.startswith("Validation")] == [
        "Validation rmse (baseline)", "Validation r2 (baseline)", "Validation rmse (yesterday)", "Validation r2 (yesterday)"]
    assert "r2 = " in out and "Predicted tmax tomorrow:" in out


def test_pagecount_programs(spark, tmp_path, capsys):
    d = tmp_path / "pc"
    d.mkdir()
    (d / "pagecounts-20160801-120000").write_text("en A 10 1\nen B 10 1\nen Special:X 99 1\n")
    (d / "pagecounts-20160801-130000").write_text("en D 5 1\nen Main_Page 70 1\n")
    main(["wikipedia_popular_df", str(d), str(tmp_path / "df"), "--join", "broadcast"])
    rows = [json.loads(x) for x in _read_parts(tmp_path / "df")]
    assert [(r["hour"], r["title"], r["views"]) for r in rows] == [
        ("20160801-12", "A", 10), ("20160801-12", "B", 10), ("20160801-13", "D", 5)
    ]
    five = tmp_path / "five.txt"
    five.write_text("20160801-120000 en A 10 1\n20160801-120000 en B 12 1\n20160801-120000 en Special:Y 99 1\n")
    main(["wikipedia_popular", str(five), str(tmp_path / "wp"), "--with-title"])
    assert _read_parts(tmp_path / "wp") == ["20160801-120000\t(12, 'B')"]
    nums = tmp_path / "nums.txt"
    nums.write_text("1 2.5 x -3\n4\n")
    main(["numbersum", str(nums)])
    assert capsys.readouterr().out.strip() == "4.5"


def test_typed_json_and_weather_etl_and_colours(spark, tmp_path, capsys):
    src = tmp_path / "s.json"
    src.write_text('{"subreddit": "a", "score": 2}\n{"subreddit": "a", "score": 4}\n{"subreddit": "b", "score": "x"}\n')
    main(["reddit_average_df", str(src), str(tmp_path / "avg")])
    assert "a,3.0" in _read_parts(tmp_path / "avg")
    w = tmp_path / "w.csv"
    w.write_text("CA1,20240101,TMAX,215,,,,\nUS1,20240101,TMAX,100,,,,\n")
    main(["weather_etl", str(w), str(tmp_path / "etl")])
    got = [json.loads(x) for x in _read_parts_gz(tmp_path / "etl")]
    assert got == [{"station": "CA1", "date": "20240101", "tmax": 21.5}]
    colours = tmp_path / "colours.csv"
    import random

    rnd = random.Random(1)
    lines = []
    for word, (r, g, b) in {"red": (230, 20, 20), "green": (20, 200, 20), "blue": (20, 20, 230)}.items():
        for _ in range(40):
            lines.append(f"{r + rnd.randint(-20, 20)},{g + rnd.randint(-20, 20)},{b + rnd.randint(-20, 20)},{word},high")
    colours.write_text("\n".join(lines) + "\n")
    main(["colour_predict", str(colours)])
    out = capsys.readouterr().out
    assert "Validation score for RGB model" in out and "Validation score for LAB model" in out


def _read_parts_gz(path):
    import gzip

    out = []
    for f in sorted(glob.glob(f"{path}/part-*.gz")):
        with gzip.open(f, "rt") as h:
            out += [ln.rstrip("\n") for ln in h if ln.strip()]
    return out
