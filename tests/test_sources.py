"""NDJSON lines, trigger parsing and JDBC predicate construction."""

import os

from pyspark.sql import functions as F

from linecast.sources.jdbc import hash_predicates
from linecast.sources.props import broken_lines, read_props, split_props
from linecast.sources.triggers import parse_triggers, route_triggers


def test_props_schema_and_bad_lines(spark, tmp_dir):
    path = f"{tmp_dir}/props.json"
    with open(path, "w") as fh:
        fh.write('{"player_name": "Ann Example", "stat": "assists", "line": 4, "game_date": "2031-02-03", "team": "AAA"}\n')
        fh.write('{"player_name": "Bob Sample", "stat": "threes", "line": 2.5, "game_date": "2031-02-03", "team": "BBB"}\n')
        fh.write('not json\n')
    df = read_props(spark, path)
    assert dict(df.dtypes)["line"] == "double"
    rows = df.collect()
    assert len(rows) == 3 and rows[0].line == 4.0 and rows[2].player_name is None
    assert broken_lines(spark, path) == 1


def test_quarantine_reads_the_files_once(spark, tmp_dir):
    good = '{"player_name": "Ann Example", "stat": "assists", "line": 4, "game_date": "2031-02-03", "team": "AAA"}'
    os.makedirs(path := f"{tmp_dir}/lines")
    for name, lines in {"a.json": [good, "", "not json", "{}", "null"], "b.json": ['{"player_name": "Bob', "   ", good, '{"line": "x"}']}.items():
        with open(f"{path}/{name}", "w") as fh:
            fh.write("\n".join(lines) + "\n")
    lines, broken = split_props(spark, path)
    # Both come from the checkpointed copy: the files may go.
    os.remove(f"{path}/a.json")
    os.remove(f"{path}/b.json")
    assert sorted((r.player_name or "", r.line or 0.0) for r in lines.collect()) == [("", 0.0), ("Ann Example", 4.0), ("Ann Example", 4.0)]
    got = sorted((r.file.rsplit("/", 1)[1], r.text) for r in broken.collect())
    assert got == [("a.json", "not json"), ("a.json", "null"), ("b.json", '{"line": "x"}'), ("b.json", '{"player_name": "Bob')]
    assert "FileScan" not in lines._jdf.queryExecution().executedPlan().toString()


def test_scan_of_written_lines_equals_the_registered_key(spark, tmp_dir):
    """The key parses the same text that an NDJSON file holds: scan one."""
    from linecast.plans import queries
    from linecast.sources import fixtures as fx
    from tests.conftest import SF_SMALL

    path = f"{tmp_dir}/ndjson"
    fx.props(spark, SF_SMALL).write.json(path)
    scanned = queries.finalize(read_props(spark, path))
    key = queries.registered()["scan_props"](spark, SF_SMALL)
    assert sorted(map(tuple, scanned.collect())) == sorted(map(tuple, key.select(*scanned.columns).collect()))
    assert broken_lines(spark, path) == 0


def test_trigger_parse_and_route(spark):
    msgs = spark.createDataFrame(
        [('{"job_type": "prop_bet_analysis", "timestamp": "2031-02-03T00:00:00Z"}',),
         ('{"job_type": "other"}',), ('{bad',), ('{"job_type": 1}',)], "v string"
    ).select(F.current_timestamp().alias("timestamp"), F.col("v").cast("binary").alias("value"))
    parsed = parse_triggers(msgs).collect()
    assert [r.job_type for r in parsed] == ["prop_bet_analysis", "other", None, "1"]
    assert route_triggers(parse_triggers(msgs)).count() == 1


def test_hash_predicates_partition_every_id(spark):
    preds = hash_predicates("personid", 4)
    df = spark.createDataFrame([(-7,), (-1,), (0,), (3,), (8,), (None,)], "personid long")
    hits = [df.filter(p).count() for p in preds]
    assert sum(hits) == df.count() and all(h <= 2 for h in hits)
