"""Scans of text files: lines stay where they are read, and are parsed once."""

from __future__ import annotations

from matchwright.sources import feed, files


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _drop(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return f"{tmp_path}/{name}"


def test_lines_are_not_shuffled_by_their_file(spark, tmp_path):
    paths = [_drop(tmp_path, "a.csv", 'x,y\n1,"a,b"\n2,\nx,y\n'), _drop(tmp_path, "b.csv", "y,z,x\nc,d,3\nshort\n")]
    df = files.read_text_csv(spark, paths)
    plan = _plan(df)
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    got = {(r.x, r.y, r.z, r._ragged) for r in df.collect()}
    assert got == {("1", "a,b", None, None), ("2", None, None, None), ("3", "c", "d", None), (None, "short", None, "short")}
    assert plan.count("from_csv") == 1


def test_tagging_with_the_season_does_not_shuffle(spark, tmp_path):
    header = "ATP,Location,Tournament,Date,Series,Court,Surface,Round,Best of,Winner,Loser,WRank,LRank,Wsets,Lsets,Comment"
    row = "1,Here,Open,1/2/2010,ATP250,Outdoor,Hard,The Final,3,A B.,C D.,1,2,2,0,Completed"
    drops = {("atp", y): _drop(tmp_path, f"{y}.csv", f"{header}\n{row}\n") for y in (2010, 2011)}
    headers = {d: {f: h for f, h in files.headers_of(spark, [p]).items()} for d, p in drops.items()}
    df = feed.scan_raw(spark, drops, landed=feed.Landed(headers, []))
    assert "Exchange hashpartitioning" not in _plan(df)
    assert sorted((r.Year, r.Winner) for r in df.collect()) == [(2010, "A B."), (2011, "A B.")]
