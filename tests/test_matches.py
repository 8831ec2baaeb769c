import glob
import json
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from matchlab.operators import elo, evaluation, history, ingest, quality, snapshots
from matchlab.plans import features
from matchlab.plans.queries import ORACLE_SQL, QUERIES
from matchlab.sources import schemas, stored, tables

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
SLOW = {"b13_ingest", "b13_ingest_onto", "b13_isolated_tournaments", "b9_parse_sets", "b10_parse_games", "g10_matchup_card"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(set(ORACLE_SQL) - SLOW))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    q = duck.sql(ORACLE_SQL[name])
    assert sorted(q.columns) == cols
    want = [dict(zip(q.columns, r)) for r in q.fetchall()]
    rows = lambda rs: sorted((tuple(0.0 if r[c] == 0 and isinstance(r[c], float) else r[c] for c in cols) for r in rs), key=repr)
    assert rows(df.collect()) == rows(want)


def _league(n=200, players=12, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b = r.sample(range(1, players + 1), 2)
        out.append((i, 1_000_000 + 1_800 * i, a, b, r.choice((a, b))))
    return pd.DataFrame(out, columns=["set_id", "completed_at", "player1_id", "player2_id", "winner_player_id"])


def test_elo_cases():
    assert elo.expected(1640, 1640) == 0.5
    assert abs(elo.expected(1700, 1500) - 1 / (1 + 10**-0.5)) < 1e-12 and abs(elo.expected(1280, 1333) + elo.expected(1333, 1280) - 1) < 1e-12
    r, n = {}, {}
    first = elo.fold(pd.DataFrame([(1, 10, 100, 200, 100)], columns=_league(1).columns), r, n)
    assert (first.p1_elo[0], first.p1_post[0], first.p2_post[0]) == (1500.0, 1532.0, 1468.0)
    assert n == {100: 1, 200: 1}


def test_elo_modes_agree_and_continue(spark):
    pdf = _league()
    df = spark.createDataFrame(pdf)
    want = elo.fold(pdf, {}, {}).set_index("set_id")
    for got in (elo.elo_ratings(df), elo.elo_ratings_sliced(df, seconds=90_000, every=2)):
        got = got.toPandas().set_index("set_id").sort_index()
        assert (got.p1_elo == want.p1_elo).all() and (got.p2_post == want.p2_post).all()
    a, b = df.filter("set_id < 120"), df.filter("set_id >= 120")
    rated = tables.staged(elo.elo_ratings(a), "test-elo")
    later = elo.elo_ratings(b, state=elo.end_state(a, rated)).toPandas().set_index("set_id").sort_index()
    assert (later.p1_elo == want.p1_elo[120:]).all()


def test_elo_slices_closed_by_the_graph(spark):
    r = random.Random(9)
    rows = []
    for i in range(600):  # ten groups that rarely meet
        g = r.randrange(10)
        a, b = r.sample(range(20), 2)
        other = g if r.random() < 0.97 else r.randrange(10)
        rows.append((i, 1000 + i // 2, 100 * g + a, 100 * other + b, 100 * g + a if r.random() < 0.6 else 100 * other + b))
    pdf = pd.DataFrame(rows, columns=_league(1).columns)
    want = elo.fold(pdf, {}, {}).set_index("set_id")
    cut = elo._parts(pdf.assign(slice=3), 0.3, 40)
    groups = cut.groupby("slice")
    assert len(groups) >= 3 and set(cut.slice // elo.FINER) == {3} and list(cut.set_id) == sorted(cut.set_id)
    for _, g in groups:
        before = elo._parts(g[:-1].assign(slice=0))  # the slice as it was before its last set
        assert g.part.nunique() > 1 and len(g) >= min(40, len(g))
        if len(g) > 40:
            assert before.groupby("part").size().max() <= 0.3 * len(before)
        pairs = list(zip(g.player1_id, g.player2_id, g.part))
        of = {}
        for p, q, part in pairs:
            assert of.setdefault(p, part) == part and of.setdefault(q, part) == part  # parts share no players
    got = elo.elo_ratings_sliced(spark.createDataFrame(pdf), most=250, share=0.3, least=40).toPandas().set_index("set_id").sort_index()
    assert (got.p1_elo == want.p1_elo).all() and (got.p2_post == want.p2_post).all() and len(got) == 600


def _hot_league(n=400):
    """Player 1 plays a third of the sets, most of them against player 2; some sets end at the same second."""
    pdf = _league(n)
    for i in range(0, n, 3):
        a, b = (1, 2) if i % 2 else (2 + i % 9, 1)
        pdf.loc[i, ["player1_id", "player2_id", "winner_player_id"]] = a, b, (a if i % 5 else b)
    pdf["completed_at"] = pdf.completed_at // 5000
    return pdf


@pytest.mark.parametrize("most", [3, 20, 150])
def test_history_by_segments_equals_the_window(spark, most):
    t = _tables_of(_hot_league(), spark)
    done = tables.staged(history.completed_sets(t["sets"], t["events"], t["tournaments"]), "test-done")
    want = history.history_features(done).orderBy("set_id")
    got = history.history_features(done, most=most).orderBy("set_id")
    assert sorted(got.columns) == sorted(want.columns) and got.select(want.columns).collect() == want.collect()
    long = history.long_form(done.withColumn("segment", history.segment_of(history.segment_cuts(done, 20))))
    shares = [r["count"] for r in long.groupBy("player_id", "segment").count().collect()]
    assert max(shares) <= 30 and long.filter("player_id = 1").count() > 130  # the hot player's rows go to many windows


def test_features_go_on_from_a_stored_state(spark, tmp_path):
    t = _tables_of(_hot_league(), spark)
    want = features.build_features(t).orderBy("set_id").collect()
    times = sorted({r["completed_at"] for r in want})
    cuts = [0, times[len(times) // 4], times[len(times) // 2], times[-3], times[-1] + 1]
    path, got = "file://" + str(tmp_path / "state"), []
    for a, b in zip(cuts, cuts[1:]):
        batch = t | {"sets": t["sets"].filter(f"completed_at >= {a} and completed_at < {b}")}
        got += features.continued_features(batch, path, most=60).collect()
    assert sorted(got, key=lambda r: r["set_id"]) == want
    players, pairs = features.read_state(spark, path)
    assert max(r["sets_played"] for r in players.collect()) > 130 and all(len(r["recent"]) == min(30, r["sets_played"]) for r in players.collect())
    assert pairs.agg({"sets": "sum"}).first()[0] == len(want)
    assert features.continued_features(t | {"sets": t["sets"].limit(0)}, path).count() == 0
    assert sorted(features.read_state(spark, path)[0].collect()) == sorted(players.collect())


def test_stored_table_keeps_versions_and_untouched_buckets(spark, tmp_path, monkeypatch):
    path = "file://" + str(tmp_path / "t")
    df = spark.createDataFrame([(i, i % 7, "first") for i in range(200)], "id long, v int, kept string")
    assert stored.write_table(df, path, ["id"], buckets=16) == 1
    files = lambda: json.loads(max(glob.glob(f"{tmp_path}/t/versions/*/*.json")) and open(max(glob.glob(f"{tmp_path}/t/versions/*/*.json"))).read())  # noqa: E731, SIM115
    one = json.loads(files()["about"])["files"]
    batch = spark.createDataFrame([(5, 100, "new"), (1000, 1, "new")], df.schema)
    assert stored.upsert_stored(path, batch, ["v"], ["kept"]) == 2
    two = json.loads(files()["about"])["files"]
    touched = {str(r[0]) for r in batch.select(stored.bucket_of(["id"], 16)).collect()}
    assert {b for b in two if one.get(b) != two[b]} == touched and len(touched) <= 2
    want = {i: (i % 7, "first") for i in range(200)} | {5: (100, "first"), 1000: (1, "new")}
    read = lambda **k: {r["id"]: (r["v"], r["kept"]) for r in stored.read_table(spark, path, **k).collect()}
    assert read() == want and read(version=1) == {i: (i % 7, "first") for i in range(200)}
    assert stored.upsert_stored(path, batch.limit(0), ["v"], ["kept"]) == 2

    def fails(*_):
        raise OSError("disk")

    with monkeypatch.context() as m:  # the new files are written, the manifest is not
        m.setattr(stored, "_publish", fails)
        with pytest.raises(OSError):
            stored.upsert_stored(path, df.withColumn("v", F.lit(-1)), ["v"])
    assert read() == want
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):  # a second writer of the same version
        stored._publish(spark, path, 2, {})
    assert stored.write_table(df.limit(0), "file://" + str(tmp_path / "none"), ["id"]) == 1 and stored.read_table(spark, "file://" + str(tmp_path / "none")).count() == 0


def test_stored_lookups_do_not_move(spark, tmp_path):
    r = random.Random(6)
    snap = spark.createDataFrame([(i, 1500.0 + i, 3 + i, 0.5) for i in range(300)], "player_id long, elo double, sets_played long, recent_wr double")
    h2h = spark.createDataFrame([(a, a + 1, 2, 1) for a in range(0, 300, 2)], "player_a long, player_b long, a_wins long, b_wins long")
    ask = spark.createDataFrame([(r.randrange(310), r.randrange(310)) for _ in range(500)] + [(4, 5), (5, 4)], "player1_id long, player2_id long").distinct()
    players, pairs = snapshots.store_lookups(snap, h2h, "test_lookups", "file://" + str(tmp_path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = snapshots.matchup_features(ask, players, pairs)
        plan = rows._jdf.queryExecution().executedPlan().toString().split("\n")
        assert sorted(rows.collect()) == sorted(snapshots.matchup_features(ask, snap, h2h).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scans = [i for i, line in enumerate(plan) if "FileScan" in line and "Bucketed: true" in line]
    assert len(scans) == 3
    for i in scans:
        level = depth(plan[i])
        for line in reversed(plan[:i]):
            if depth(line) < level:
                level = depth(line)
                assert "Exchange" not in line
                if "Join" in line:
                    break


def test_elo_of_queries_bounds_each_task(spark, monkeypatch):
    pdf = _league()
    want = elo.fold(pdf, {}, {}).set_index("set_id")
    got = elo.elo_ratings_bounded(spark.createDataFrame(pdf), most=30).toPandas().set_index("set_id").sort_index()
    assert (got.p1_elo == want.p1_elo).all() and (got.p2_post == want.p2_post).all() and len(got) == len(want)
    whole = elo.elo_ratings

    def pooled(sets, pool=None, state=None):
        assert pool
        return whole(sets, pool, state)

    for module in (elo, features):
        monkeypatch.setattr(module, "elo_ratings", pooled)
    for name in ("c3_elo_ratings", "c11_features"):
        assert QUERIES[name](spark, SF).count() == 469


def test_upsert_keeps_first_and_takes_last(spark):
    old = spark.createDataFrame([(1, 10, "a", 1), (2, 10, "b", 1)], "id long, event_id long, tag string, v int")
    new = spark.createDataFrame([(1, 99, "c", 0), (3, 30, "d", 5)], "id long, event_id long, tag string, v int")
    got = {r["id"]: (r["event_id"], r["tag"]) for r in tables.upsert(old, new, ["id"], ["v"], ["event_id"]).collect()}
    assert got == {1: (10, "c"), 2: (10, "b"), 3: (30, "d")}


def test_quality_reports_every_rule(spark):
    """One sound row, and for each rule a row that breaks it."""
    rows = features_of(_league(40), spark).collect()
    plain, names = rows[-1].asDict(), schemas.FEATURES.names
    table = lambda *rs: spark.createDataFrame([tuple(r[n] for n in names) for r in rs], schemas.FEATURES)
    assert quality.assert_valid(table(plain), quality.feature_rules(), schemas.FEATURES)
    zero = plain["p1_recent_wr"]
    breaks = {
        "completed_at > 0": {"completed_at": -7}, "p1_elo > 0": {"p1_elo": 0.0}, "p2_elo > 0": {"p2_elo": -3.5}, "p1_expected in [0, 1]": {"p1_expected": 1.25}, "p1_sets_played >= 0": {"p1_sets_played": -2}, "p2_sets_played >= 0": {"p2_sets_played": -1},
        "p1_recent_wr in [0, 1]": {"p1_recent_wr": zero - 2}, "p2_recent_wr in [0, 1]": {"p2_recent_wr": 1.5}, "recent_wr_diff in [-1, 1]": {"recent_wr_diff": -1.01}, "p1_h2h_wr in [0, 1]": {"p1_h2h_wr": 2.0},
        "num_attendees > 0": {"num_attendees": 0}, "p1_won in [0, 1]": {"p1_won": 7}, "two players": {"player1_id": plain["player2_id"]}, "seed difference": {"seed_diff": plain["seed_diff"] + 1},
        "h2h total is the sum": {"h2h_total": plain["h2h_total"] + 1}, "p1_h2h_wins >= 0": {"p1_h2h_wins": -1, "h2h_total": plain["p2_h2h_wins"] - 1 + 1, "p2_h2h_wins": plain["p2_h2h_wins"] + 1}, "event_id is not null": {"event_id": None}, "p2_elo is not null": {"p2_elo": None},
    }
    assert quality.assert_valid(table(plain | {"p1_seed": 0, "seed_diff": -plain["p2_seed"]}), quality.feature_rules())  # an unseeded player
    for rule, change in breaks.items():
        assert [r["rule"] for r in quality.validate(table(plain | change), quality.feature_rules()).collect()] == [rule], rule
    assert [r["rule"] for r in quality.validate(table(plain, plain), quality.feature_rules()).collect()] == ["unique set_id"]
    with pytest.raises(ValueError):
        quality.assert_valid(table(plain | {"p1_won": None}), quality.feature_rules())


def _tables_of(pdf, spark):
    sets = spark.createDataFrame(pdf).withColumnRenamed("set_id", "id").selectExpr("*", "id % 3 as event_id", "1 + id % 5 as player1_seed", "2 + id % 7 as player2_seed", "2.0D as player1_score", "1.0D as player2_score")
    events = spark.createDataFrame([(i, 9) for i in range(3)], "id long, tournament_id long")
    return {"sets": sets, "events": events, "tournaments": spark.createDataFrame([(9, "Spring Open", 64)], "id long, name string, num_attendees long")}


def features_of(pdf, spark):
    return features.build_features(_tables_of(pdf, spark)).orderBy("completed_at", "set_id")


def test_features_read_nothing_of_later_sets(spark):
    pdf = _league(90)
    later = pdf.copy()
    later.loc[60:, "winner_player_id"] = [a if w == b else b for a, b, w in later.loc[60:, ["player1_id", "player2_id", "winner_player_id"]].itertuples(index=False)]
    outcome = {"p1_won", "p1_score", "p2_score"}
    kept = [n for n in schemas.FEATURES.names if n not in outcome]
    a, b = (features_of(x, spark).select(*kept, "p1_won").collect() for x in (pdf, later))
    assert a[:60] == b[:60] and a[60]["p1_won"] != b[60]["p1_won"]
    assert [a[60][n] for n in kept] == [b[60][n] for n in kept] and a[61:] != b[61:]


def test_build_export_and_validation(spark, tmp_path):
    source = str(tmp_path / "in")
    for name, df in _tables_of(_league(50), spark).items():
        missing = [f for f in schemas.TABLES[name].fields if f.name not in df.columns]
        df.selectExpr("*", *(f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in missing)).write.parquet(f"{source}/{name}")
    for name in set(schemas.TABLES) - {"sets", "events", "tournaments"}:
        spark.createDataFrame([], schemas.TABLES[name]).write.parquet(f"{source}/{name}")
    rows = features.build_and_export(spark, source, str(tmp_path / "out"))
    assert rows.count() == 50 and rows.schema.names == schemas.FEATURES.names


def test_models_against_numpy(spark, tmp_path):
    from matchlab.operators import boosting, explain, export, modeling

    f = tables.staged(features_of(_league(400), spark), "test-features")
    m = modeling.train_logistic(f)
    x = np.array([[float(r[c]) for c in modeling.CORE] for r in f.orderBy("set_id").collect()])
    y = np.array([r["p1_won"] for r in f.orderBy("set_id").collect()], float)
    sd = x.std(0, ddof=1)
    z = np.where(sd > 0, (x - x.mean(0)) / np.where(sd > 0, sd, 1), 0)
    w, b = np.zeros(z.shape[1]), 0.0
    for _ in range(50):  # Newton on the mean loss with the penalty of half the squared weights over n
        p = 1 / (1 + np.exp(-(z @ w + b)))
        za = np.c_[z, np.ones(len(z))]
        g = za.T @ (p - y) / len(y) + np.r_[w, 0] / len(y)
        h = (za * (p * (1 - p))[:, None]).T @ za / len(y) + np.diag(np.r_[np.ones(len(w)), 1e-12]) / len(y)
        step = np.linalg.solve(h, g)
        w, b = w - step[:-1], b - step[-1]
    assert np.allclose(m.stages[-1].coefficients.toArray(), w, atol=1e-3) and abs(m.stages[-1].intercept - b) < 1e-3
    trees = modeling.train_boosted(f, trees=6, depth=3, min_hessian=1.0)
    margins = {"linear": m.transform(modeling._numbers(f)).orderBy("set_id").select(modeling.vector_to_array("rawPrediction")[1]).toPandas().to_numpy()[:, 0], "trees": trees.margin(x)}
    for model, margin in ((m, margins["linear"]), (trees, margins["trees"])):
        got = explain.explain(model, f, ["set_id"]).toPandas().set_index("set_id").sort_index()
        assert np.allclose(got.sum(axis=1), margin, atol=1e-9)
        chance = [r["prob"] for r in modeling.score(model, f).orderBy("set_id").collect()]
        assert np.allclose(chance, 1 / (1 + np.exp(-margin)), atol=1e-12)
    assert len(trees.trees) > 0 and abs(sum(r["importance"] for r in modeling.importances(trees).collect()) - 1) < 1e-9
    space = modeling.SPACE | {"trees": (2, 4, False), "depth": (2, 3, False), "min_hessian": (1, 3, False)}
    trials = modeling.tune(f, n_trials=3, space=space).collect()
    assert [r["best"] for r in trials].count(True) == 1 and max(trials, key=lambda r: r["auc"])["best"]
    cut = modeling.time_cut(f, 0.8)
    for r in trials:  # each trial by itself, and its score by counting pairs
        own = boosting.fit(f, modeling.CORE, [boosting.Setting(**{k: int(r[k]) if k in ("trees", "depth") else r[k] for k in space}, seed=42)], [(cut, cut, float("inf"))])[0]
        rows = [(v["prob"], v["p1_won"]) for v in modeling.score(own, f.filter(F.col("completed_at") >= cut)).collect()]
        pairs = [(p > q) + (p == q) / 2 for p, y in rows for q, z in rows if y == 1 and z == 0]
        assert len(own.trees) == r["fitted"] and abs(sum(pairs) / len(pairs) - r["auc"]) < 1e-9
    path = "file://" + str(tmp_path / "x")
    summary = export.export_model(m, explain.explain(m, f, ["set_id"]), ["set_id"], path)
    assert {r["feature"] for r in summary.collect()} == set(modeling.CORE)
    probs = lambda model: [r["prob"] for r in modeling.score(model, f).orderBy("set_id").collect()]
    assert probs(export.read_model(path)) == probs(m)
    export.export_model(trees, explain.explain(trees, f, ["set_id"]), ["set_id"], path)
    assert probs(export.read_boosted(spark, path)) == probs(trees)
    results, _ = modeling.run_all(f, split_ts=1_000_000 + 1_800 * 300, trees=3)
    log = export.log_runs(results, "models", path + "/runs")
    assert spark.read.parquet(path + "/runs").count() == log.count() == 3 * (5 + 4 + 1)
    given = {(r["name"], r["metric"]): r["value"] if r["text"] is None else r["text"] for r in spark.read.parquet(path + "/runs").collect()}
    assert given["seed baseline", "features"] == "seed_diff" and given["boosted trees", "features"].split(",") == modeling.CORE
    assert given["logistic", "min_sets"] == 5 and given["logistic", "train_size"] + given["logistic", "test_size"] == evaluation.active_rows(f).count()
    assert export.export_results(results, path).count() == 12


def test_served_predictions_are_the_model_s(spark):
    from matchlab.operators import explain, modeling

    t = _tables_of(_league(300), spark)
    f = tables.staged(features.build_features(t), "test-features")
    model = modeling.train_boosted(f, trees=4, depth=3, min_hessian=1.0)
    ask = t["sets"].select("player1_id", "player2_id").distinct()
    match = snapshots.matchup_features(ask, snapshots.player_snapshot(f), snapshots.h2h_records(t["sets"])).orderBy("player1_id", "player2_id").toPandas()
    margin = model.margin(match[modeling.CORE].to_numpy(float))
    got = snapshots.predict_matchups(model, ask, snapshots.player_snapshot(f), snapshots.h2h_records(t["sets"])).orderBy("player1_id", "player2_id").toPandas()
    p = 1 / (1 + np.exp(-margin))
    assert np.allclose(got.p1_win, p) and np.allclose(got.p2_win, 1 - p)
    assert (got.favourite == np.where(p > 1 - p, got.player1_id, got.player2_id)).all() and (got.underdog == np.where(p > 1 - p, got.player2_id, got.player1_id)).all()
    rows = spark.createDataFrame(match)
    shown = explain.explain_matchup(explain.explain(model, rows, ["player1_id", "player2_id"]), ["player1_id", "player2_id"]).toPandas()
    base = explain.explain(model, rows, ["player1_id", "player2_id"]).first()["base"]
    total = shown.groupby(["player1_id", "player2_id"]).value.sum().sort_index().to_numpy()
    assert len(shown) == 9 * len(match) and np.allclose(base + total, margin)
    assert ((shown.value > 0) == (shown.favors == "Favors player 1")).all()
    report = evaluation.importance_report(modeling.importances(model)).collect()
    assert len(report) == 9 and [r["importance"] for r in report] == sorted((r["importance"] for r in report), reverse=True)


def test_walk_forward_equals_a_loop_over_folds(spark):
    from matchlab.operators import boosting, modeling

    f = tables.staged(features_of(_league(500), spark), "test-features")
    setting = boosting.Setting(trees=5, depth=3, min_hessian=1.0)
    got = {r["fold"]: r for r in modeling.walk_forward_cv(f, 3, setting=setting).collect()}
    rows = evaluation.active_rows(f)
    pdf = rows.toPandas()
    cuts = [*pdf.completed_at.quantile([1 / 4, 2 / 4, 3 / 4]), pdf.completed_at.max() + 1]
    late = [float(pdf.completed_at[pdf.completed_at < c].quantile(0.9)) for c in cuts]
    edges = boosting.bin_edges(rows.filter(F.col("completed_at") < late[2]), modeling.CORE)
    for i in range(3):
        own = boosting.fit(rows, modeling.CORE, [setting], [(late[i], late[i], cuts[i])], edges=edges)[0]
        test = pdf[(pdf.completed_at >= cuts[i]) & (pdf.completed_at < cuts[i + 1])]
        p = 1 / (1 + np.exp(-own.margin(test[modeling.CORE].to_numpy(float))))
        r = got[str(i + 1)]
        assert (r["n"], r["train_size"]) == (len(test), (pdf.completed_at < cuts[i]).sum())
        assert abs(r["accuracy"] - ((p >= 0.5) == test.p1_won).mean()) < 1e-9 and abs(r["brier"] - ((p - test.p1_won) ** 2).mean()) < 1e-9
    assert set(got) == {"1", "2", "3", "mean"} and abs(got["mean"]["auc"] - np.mean([got[k]["auc"] for k in "123"])) < 1e-9


def _plain_booster(x, y, ids, held, s, edges):
    """Log odds of all rows, by a recursive booster over raw values."""
    from matchlab.operators import boosting

    n = int((~held).sum())
    margin = np.full(len(x), np.log((y[~held].sum() + 0.5) / (n - y[~held].sum() + 0.5)))
    worth = lambda g, h: max(abs(g) - s.alpha, 0) ** 2 / (h + s.lam)
    history = [margin]
    losses = []
    while True:
        p = 1 / (1 + np.exp(-margin))
        losses.append(-np.log(np.where(y > 0, p, 1 - p)[held]).mean())
        best = int(np.argmin(losses))
        if len(losses) > s.trees or len(losses) - 1 - best >= s.patience:
            return history[best], best
        g, h, step = p - y, p * (1 - p), np.zeros(len(x))
        columns = boosting.drawn_columns(x.shape[1], s, len(losses) - 1)

        def grow(rows, every, depth):
            top, split = 1e-6, None
            for f in columns if depth < s.depth else []:
                for e in edges[f]:
                    left = rows[x[rows, f] <= e]
                    gl, hl, ga, ha = g[left].sum(), h[left].sum(), g[rows].sum(), h[rows].sum()
                    gain = worth(gl, hl) + worth(ga - gl, ha - hl) - worth(ga, ha)
                    if len(left) not in (0, len(rows)) and min(hl, ha - hl) >= s.min_hessian and gain > top + 1e-9 * (split is not None):
                        top, split = gain, (f, e)
            if split is None:
                step[every] = -s.rate * np.sign(g[rows].sum()) * max(abs(g[rows].sum()) - s.alpha, 0) / (h[rows].sum() + s.lam)
            else:
                f, e = split
                for side in (True, False):
                    grow(rows[(x[rows, f] <= e) == side], every[(x[every, f] <= e) == side], depth + 1)

        grow(np.flatnonzero(~held & boosting.drawn(ids, s, len(losses) - 1)), np.arange(len(x)), 0)
        margin = margin + step
        history.append(margin)


def test_boosting_equals_a_plain_booster(spark):
    from matchlab.operators import boosting

    r = np.random.default_rng(0)
    x = np.round(r.normal(size=(400, 4)), 1)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + r.normal(0, 0.7, 400) > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, x[i]), int(y[i]), i) for i in range(400)], "set_id long, a double, b double, c double, d double, p1_won int, completed_at long")
    settings = [boosting.Setting(trees=10, depth=3, rate=0.3, min_hessian=2.0), boosting.Setting(trees=12, depth=5, rate=0.4, min_hessian=1.0, rows=1.0, columns=0.5, alpha=0.3, lam=3.0, patience=2), boosting.Setting(trees=2, depth=8, rate=0.5, rows=0.6, min_hessian=0.5)]
    spans = [(300, 300, 400)] * 3
    models = boosting.fit(df, list("abcd"), settings, spans, most_bins=256)
    ids = np.array([v[0] for v in df.orderBy("set_id").select(F.xxhash64("set_id")).collect()])
    for s, m in zip(settings, models):
        want, trees = _plain_booster(x, y, ids, np.arange(400) >= 300, s, [np.unique(c)[:-1] for c in x.T])
        assert len(m.trees) == trees and np.abs(m.margin(x) - want).max() < 1e-6
    again = boosting.fit(df.repartition(7), list("abcd"), settings, spans, most_bins=256, most_bytes=0, parts=5, store_every=3)  # sums meet in tasks, margins move more often
    assert all(np.array_equal(a.margin(x), b.margin(x)) for a, b in zip(models, again))
    assert models[0].jobs <= 4 + max(len(m.losses) * s.depth for s, m in zip(settings, models)) + 3
    none = boosting.fit(df.limit(0), list("abcd"), settings[:1], spans[:1])[0]
    assert none.trees == [] and none.base == 0.0


def test_attributions_equal_sums_over_sets():
    import itertools
    import math
    import time

    from matchlab.operators import boosting, explain

    r = np.random.default_rng(1)

    def made(depth, n):
        t = boosting.Tree(depth)
        t.cover[0] = 100.0
        for k in range(2**depth - 1):
            t.feature[k], t.threshold[k] = r.integers(n), r.normal()
            t.cover[2 * k + 1] = t.cover[k] * r.uniform(0.2, 0.8)
            t.cover[2 * k + 2] = t.cover[k] - t.cover[2 * k + 1]
        t.value[2**depth - 1 :] = r.normal(size=2**depth)
        return boosting.Boosted([f"f{i}" for i in range(n)], 0.1, [t], boosting.Setting(depth=depth))

    model, x = made(5, 6), r.normal(size=(20, 6))
    leaves = explain.tree_leaves(model)
    base, phi = explain.leaf_attributions(x, leaves)
    want = np.zeros_like(phi)
    for value, path in leaves:
        for f in path:
            rest = [j for j in path if j != f]
            for k in range(len(rest) + 1):
                for known in itertools.combinations(rest, k):
                    w = math.factorial(k) * math.factorial(len(rest) - k) / math.factorial(len(path))
                    for i in range(len(x)):
                        o = lambda j: float(path[j][0] < x[i, j] <= path[j][1])  # noqa: B023, E731
                        want[i, f] += w * value * (o(f) - path[f][2]) * math.prod(o(j) if j in known else path[j][2] for j in rest)
    assert np.allclose(phi, want) and np.allclose(model.base + base + phi.sum(1), model.margin(x))
    cost = {}
    for depth in (5, 8):
        leaves = explain.tree_leaves(made(depth, 9))
        t = time.process_time()
        explain.leaf_attributions(r.normal(size=(2000, 9)), leaves)
        cost[depth] = (time.process_time() - t) / len(leaves)
    assert cost[8] < 4 * cost[5]  # of a leaf


def test_percentiles(spark):
    r = random.Random(4)
    for values in ([5.0], [1.0, 2.0], [r.choice([r.random(), 3.0, -1e9]) for _ in range(301)]):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
        shares = [0, 0.1, 1 / 3, 0.5, 0.9, 1]
        assert np.allclose(evaluation.percentiles(df, "v", shares).first()["q"], np.quantile(values, shares))
    assert evaluation.percentiles(df.limit(0), "v", [0.5]).first()["q"] is None
    far = spark.createDataFrame([(float(i),) for i in range(2000)] + [(1e12,)] + [(7.0,)] * 500, "v double")  # a far value and a frequent one
    assert np.allclose(evaluation.percentiles(far, "v", shares).first()["q"], np.quantile([r["v"] for r in far.collect()], shares))
    per = far.groupBy(F.col("v").alias("x")).count()
    ranged = per.crossJoin(evaluation._borders(per, "x", 64)).select(evaluation._range("x").alias("r")).groupBy("r").count()
    assert ranged.agg({"count": "max"}).first()[0] < 0.05 * 2001


def test_auc_with_ties(spark):
    pred = spark.createDataFrame([(0.1, 0), (0.5, 1), (0.5, 0), (0.9, 1)], "prob double, p1_won int")
    assert evaluation.auc(pred).first()["auc"] == 3.5 / 4


def test_raw_nodes_and_rejects(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 5, "name": "T", "numAttendees": 80, "isOnline": false, "events": [{"id": 50, "name": "E", "videogame": {"id": 1}}]}\n{broken\n')
    nodes = tables.read_raw_nodes(spark, str(tmp_path), "tournaments")
    sets = spark.createDataFrame([], schemas.SET_NODE)
    out = ingest.ingest(nodes.cache(), sets)
    assert [r["id"] for r in out["events"].collect()] == [50]
    assert out["_rejects"].count() == 1


def test_models_are_registered_whole(spark, monkeypatch):
    from matchlab.operators import explain, export, modeling

    seen = {}
    monkeypatch.setattr(export, "log_runs", lambda *_: None)

    def note(name):
        def f(*args, **more):
            seen[name] = args, more
            return (args[0].limit(0), {}) if name == "run_all" else args[0].limit(0)

        return f

    for name in ("run_all", "tune", "train_boosted"):
        monkeypatch.setattr(modeling, name, note(name))
    monkeypatch.setattr(explain, "explain", lambda model, rows, keys: rows.limit(0))
    for name in ("e12_compare_models", "e16_tune", "e17_explain"):
        QUERIES[name](spark, SF)
    assert len(seen["run_all"][0]) == 2 and not seen["run_all"][1]
    for name in ("tune", "train_boosted"):
        assert len(seen[name][0]) == 1 and not seen[name][1]
    assert seen["tune"][0][0].agg({"completed_at": "max"}).first()[0] < seen["run_all"][0][1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_elo_slices_move_each_state_once(spark, monkeypatch):
    """A slice reads its own sets and its own players' state: nothing of earlier slices is rated or joined again."""
    pdf = _league(400, players=30)
    old = pd.DataFrame([(p, 1500.0 + p, p) for p in range(1, 20)] + [(99, 1700.0, 3)], columns=["player_id", "rating", "played"])
    want = elo.fold(pdf, dict(zip(old.player_id, old.rating)), dict(zip(old.player_id, old.played))).set_index("set_id")

    def again(*_):
        raise AssertionError("the state of all players was computed from a slice's ratings")

    monkeypatch.setattr(elo, "end_state", again)
    got = elo.elo_ratings_sliced(spark.createDataFrame(pdf), most=40, state=spark.createDataFrame(old)).toPandas().set_index("set_id").sort_index()
    assert (got.p1_elo == want.p1_elo).all() and (got.p2_post == want.p2_post).all() and (got.p2_played == want.p2_played).all() and len(got) == 400


def test_ingest_parses_each_node_once(spark):
    from matchlab.plans import queries
    from matchlab.sources.fixture import match_tables

    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def marked(x):
        seen.add(1)
        return x

    t = match_tables(spark, SF)
    nodes = tables.staged(queries._nodes(t), "nodes")
    n = nodes.count()
    out = ingest.ingest(queries._tournament_nodes(t), nodes.withColumn("state", marked("state").cast("int")), None, 200)
    for df in out.values():
        df.collect()
    assert 0 < seen.value <= n


def test_boosted_trees_by_column_end_in_the_same_nodes():
    from matchlab.operators import boosting

    r = np.random.default_rng(4)
    bins = r.integers(0, 200, (500, 6)).astype(np.uint8)
    columns = np.ascontiguousarray(bins.T).astype(np.int64)
    for depth in range(1, 7):
        t = boosting.Tree(depth)
        assert (t.by_column(columns) == t.by_bin(bins)).all()
        for i in range(2**depth - 1):
            if i == 0 or (t.feature[(i - 1) // 2] >= 0 and r.random() < 0.7):
                t.feature[i], t.bin[i] = r.integers(0, 6), r.integers(0, 200)
        assert (t.by_column(columns) == t.by_bin(bins)).all()
    # lots of one seed and tree serve models of different shares
    ids = r.integers(-(2**62), 2**62, 500)
    a, b = (boosting.drawn(ids, boosting.Setting(rows=x), 3, boosting.lots(ids, 42, 3)) for x in (0.3, 0.8))
    assert (a <= b).all() and (b == boosting.drawn(ids, boosting.Setting(rows=0.8), 3)).all()


def _no_histories(monkeypatch):
    def refused(*_, **__):
        raise AssertionError("histories of all rows are made")

    for module in (features, history):
        monkeypatch.setattr(module, "history_features", refused)


def test_rating_reports_make_no_histories(spark, monkeypatch):
    f = features.build_features(tables_of(spark)).select("set_id", "tournament_name", "player1_id", "player2_id", "p1_won", "p1_expected")
    want = sorted(map(tuple, f.collect()))
    got = features.rating_predictions(tables_of(spark)).select("set_id", "tournament_name", "player1_id", "player2_id", "p1_won", "prob")
    assert sorted(map(tuple, got.collect())) == want and len(want) == 469
    _no_histories(monkeypatch)
    for name in ("f2_confidence_buckets", "f3_probability_histogram", "f4_top_upsets"):
        assert QUERIES[name](spark, SF).count()


def test_snapshots_order_each_players_last_sets_alone(spark, monkeypatch):
    pdf = _league(400, 9).assign(completed_at=lambda x: x.completed_at // 9_000 * 9_000)  # many sets of one second; some players are new
    pdf.loc[399, ["player1_id", "player2_id", "winner_player_id"]] = [98, 99, 99]
    sets = spark.createDataFrame(pdf)
    rated = tables.staged(elo.elo_ratings(sets), "test-rated")
    rows = pdf.sort_values(["completed_at", "set_id"]).merge(rated.toPandas(), on="set_id")
    for after in (False, True):
        want = {}
        for p in {*pdf.player1_id, *pdf.player2_id}:
            mine = rows[(rows.player1_id == p) | (rows.player2_id == p)]
            won, last = (mine.winner_player_id == p).tolist(), mine.iloc[-1]
            i = 1 if last.player1_id == p else 2
            form = won[-30:] if after else won[:-1][-30:]
            want[p] = (last[f"p{i}_post" if after else f"p{i}_elo"], len(won) if after else len(won) - 1, sum(form) / len(form) if form else 0.5)
        assert {r[0]: tuple(r[1:]) for r in snapshots.snapshot_of_ratings(sets, rated, after=after).collect()} == want
    _no_histories(monkeypatch)
    for name in ("g1_player_snapshot", "g1_snapshot_after", "g6_rated_players", "g8_matchup_features"):
        assert QUERIES[name](spark, SF).count()


def tables_of(spark):
    from matchlab.sources.fixture import match_tables

    return match_tables(spark, SF)


def test_elo_folds_many_sets_a_step(monkeypatch):
    """Sets that share no player are rated together, as if one by one; a player of all sets goes one by one."""
    r = np.random.default_rng(3)
    p = r.integers(0, 400, 3000)
    q = (p + r.integers(0, 400, 3000)) % 400  # some against themselves
    pdf = pd.DataFrame({"set_id": r.permutation(3000), "completed_at": r.integers(0, 900, 3000), "player1_id": p, "player2_id": q, "winner_player_id": np.where(r.random(3000) < 0.6, p, q)})
    pdf.loc[:5, "player2_id"] = None  # no id: each a player without other sets
    start = {7: 1710.0, 8: 1444.5, 9999: 1.0}, {7: 50, 8: 3, 9999: 2}
    (want_r, want_n), (got_r, got_n) = (tuple(map(dict, start)) for _ in range(2))
    monkeypatch.setattr(elo, "LEAST_WIDTH", 10**9)
    want = elo.fold(pdf, want_r, want_n).set_index("set_id").sort_index()
    monkeypatch.setattr(elo, "LEAST_WIDTH", 4)
    plain = elo._one_by_one
    monkeypatch.setattr(elo, "_one_by_one", None)
    got = elo.fold(pdf, got_r, got_n).set_index("set_id").sort_index()
    assert np.abs(got - want).max().max() < 1e-9 and got.dtypes.equals(want.dtypes)
    ids = [*range(400), 9999]
    assert all(abs(got_r.get(i, 0) - want_r.get(i, 0)) < 1e-9 and got_n.get(i) == want_n.get(i) for i in ids)
    monkeypatch.setattr(elo, "_one_by_one", plain)
    star = pdf.assign(player1_id=1)
    assert np.isfinite(elo.fold(star, {}, {}).p1_post).all()
    assert len(elo.fold(pdf[:0], {}, {})) == 0


def test_folds_take_cuts_from_counts_and_rows_in_time_order(spark, monkeypatch):
    from matchlab.operators import boosting, modeling

    f = tables.staged(features_of(_league(500), spark), "test-features")
    times = f.groupBy("completed_at").agg(F.count("*").alias("n")).unionByName(f.groupBy("completed_at").agg(F.count("*").alias("n")))
    shares = [0.1, 0.37, 0.9]
    twice = evaluation.percentiles(f.unionByName(f), "completed_at", shares).first()["q"]
    assert evaluation.percentiles(times, "completed_at", shares, weight="n").first()["q"] == twice
    assert evaluation.walk_forward_cuts(times, 3, "n").collect() == evaluation.walk_forward_cuts(f.unionByName(f), 3).collect()
    edges = boosting.bin_edges(f, modeling.CORE)
    blocks = boosting._stored_blocks(f, modeling.CORE, edges, [0.0], "set_id", "p1_won", "completed_at", 3).collect()
    at = [np.frombuffer(b["at"]) for b in blocks]
    assert sum(map(len, at)) == f.count() and all((np.diff(x) >= 0).all() for x in at)
    # each model is given the margins of its own rows alone
    seen, plain = [], boosting._margins
    monkeypatch.setattr(boosting, "_margins", lambda stored, columns, trees: seen.append(len(stored)) or plain(stored, columns, trees))
    times = np.sort(np.concatenate(at))
    ask = boosting._Growing(boosting.Setting(), (times[50], times[50], times[60]), 0.0, len(modeling.CORE)).ask()
    batch = tables.staged(spark.createDataFrame(blocks, boosting.BLOCKS), "test-blocks").toArrow().to_batches()
    list(boosting._partial({0: ask}, 64)(batch))
    assert sum(seen) == 60


def test_boosted_blocks_are_read_a_few_at_once(spark, monkeypatch):
    """A block has the margins of all models, so a task's Python and Spark's reader hold few of them, whatever lies in a row group."""
    import math

    from matchlab.operators import boosting

    names = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before, real, seen = [spark.conf.get(k) for k in names], boosting._level, []

    def level(blocks, *args):
        seen.append([int(spark.conf.get(k)) for k in names])
        return real(blocks, *args)

    monkeypatch.setattr(boosting, "_level", level)
    df = spark.range(3000).selectExpr("id as set_id", "id as completed_at", "id % 7 as a", "cast(id % 7 > 3 as int) as p1_won")
    models = boosting.fit(df, ["a"], [boosting.Setting(trees=2, depth=2)] * 50, [(2000.0, 2000.0, math.inf)] * 50, parts=1)
    assert len(models) == 50 and seen
    assert all(x[0] <= 16 << 20 and x[1] * boosting.BLOCK_ROWS * 50 * 8 <= 16 << 20 for x in seen)
    assert [spark.conf.get(k) for k in names] == before
