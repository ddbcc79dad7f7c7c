"""The reference's named views over a small store."""

import datetime as dt

from test_entities import GOALIE, ROSTER, goalie, roster
from test_jobs import SKATER_STAGING, skater

from staged import run_sync
from tidemark.plans.views import VIEWS, view
from tidemark.sources.store import TableStore

D1, D2 = dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 2)


def test_named_views(spark, scratch):
    store = TableStore(spark, scratch)
    sk = lambda rows: spark.createDataFrame([r for r, _ in rows], SKATER_STAGING)
    run_sync(spark, store, "skaters", sk([skater(1, 5), skater(2, 3)]), run_ts=D1)
    run_sync(spark, store, "skaters", sk([skater(1, 6), skater(2, 3)]), run_ts=D2)
    g = spark.createDataFrame([goalie(1, 5)], GOALIE)
    run_sync(spark, store, "goalies", g, run_ts=D1)
    r = spark.createDataFrame([roster(1, "TOR", "forwards", 34.0)], ROSTER)
    run_sync(spark, store, "current_rosters", r, run_ts=D1)
    for name in VIEWS:
        df = view(spark, store, name)
        if df is not None:
            df.count()
    stints = view(spark, store, "skaters_multiple_stints").collect()
    assert [(x["goals"], x["prev_goals"]) for x in stints] == [(5, None), (6, 5)]
    stats = view(spark, store, "get_occurrence_stats").collect()
    assert len(stats) == 1 and stats[0]["player_id"] == 1 and stats[0]["team"] == "TOR"
    assert stats[0]["stat_progression"] == "Games: 10->10, Goals: 5->6, Points: 6->7"
    assert stats[0]["date_range"] == "2024-05-01 to 2024-05-02"
    summ = view(spark, store, "skaters_etl_summary")
    assert "updated_records" not in summ.columns and summ.count() == 2
    assert view(spark, store, "rosters_etl_summary").columns[6] == "deactivated_records"
    assert view(spark, store, "games_by_date").count() == 0
    assert view(spark, store, "team_roster_summary").first()["active_forwards"] == 1
