"""Hashes over many doubles and numbers of rows: what their plans hold."""

from pyspark.sql import functions as F

from tidemark.functions.casts import double_text
from tidemark.functions.hashing import row_hash
from tidemark.operators.ids import assign_ids


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_run_of_doubles_has_one_text_expression(spark):
    names = [f"d{i}" for i in range(14)]
    df = spark.range(5).select(F.col("id"), *[
        (F.when(F.col("id") != i % 5, F.col("id") * 10.0 ** (i - 6) / 4)).alias(n)
        for i, n in enumerate(names)])
    items = [names[0], "id", *names[1:]]
    hashed = df.select("*", row_hash(df.schema, items).alias("h"))
    assert _plan(hashed).count("decimal(38,22)") == 2      # two runs of doubles
    # the same text as column by column
    text = lambda n: F.coalesce(double_text(F.col(n)) if n != "id" else F.col(n).cast("string"), F.lit(""))
    plain = F.md5(F.concat_ws("|", *[text(n) for n in items]))
    assert hashed.where(F.col("h") != plain).count() == 0


def test_numbered_rows_are_not_shuffled_to_meet_their_offsets(spark):
    got = assign_ids(spark.range(1000).withColumnRenamed("id", "x"), ["x"], base=5)
    assert "Exchange hashpartitioning" not in _plan(got)
    assert got.where("id <> x + 6").count() == 0


def test_inserted_rows_are_numbered_by_key(spark, scratch):
    import datetime as dt
    import random
    from tests.test_key_summary import _batch, _entity
    from tidemark.plans.jobs import fold_batch, run_sync
    from tidemark.sources.store import TableStore
    store, e, rng, high = TableStore(spark, scratch), _entity("scd2"), random.Random(5), 0
    for run in range(2):
        batch = _batch(spark, rng, 90, 100 * run)
        _, state, _ = run_sync(spark, store, e, batch, order_by="seq",
                               run_ts=dt.datetime(2024, 1, 1 + run))
        new = state.where(F.col("id") > high).collect()
        assert sorted(r.id for r in new) == list(range(high + 1, high + 1 + len(new)))
        whole = [r for r in sorted(new, key=lambda r: r.id) if None not in (r.a, r.b)]
        assert [(r.a, r.b, r.occurrence_number) for r in whole] == sorted(
            (r.a, r.b, r.occurrence_number) for r in whole)
        high += len(new)
        assert store.max_id(e.table) == high == state.count()
    # what a run keeps in memory is a row per key, not its whole rows
    result = fold_batch(e, state, e.prepare(batch, seq="seq"), dt.datetime(2024, 1, 3), ordered=True)
    assert "level" not in result.classified.columns
    assert result.classified.count() == result.classified.select("a", "b").distinct().count()


def test_number_groups(spark):
    from tidemark.operators.ids import number_groups
    groups = spark.range(500).select("id", (F.col("id") % 4 + 1).alias("n")).repartition(7)
    got, last = number_groups(groups, ["id"], "n", base=10)
    at = 10
    for r in got.sort("id").collect():
        assert r._start == at
        at += r.n
    assert last == at
    assert number_groups(groups.limit(0), ["id"], "n", base=3)[1] == 3
