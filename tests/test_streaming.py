"""The ad streams against their batch twins (file source, availableNow trigger)."""

import os

import pytest

from pyspark.sql import functions as F

from visitflow.operators import ads as AD
from visitflow.plans import catalog as CAT
from visitflow.sources import adapters as A
from visitflow.sources.tables import Tables
from visitflow.streaming import AdStateStore, TrendStore, start_ad_stream, start_trend_stream

from paths import SF_SMALL


def _write_lines(spark, folder, name, df, mtime):
    rows = [r["value"] for r in df.collect()]          # sf0.001: a few hundred lines
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write("\n".join(rows) + "\n")
    os.utime(path, (mtime, mtime))


def _source(spark, scratch):
    t = Tables(spark, SF_SMALL)
    cut = F.lit(CAT.STREAM_CUT).cast("timestamp_ntz")
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    _write_lines(spark, src, "a.txt", A.ad_log_lines(t.events.where(F.col("ts") < cut), t.nation, t.region),
                 1_700_000_000)
    _write_lines(spark, src, "b.txt", A.ad_log_lines(t.events.where(F.col("ts") >= cut), t.nation, t.region),
                 1_700_000_100)
    return t, src


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_state_stream_equals_two_batch_twin(spark, scratch):
    t, src = _source(spark, scratch)
    root = os.path.join(scratch, "state")
    q = start_ad_stream(spark, src, root, threshold=CAT.BLACKLIST_THRESHOLD,
                        checkpoint=os.path.join(scratch, "ckpt"), options={"maxFilesPerTrigger": "1"},
                        trigger={"availableNow": True})
    q.awaitTermination(600)
    assert q.lastProgress is not None
    store = AdStateStore(spark, root)
    assert store.last_commit() == 1                     # two micro-batches: 0 and 1
    got, want = store.state(), CAT.two_batch_state(t)
    for field in ("counts", "blacklist", "stat", "top3"):
        assert _rows(getattr(got, field)) == _rows(getattr(want, field)), field

    # replaying a committed batch id changes nothing
    before = _rows(store.state().counts)
    own = AdStateStore(spark, root, owner=os.path.join(scratch, "ckpt"))
    assert own.apply(CAT.ad_clicks(t), 1, CAT.BLACKLIST_THRESHOLD) is False
    assert _rows(store.state().counts) == before

    # batches of another checkpoint, or plain ones, are not replays: they fail loudly
    with pytest.raises(RuntimeError, match="belongs to"):
        store.apply(CAT.ad_clicks(t), 1, CAT.BLACKLIST_THRESHOLD)
    q = start_ad_stream(spark, src, root, threshold=CAT.BLACKLIST_THRESHOLD, checkpoint=os.path.join(scratch, "other"),
                        trigger={"availableNow": True})
    with pytest.raises(Exception, match="belongs to"):
        q.awaitTermination(600)
    assert _rows(store.state().counts) == before


def test_plain_batch_ids_are_used_once(spark, scratch):
    t = Tables(spark, SF_SMALL)
    store = AdStateStore(spark, os.path.join(scratch, "plain"))
    assert store.apply(CAT.ad_clicks(t), 3, CAT.BLACKLIST_THRESHOLD)
    with pytest.raises(ValueError, match="not after"):
        AdStateStore(spark, os.path.join(scratch, "plain")).apply(CAT.ad_clicks(t), 3, CAT.BLACKLIST_THRESHOLD)


def test_a_failed_batch_leaves_nothing_behind(spark, scratch, monkeypatch):
    """A batch that dies before its commit is not seen; the next one takes its number and overwrites its rows."""
    from visitflow.streaming import ad_stream
    t = Tables(spark, SF_SMALL)
    store = AdStateStore(spark, os.path.join(scratch, "state"))
    first, rest = CAT.ad_clicks(t, end=CAT.STREAM_CUT), CAT.ad_clicks(t, start=CAT.STREAM_CUT)
    assert store.apply(first, 1, CAT.BLACKLIST_THRESHOLD)
    before = _rows(store.state().counts)
    with monkeypatch.context() as m:
        m.setattr(ad_stream, "top3_updates", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.apply(CAT.ad_clicks(t), 2, CAT.BLACKLIST_THRESHOLD)         # other rows and dates than the next batch
    assert store.last_commit() == 1 and _rows(store.state().counts) == before
    assert AdStateStore(spark, store.root).apply(rest, 7, CAT.BLACKLIST_THRESHOLD)
    got, want = store.state(), CAT.two_batch_state(t)
    for field in ("counts", "blacklist", "stat", "top3"):
        assert _rows(getattr(got, field)) == _rows(getattr(want, field)), field
    assert len(os.listdir(f"{store.root}/_commits")) <= 2                      # one file and its checksum
    # rewriting the tables as one batch changes no row, and batches go on after it
    store.compact()
    for field in ("counts", "blacklist", "stat", "top3"):
        assert _rows(getattr(store.state(), field)) == _rows(getattr(want, field)), field
    assert store.last_commit() == 7 and not os.path.exists(f"{store.root}/counts-0")
    assert store.apply(first.limit(0), 8, CAT.BLACKLIST_THRESHOLD) and _rows(store.state().stat) == _rows(want.stat)


def test_top3_of_a_batch_needs_no_whole_ranking(spark):
    """Random batches: old top 3 and the batch's ads give the ranking of everything so far, ties included."""
    import random
    random.seed(3)
    kept: list[tuple] = []
    top = spark.createDataFrame([], AD.STATE_SCHEMAS["top3"])
    for n in range(4):
        batch = [("2024-01-0" + str(random.randint(1, 2)), f"P{random.randint(1, 3)}", f"C{random.randint(1, 2)}", random.randint(1, 9),
                  random.randint(1, 3)) for _ in range(25 if n else 60)]
        delta = AD.ad_stat(spark.createDataFrame(batch, AD.STATE_SCHEMAS["stat"]))
        stat = spark.createDataFrame(kept, AD.STATE_SCHEMAS["stat"])
        from visitflow.operators.merge import merge_replace_group
        rows = _rows(merge_replace_group(top, AD.top3_updates(stat, top, delta), AD.PROVINCE_KEYS))
        kept += batch
        assert rows == _rows(AD.province_top3(spark.createDataFrame(kept, AD.STATE_SCHEMAS["stat"])))
        top = spark.createDataFrame(rows, AD.STATE_SCHEMAS["top3"])


@pytest.mark.parametrize("bits", [AD.FILTER_BITS, 32768])
def test_blacklist_bitmap_passes_no_member_and_few_others(spark, bits):
    clicks = CAT.ad_clicks(Tables(spark, SF_SMALL))
    users = clicks.select("user_id").where("user_id % 7 = 0").distinct().unionByName(spark.range(10**9, 10**9 + 2000).toDF("user_id"))
    marked = AD.possible_members(clicks, users, bits)
    member = F.col("user_id") % 7 == 0
    wrong, extra, others = marked.agg(F.count_if(member & ~F.col("possible")), F.count_if(~member & F.col("possible")),
                                      F.count_if(~member)).first()
    assert wrong == 0 and others > 0 and extra <= others * (0.2 if bits == 32768 else 0.02)
    got = AD.without_blacklisted(clicks, users, bits)
    assert _rows(got.select("ts", "user_id", "ad_id")) == _rows(clicks.where(~member).select("ts", "user_id", "ad_id"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "bitmap_construct_agg" in plan and "getbit" in plan


def test_trend_stream_goes_on_after_a_restart(spark, scratch):
    """The windows' state is RocksDB's, in the checkpoint: a new query on it adds to windows counted before."""
    t, src = _source(spark, scratch)
    root, ckpt = os.path.join(scratch, "trend"), os.path.join(scratch, "ck3")
    late = os.path.join(src, "b.txt")
    os.rename(late, os.path.join(scratch, "b.txt"))
    for part in range(2):
        q = start_trend_stream(spark, src, root, delay="40 days", checkpoint=ckpt, trigger={"availableNow": True})
        q.awaitTermination(600)
        if part == 0:
            lines = open(os.path.join(scratch, "b.txt")).read() + open(os.path.join(src, "a.txt")).read()
            with open(late, "w") as fh:
                fh.write(lines)                                                # the first file's minutes again
    assert any("rocksdb" in str(v).lower() for v in q.lastProgress["stateOperators"][0]["customMetrics"])
    clicks = CAT.ad_clicks(t)
    cut = F.lit(CAT.STREAM_CUT).cast("timestamp")
    assert _rows(TrendStore(spark, root).trend()) == _rows(AD.click_trend(clicks.unionByName(clicks.where(F.col("ts") < cut))))


def test_trend_stream_equals_batch_trend(spark, scratch):
    t, src = _source(spark, scratch)
    root = os.path.join(scratch, "trend")
    q = start_trend_stream(spark, src, root, delay="1 day", checkpoint=os.path.join(scratch, "ckpt2"),
                           options={"maxFilesPerTrigger": "1"}, trigger={"availableNow": True})
    q.awaitTermination(600)
    got = TrendStore(spark, root).trend()
    want = AD.click_trend(CAT.ad_clicks(t))
    assert _rows(got) == _rows(want)


def test_trend_stream_drops_events_behind_the_watermark(spark, scratch):
    import datetime as dt
    src = os.path.join(scratch, "late")
    os.makedirs(src)

    def ms(hh, mm):
        return int(dt.datetime(2024, 1, 1, hh, mm, tzinfo=dt.timezone.utc).timestamp() * 1000)

    # Late rows are judged against the watermark of the previous batch (Spark's rule for
    # chained stateful operators), so the late event comes in the third micro-batch.
    batches = [[f"{ms(10, 0)} ASIA NATION_2 1 4", f"{ms(10, 5)} ASIA NATION_2 1 4"],
               [f"{ms(10, 6)} ASIA NATION_2 3 4"],
               [f"{ms(9, 0)} ASIA NATION_2 2 4",            # 65 min behind the newest event: late
                f"{ms(10, 7)} ASIA NATION_2 3 4"]]
    for i, lines in enumerate(batches):
        path = os.path.join(src, f"{i}.txt")
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    root = os.path.join(scratch, "trend")
    q = start_trend_stream(spark, src, root, delay="10 minutes", checkpoint=os.path.join(scratch, "ck"),
                           options={"maxFilesPerTrigger": "1"}, trigger={"availableNow": True})
    q.awaitTermination(600)
    got = {(r["hour"], r["minute"]): r["click_count"] for r in TrendStore(spark, root).trend().collect()}
    assert got == {("10", "00"): 1, ("10", "05"): 1, ("10", "06"): 1, ("10", "07"): 1}
