"""Streams: last snapshot == batch answer; a restart resumes from the checkpoint."""

from pulsegraph.operators import heat as H
from pulsegraph.plans import q_stream
from pulsegraph.session import scratch_path
from pulsegraph.sources import tables as T
from pulsegraph.streaming import streams as S


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_stateful_restart_same_checkpoint(spark, sf):
    posts = T.posts(spark, sf)
    inp = scratch_path(spark, "r-in")
    out = scratch_path(spark, "r-out")
    ck = scratch_path(spark, "r-ck")
    a = posts.filter("post_id % 2 = 0")
    b = posts.filter("post_id % 2 = 1")
    a.repartition(2).write.parquet(inp)            # first two files
    S.run_to_end(S.running_account_measures(S.file_stream(spark, inp, posts.schema)), out, ck)
    first_last = S.all_snapshots(spark, out).agg({"batch_id": "max"}).first()[0]
    b.repartition(2).write.mode("append").parquet(inp)   # two more files arrive
    S.run_to_end(S.running_account_measures(S.file_stream(spark, inp, posts.schema)), out, ck)
    last = S.all_snapshots(spark, out).agg({"batch_id": "max"}).first()[0]
    assert last > first_last  # numbering continues after the restart
    assert _sorted(S.latest_snapshot(spark, out)) == _sorted(H.account_measure_totals(posts))


def test_mention_stream_update_mode_emits_changed_keys(spark, sf):
    pa = T.posts_at(spark, sf)
    inp = scratch_path(spark, "u-in")
    out = scratch_path(spark, "u-out")
    S.stage_files(pa, inp, 3)
    agg = S.running_mention_counts(S.file_stream(spark, inp, pa.schema), T.users(spark, sf))
    S.run_to_end(agg, out, scratch_path(spark, "u-ck"), output_mode="update")
    snaps = S.all_snapshots(spark, out)
    # the newest value of every key equals the batch count
    from pyspark.sql import functions as F, Window
    w = Window.partitionBy("name").orderBy(F.col("batch_id").desc())
    newest = snaps.withColumn("rk", F.row_number().over(w)).filter("rk = 1").select("name", "num")
    from pulsegraph.operators import mentions as M
    want = M.mention_counts(M.mentions_exploded(pa), T.users(spark, sf))
    assert _sorted(newest) == _sorted(want)


def test_monthly_sums_over_batches_of_random_rows(spark, sf):
    posts = T.posts(spark, sf)
    inp, out = scratch_path(spark, "m-in"), scratch_path(spark, "m-out")
    S.stage_files(posts, inp, 4)
    S.run_to_end(S.file_stream(spark, inp, posts.schema), out, scratch_path(spark, "m-ck"), output_mode="append",
                 transform=S.per_batch_monthly_measures)
    assert S.all_snapshots(spark, out).select("batch_id").distinct().count() == 4
    want = H.monthly_measures(posts)
    assert _sorted(S.summed_monthly_measures(S.all_snapshots(spark, out)).select(want.columns)) == _sorted(want)


def test_processing_time_trigger_keeps_running(spark, sf):
    posts = T.posts(spark, sf)
    inp = scratch_path(spark, "p-in")
    out = scratch_path(spark, "p-out")
    posts.limit(0).write.parquet(inp)  # empty folder with a schema
    q = S.run_to_end(S.running_account_measures(S.file_stream(spark, inp, posts.schema)),
                     out, scratch_path(spark, "p-ck"), processing_time="1 second")
    try:
        assert q.isActive
        posts.repartition(2).write.mode("append").parquet(inp)  # data arrives while it runs
        q.processAllAvailable()
        assert _sorted(S.latest_snapshot(spark, out)) == _sorted(H.account_measure_totals(posts))
    finally:
        q.stop()


def _batch(spark, rows):
    return spark.createDataFrame(rows, "k long, v long")


def test_merged_snapshots_survive_replays_and_crashes(spark, monkeypatch):
    out = scratch_path(spark, "merged")
    write = S.merged_writer(out, ["k"], compact_every=3, keep=2)
    state = {}
    for epoch in range(8):
        rows = [(k, 100 * epoch + k) for k in range(epoch, epoch + 3)] + [(None, epoch)]
        if epoch == 4:  # the data is there, the pointer is not
            with monkeypatch.context() as m:
                m.setattr(S, "write_pointer", lambda *a: (_ for _ in ()).throw(OSError("lost")))
                try:
                    write(_batch(spark, [*rows, (77, 77)]), epoch)
                except OSError:
                    pass
            assert _sorted(S.merged_snapshot(spark, out, ["k"]).na.fill(-1)) == sorted((-1 if k is None else k, v) for k, v in state.items())
        write(_batch(spark, rows), epoch)
        if epoch == 5:  # replayed after it was done
            write(_batch(spark, [(1, -1)]), epoch)
        state |= dict(rows)
        got = S.merged_snapshot(spark, out, ["k"])
        assert got.columns == ["k", "v"]
        assert {tuple(r) for r in got.collect()} == set(state.items())
        assert S.pointers(spark, out) == [n for n in (epoch, epoch + 1) if n]
    # two kept states: the base after 6 and the changes of 7 and 8
    assert sorted(n for n in S._names(spark, out) if "=" in n) == ["base=6", "changes=7", "changes=8"]


def test_merged_stream_resumes_after_a_lost_pointer(spark, sf, monkeypatch):
    posts = T.posts(spark, sf)
    inp, out, ck = (scratch_path(spark, f"x-{n}") for n in ("in", "out", "ck"))
    S.stage_files(posts, inp, 5)
    write, plain, calls = S.merged_writer(out, ["account"], compact_every=2), S.write_pointer, []

    def fails_once(spark, path, number, state):
        calls.append(number)
        if number == 3 and calls.count(3) == 1:
            raise OSError("lost")
        plain(spark, path, number, state)

    monkeypatch.setattr(S, "write_pointer", fails_once)
    run = lambda: S.run_to_end(S.running_account_measures(S.file_stream(spark, inp, posts.schema)), out, ck,
                               "update", writer=write)
    try:
        run()
    except Exception:
        pass
    assert S.pointers(spark, out)[-1] == 2
    run()
    assert calls == [1, 2, 3, 3, 4, 5]
    assert _sorted(S.merged_snapshot(spark, out, ["account"])) == _sorted(H.account_measure_totals(posts))


def test_registered_streams_run_several_batches(spark, sf):
    from pulsegraph.plans import q_stream
    from pulsegraph.plans import queries
    seen = []
    plain = S.merged_writer

    def counted(*args):
        write = plain(*args)
        return lambda batch, epoch: (seen.append(epoch), write(batch, epoch))

    S.merged_writer = counted
    try:
        queries()["stream_account_measures"](spark, sf).count()
    finally:
        S.merged_writer = plain
    assert seen == list(range(q_stream.BATCHES)) and q_stream.BATCHES >= 4


def test_stream_files_follow_the_bytes_of_the_table(spark, sf, monkeypatch):
    size, staged = q_stream.input_bytes(T.posts(spark, sf)), []
    stage = S.stage_files
    monkeypatch.setattr(q_stream, "FILE_BYTES", size // 10)
    monkeypatch.setattr(S, "stage_files", lambda df, path, n: (staged.append(n), stage(df, path, n)))
    got = q_stream.stream_account_measures(spark, sf)
    assert staged[0] >= 10
    assert _sorted(got) == _sorted(H.account_measure_totals(T.posts(spark, sf)))
