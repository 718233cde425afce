"""Training batches of a stream against plain Python, with all limits and a restart between two runs."""

from collections import Counter, defaultdict

from citeloom.streaming import batches, incremental

#: A stream's own time begins in 1970.
BASE = 1_700_000_000_000
SF = "/root/testdata/sf0.001"


def simulated(rows, end, history, size, interval):
    """rows: (key, id, ms); end: what the stream's time has come to."""
    by_key, out = defaultdict(list), []
    for k, i, at in rows:
        by_key[k].append((at, i))
    for k, all_ in by_key.items():
        queue, n = [], 0

        def give(reason, queue, k=k):
            out.append((k, reason, len(queue), queue[0][1], queue[-1][1], queue[0][0], queue[-1][0], min(n, history)))

        for at, i in sorted(all_):
            if queue and at - queue[0][0] >= interval * 1000:
                give("interval", queue)
                queue = []
            n += 1
            queue.append((at, i))
            if len(queue) == size:
                give("size", queue)
                queue = []
        if queue and queue[0][0] + interval * 1000 <= end:
            give("interval", queue)
    return sorted(out)


def test_all_events(spark):
    rows = [(r.user_id, r.event_id, r.ms) for r in spark.read.parquet(f"{SF}/events.parquet").selectExpr("user_id", "event_id", "unix_millis(CAST(ts AS TIMESTAMP)) AS ms").collect()]
    got = sorted(map(tuple, batches.st03_batches(spark, SF).collect()))
    assert got == simulated(rows, max(r[2] for r in rows), batches.HISTORY, batches.BATCH, batches.INTERVAL)


def test_limits_and_restart(spark, tmp_path):
    """Key 1 is fast (size), 2 is slow (time), 3 has a history that overflows and a queue that waits over the restart."""
    rows = [(1, i, 1_000 * i) for i in range(47)] + [(2, 100 + i, 70_000 * i) for i in range(40)] + [(3, 200 + i, 400 * i + 5) for i in range(93)] + [(4, 900, 2_000_000), (5, None, 5), (None, 901, 6)]
    schema = "user int, id int, ms long"
    rows = [(k, i, BASE + ms) for k, i, ms in rows]
    cut = BASE + 30_000
    parts = [[r for r in rows if r[2] < cut], [r for r in rows if r[2] >= cut]]
    limits = {"history": 25, "batch": 10, "interval": 300}

    def go(folder, part):
        if part:
            spark.createDataFrame(part, schema).selectExpr("user", "id", "timestamp_millis(ms) AS ts").coalesce(1).write.mode("append").parquet(f"{tmp_path}/{folder}/in")
        stream = spark.readStream.schema("user int, id int, ts timestamp").parquet(f"{tmp_path}/{folder}/in")
        return sorted(map(tuple, batches.run(spark, batches.training_batches(stream, "user", "id", "ts", **limits), f"{tmp_path}/{folder}").collect()))

    whole = [r for r in rows if None not in r]
    end = max(r[2] for r in whole)
    want = simulated(whole, end, 25, 10, 300)
    assert go("once", rows) == want
    first = go("twice", parts[0])
    assert first == simulated([r for r in whole if r[2] < cut], max(r[2] for r in whole if r[2] < cut), 25, 10, 300)
    assert go("twice", parts[1]) == want  # what waited in queues went on
    assert go("twice", []) == want  # nothing new: nothing twice
    assert Counter(r[1] for r in want).keys() == {"size", "interval"} and max(r[7] for r in want) == 25
    assert spark.conf.get(batches.STORE, None) != batches.ROCKS
    assert incremental.PROGRAMS.keys() & batches.PROGRAMS.keys() == set()
