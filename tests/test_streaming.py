"""The streamed answer, across a restart from the checkpoint, against plain Python."""

from datetime import datetime, timedelta, timezone

from greenledger.streaming import submissions

SCHEMA = "site string, submitted_at timestamp, submission_id long, value string"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def land(spark, folder, k, rows):
    data = [(s, START + timedelta(hours=h), i, v) for s, h, i, v in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{folder}/in{k}")


def brute(batches, delay):
    best, count, late, top = {}, {}, [], None
    for rows in batches:
        for s, h, i, v in rows:
            if top is not None and h < top - delay:
                late.append((s, h, i, v))
                continue
            best[s] = max(best.get(s, (-1, -1, "")), (h, i, v))
            count[s] = count.get(s, 0) + 1
        top = max([h for _, h, _, _ in rows] + ([] if top is None else [top]))
    return sorted([(s, *best[s], count[s], "CURRENT") for s in best] + [(*r, None, "LATE") for r in late], key=repr)


def test_a_restarted_stream_gives_the_batch_answer(spark, tmp_path):
    batches = [[("a", 1, 1, "x"), ("a", 5, 2, "y"), ("b", 3, 3, "z")], [("a", 5, 9, "tie"), ("a", 4, 4, "old"), ("b", 30, 5, "w")],
               [("a", 6, 6, "late"), ("a", 25, 7, "new"), ("c", 2, 8, "late too")], [("b", 29, 10, "behind"), ("c", 40, 11, "first")]]
    landing, out, mark = (str(tmp_path / n) for n in ("landing", "out", "mark"))

    def go():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{landing}/in*")
        submissions.start(stream, ["site"], "10 hours", out, mark).awaitTermination()
        rows = submissions.answer(spark.read.parquet(out), ["site"]).collect()
        hours = [(r.site, round((r.submitted_at.astimezone(timezone.utc) - START).total_seconds() / 3600), *tuple(r)[2:]) for r in rows]
        return sorted(hours, key=repr)

    for k in (0, 1):
        land(spark, landing, k, batches[k])
    assert go() == brute(batches[:2], 10)
    for k in (2, 3):  # after a stop the query goes on where it was, with its state and its watermark
        land(spark, landing, k, batches[k])
    got = go()
    assert got == brute(batches, 10)
    assert len([r for r in got if r[-1] == "LATE"]) == 2


def test_state_is_held_by_bucket_not_by_key(spark, tmp_path):
    """Three rounds over more keys than there are buckets: one state row, and one call of Python, a bucket."""
    n = 2 * submissions.BUCKETS
    batches = [[(f"k{i}", (7 * i + b) % 10, b * n + i, str(i % 3)) for i in range(b, n, b + 1)] for b in range(3)]
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    for k, rows in enumerate(batches):
        land(spark, landing, k, rows)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{landing}/in*")
    query = submissions.start(stream, ["site"], "100 hours", out, str(tmp_path / "mark"))
    query.awaitTermination()
    got = {r.site: (r.submission_id, r.submission_count) for r in submissions.answer(spark.read.parquet(out), ["site"]).collect()}
    want = {s: (i, count) for s, _, i, _, count, _ in brute(batches, 100)}
    assert got == want and len(got) == n
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= submissions.BUCKETS
