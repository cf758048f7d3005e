"""Latest submission per key over a stream, with a quarantine for late ones.

The batch answer, latest submission wins, kept up to date as submissions come in. The
watermark is the latest event time of the batches before, less the delay allowed; what
is older than that when it comes is late: it changes no answer and is quarantined, so
that every submission is either counted or found there. Keys are dealt into a fixed number
of buckets, so that Python is called for a bucket and not for every key; state is one row
per key, those of a bucket held as one table. Every
micro-batch writes its rows under its own number and writes the same rows again after a
failure, so that a query that is restarted from its checkpoint loses and doubles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

#: Columns beside the key: what a submission has, and what the answer adds.
SUBMISSION = ["submitted_at", "submission_id", "value"]
CURRENT, LATE = "CURRENT", "LATE"

# Buckets that keys are dealt into, fixed as a checkpoint's state is held by
# them, and the column that names them.
BUCKETS, BUCKET = 1024, "_bucket"


def latest_submissions(stream: DataFrame, key: Sequence[str], delay: str) -> DataFrame:
    """A stream of (key.., submitted_at, submission_id, value, submission_count, kind): after each
    micro-batch the CURRENT row of every key that it changed, and its LATE submissions.

    ``stream`` has the key columns, not null, ``submitted_at`` (timestamp), ``submission_id``
    (long) and ``value`` (string). Of equal times the greater id wins. ``submission_count``
    counts the submissions of the key that were not late; it is null in late rows."""
    keyed = [StructField(k, stream.schema[k].dataType) for k in key]
    best = [StructField("_us", LongType()), StructField("submission_id", LongType()), StructField("value", StringType()),
            StructField("submission_count", LongType())]
    schema = StructType([*keyed, *best, StructField("kind", StringType())])
    names, columns, order = [f.name for f in schema], [*key, *(f.name for f in best)], ["_us", "submission_id"]
    kept = to_arrow_schema(StructType([*keyed, *best]))

    def merged(new: pd.DataFrame, held: pd.DataFrame | None) -> pd.DataFrame:
        """The last row of each key, with all its submissions; of a full tie the one that is held."""
        rows = new if held is None else pd.concat([new, held], ignore_index=True)
        rows = rows.sort_values(order, kind="stable")
        count = rows.groupby(list(key), sort=False)["submission_count"].transform("sum")
        return rows.assign(submission_count=count).drop_duplicates(list(key), keep="last")

    def update(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark, found = state.getCurrentWatermarkMs(), None
        for frame in frames:
            old = frame["_us"] // 1000 < watermark
            if old.any():
                yield frame.loc[old, [*key, *order, "value"]].assign(submission_count=None, kind=LATE)[names]
            if not old.all():
                found = merged(frame.loc[~old].assign(submission_count=1)[columns], found)
        if found is not None:
            rows = found
            if state.exists:
                with pa.ipc.open_stream(state.get[0]) as held:
                    rows = merged(found, held.read_pandas())
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, kept) as out:
                out.write_table(pa.Table.from_pandas(rows[columns], kept, preserve_index=False))
            state.update((sink.getvalue().to_pybytes(),))
            changed = rows.merge(found[list(key)], on=list(key)) if state.exists else rows
            yield changed.assign(kind=CURRENT)[names]

    timed = stream.select(F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int").alias(BUCKET), *key, *SUBMISSION,
                          F.unix_micros("submitted_at").alias("_us")).withWatermark("submitted_at", delay)
    rows = timed.groupBy(BUCKET).applyInPandasWithState(
        update, schema, StructType([StructField("rows", BinaryType())]), "update", GroupStateTimeout.NoTimeout)
    return rows.select(*key, F.timestamp_micros("_us").alias("submitted_at"), "submission_id", "value", "submission_count", "kind")


def start(stream: DataFrame, key: Sequence[str], delay: str, out: str, checkpoint: str) -> StreamingQuery:
    """Run over what is there now and stop; started again with the same ``checkpoint`` it goes on
    from there. A micro-batch's rows lie in ``out``/batch=N, written anew if it is repeated."""
    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return (latest_submissions(stream, key, delay).writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def answer(written_rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The newest CURRENT row of every key out of all batches' rows, and all LATE rows."""
    names = [*key, *SUBMISSION, "submission_count", "kind"]
    now = written_rows.where(F.col("kind") == CURRENT).groupBy(*key).agg(
        F.max_by(F.struct(*SUBMISSION, "submission_count", "kind"), "batch").alias("r")).select(*key, "r.*")
    return now.select(*names).unionByName(written_rows.where(F.col("kind") == LATE).select(*names))
