"""O-79 over polls that come out of order: each batch's polls applied in the order of their time.

A batch's state holds its next polls, the smallest ``retry_limit - attempts + 1`` by (ts,
event_id): a batch ends at its first terminal poll or one after the limit, and polls that
arrive later can only push the others back, so no poll beyond these can matter. A poll is
applied once the watermark has passed it, that is when no earlier poll can come any more.

Batches are dealt by hash over a number of buckets, and a bucket's batches share one state and
one event-time timeout, at the earliest of what they wait for: a call of the function costs far
more than a batch in it. A call holds one bucket's batches, not its polls."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import constants as K
from .ingest import LEDGER_OUT

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Ended batches with the time their mark goes; open ones with the number of their waiting polls; these polls.
_STATE = ("ended array<string>, forget_at array<long>, batch_id array<string>, attempts array<long>, polls array<long>, "
          "waiting array<long>, at array<long>, event_id array<long>, status array<string>")

#: States that batches are dealt over. A stream keeps the number that it was started with.
BUCKETS = 1024


def _place(poll: tuple[int, int, str | None]) -> tuple[int, int, str]:
    return poll[0], poll[1], poll[2] or ""


def _unpacked(state: GroupState) -> tuple[dict, dict]:
    """Ended batches -> when their mark goes; open batches -> [attempts, polls, waiting polls]."""
    if not state.exists:
        return {}, {}
    ended, forget_at, batches, attempts, polls, counts, *waiting = state.get
    rest = zip(*waiting)
    return (dict(zip(ended, forget_at)),
            {b: [a, p, [next(rest) for _ in range(n)]] for b, a, p, n in zip(batches, attempts, polls, counts)})


def _pack(state: GroupState, ended: dict, opened: dict) -> None:
    kept = [x for _, _, waiting in opened.values() for x in waiting]
    state.update((list(ended), list(ended.values()), list(opened), [a for a, _, _ in opened.values()], [p for _, p, _ in opened.values()],
                  [len(w) for _, _, w in opened.values()], *([x[i] for x in kept] for i in range(3))))


def _ledger_fn(retry_limit: int, terminal: tuple[str, ...], forget_after_ms: int | None) -> Callable:
    def next_polls(attempts: int, waiting: list) -> list:
        return heapq.nsmallest(retry_limit - attempts + 1, waiting, key=_place)

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        ended, opened = _unpacked(state)
        for part in () if state.hasTimedOut else pdfs:
            batches, statuses = (part[c].astype(object).where(part[c].notna(), None).tolist() for c in ("batch_id", "status"))
            for batch, *poll in zip(batches, part["at"].tolist(), part["event_id"].tolist(), statuses):
                if batch not in ended:
                    found = opened.setdefault(batch, [0, 0, []])
                    found[2].append(tuple(poll))
                    if len(found[2]) > 2 * (retry_limit + 1) + 100:
                        found[2] = next_polls(found[0], found[2])
        if forget_after_ms is not None:  # after the polls that still found the mark
            ended = {b: at for b, at in ended.items() if at is None or at >= watermark}
        out = []
        for batch, (attempts, polls, waiting) in list(opened.items()):
            waiting = next_polls(attempts, waiting)
            done, outcome = 0, None
            while done < len(waiting) and not outcome and waiting[done][0] < watermark * 1000:
                status = waiting[done][2]
                done, polls = done + 1, polls + 1
                outcome = status if status in terminal else "given_up" if attempts >= retry_limit else None
                attempts += not outcome
            if outcome:
                out.append((batch, outcome, attempts, polls))
                del opened[batch]
                ended[batch] = None if forget_after_ms is None else watermark + max(forget_after_ms, 1)
            else:
                opened[batch] = [attempts, polls, waiting[done:]]
        if not (ended or opened):
            state.remove()
        else:
            _pack(state, ended, opened)
            due = [w[0][0] // 1000 for _, _, w in opened.values() if w] + [at for at in ended.values() if at is not None]
            if due:  # a call without a timeout of its own takes away the last one
                state.setTimeoutTimestamp(max(min(due), watermark, 1))
        if out:
            yield pd.DataFrame(out, columns=["batch_id", "outcome", "attempts", "polls"])

    return fn


def batch_ledger_in_time(polls: DataFrame, delay: str, retry_limit: int = K.BATCH_RETRY_LIMIT, terminal: tuple[str, ...] = K.BATCH_TERMINAL,
                         forget_after_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """O-79 over a stream of polls ``(batch_id, ts timestamp, event_id, status)`` in any order of
    arrival within ``delay``: the outcome of each batch, emitted once when the watermark has passed
    its end. Polls later than the watermark are dropped, as in any event-time operator; a batch's
    last polls wait until the watermark passes them, so a source that ends needs a closing poll.
    The mark of an ended batch stays, or goes ``forget_after_ms`` after its end. Null batch ids are one
    batch, a null status is not terminal, and polls without ``ts`` or ``event_id`` have no place and are left out.

    Start the query within :func:`timers_store`: RocksDB keeps the states outside the executors' heap."""
    known = polls.where("ts is not null and event_id is not null").withWatermark("ts", delay)
    dealt = known.select(F.expr(f"cast(pmod(xxhash64(batch_id), {buckets}) as int)").alias("bucket"), "batch_id", "ts", "event_id", "status",
                         F.unix_micros("ts").alias("at"))
    return dealt.groupBy("bucket").applyInPandasWithState(
        _ledger_fn(retry_limit, tuple(terminal), forget_after_ms), LEDGER_OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


class timers_store:
    """Queries started inside use the RocksDB state store; the session's own setting comes back."""

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self):
        self.before = self.conf.get(_PROVIDER, None)
        self.conf.set(_PROVIDER, _ROCKSDB)

    def __exit__(self, *_):
        if self.before is None:
            self.conf.unset(_PROVIDER)
        else:
            self.conf.set(_PROVIDER, self.before)
